"""Counts over one text, from which rules and the classifier derive their statistics."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The word separators and the symbols that the rules count, as bytes.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

FIELDS = (
    "n_words n_distinct word_chars n_symbols n_dup_lines n_lines n_repeat_words n_upper n_digits n_exclaims n_stops n_pipes n_other"
).split()
SCHEMA = ", ".join(f"{f} long" for f in FIELDS)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, the first one included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(text: str | None) -> tuple[int, ...]:
    """The counts named in :data:`FIELDS`; a null text counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    seen: set[bytes] = set()
    n_lines = n_dup_lines = 0
    for line in data.split(b"\n"):
        if line.strip():
            n_lines += 1
            n_dup_lines += line in seen
            seen.add(line)
    by = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = int(len(data) - by[0x80:0xC0].sum())
    return (
        len(words),
        len(set(words)),
        chars - int(by[list(SPACES)].sum()),
        int(by[list(SYMBOLS)].sum()),
        n_dup_lines,
        n_lines,
        repeated_words(words),
        int(by[65:91].sum()),
        int(by[48:58].sum()),
        int(by[33] + by[63]),
        int(by[44] + by[46]),
        int(by[124]),
        int(by[0xC0:].sum()),
    )


def measured(text: Column) -> Column:
    """A struct of :data:`FIELDS`."""

    @F.pandas_udf(SCHEMA)
    def counts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=FIELDS, dtype="int64")

    return counts(text)
