"""Periodic runs of words, found on a grammar of each text.

Re-Pair replaces pairs of neighbours that occur twice or more in a text by new symbols. It
works in rounds here: in each round a pair is replaced wherever it is more frequent than
the pairs that overlap it (of equal ones the later number counts as more frequent), so
that all texts of a batch take part in one vectorised step. What is left of a text is
joined by a balanced tree. Every run lies inside some symbol of this grammar and crosses
the border of that symbol's two halves. So the runs over a symbol's border are computed
once, at its first place, and carried to every place where the symbol is derived; parts of
a longer run of the same period go, and of equal stretches the smallest period stays.

A run is at least three periods and MIN_LENGTH words long, so a candidate period has a
stretch of :data:`PROBE` equal words on one side of the border; common extensions are then
found by bisection over prefix sums modulo two primes (fixed bases; a chance of 2^-62 per
comparison to err).

Each text is worked on as a whole inside one row's task; memory follows the longest text
(about 300 bytes a word) or :data:`CHUNK_WORDS` words of shorter ones.

Defined results: a null text has no words and no runs, as has an empty one; repeated rows
get a row each; an empty table gives no rows; other columns, whatever their names, are
kept by :func:`collapse` and ignored by :func:`report`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words of texts that are worked on together.
CHUNK_WORDS = 400_000
#: Candidate periods that are tried together.
CHUNK_TRIES = 2_000_000
MIN_LENGTH = 24
#: Equal words that any run of three periods and MIN_LENGTH words shows on one side of a border.
PROBE = 8
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003_379, 1_618_033_997)
#: Multiplier of the hash over PROBE words.
STEP = np.uint64(0x9E3779B97F4A7C15)

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and running number of ``counts`` items each."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - first[owner]


class Extensions:
    """Longest common extensions between places of one sequence of numbers."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        value = (words.astype(np.uint64) + np.uint64(1)) * STEP
        value ^= value >> np.uint64(29)
        self.sums, self.powers = [], []
        for prime, base in zip(PRIMES, BASES, strict=True):
            power = np.ones(n + 1, np.int64)
            done = 1
            while done <= n:
                more = min(done, n + 1 - done)
                factor = power[done - 1] * base % prime
                power[done : done + more] = power[:more] * factor % prime
                done += more
            terms = (value % np.uint64(prime)).astype(np.int64) * power[:n] % prime
            self.sums.append(np.concatenate([[0], np.cumsum(terms)]))
            self.powers.append(power)
        probe, width = value, 1
        while width < PROBE:
            probe = probe[:-width] * STEP + (probe[width:] ^ (probe[width:] >> np.uint64(31)))
            width *= 2
        self.probe = probe

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches at ``i`` and, further on, ``j`` are the same."""
        same = np.ones(len(i), bool)
        for prime, sums, powers in zip(PRIMES, self.sums, self.powers, strict=True):
            left = (sums[i + length] - sums[i]) % prime * powers[j - i] % prime
            same &= left == (sums[j + length] - sums[j]) % prime
        return same

    def probed(self, at: np.ndarray, period: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether PROBE equal words follow or precede ``at`` a period apart, inside ``low`` to ``high``."""
        last = len(self.probe) - 1
        right = (at + period + PROBE <= high) & (at >= low)
        left = (at - PROBE >= low) & (at + period <= high)
        i, j = np.clip(at, 0, last), np.clip(at + period, 0, last)
        hit = right & (self.probe[i] == self.probe[j])
        i, j = np.clip(at - PROBE, 0, last), np.clip(at - PROBE + period, 0, last)
        return hit | (left & (self.probe[i] == self.probe[j]))

    def reach(self, at: np.ndarray, period: np.ndarray, room: np.ndarray, forward: bool) -> np.ndarray:
        """Words from ``at`` on, or before it, that equal those a period further; ``room`` at most."""
        found = np.zeros(len(at), np.int64)
        step = 1 << max(int(room.max(initial=0)).bit_length() - 1, 0)
        while step:
            open_ = np.flatnonzero(found + step <= room)
            i = at[open_] + found[open_] if forward else at[open_] - found[open_] - step
            same = self.equal(i, i + period[open_], np.full(len(open_), step))
            found[open_[same]] += step
            step >>= 1
        return found


class Grammar:
    """Symbols of all texts of a chunk. Round r made the symbols from ``first[r]`` to ``first[r + 1]``."""

    def __init__(self, words: np.ndarray, text_of: np.ndarray):
        """``words``: numbers that differ between texts."""
        n = len(words)
        n_words = int(words.max(initial=-1)) + 1
        symbol, start, length = words.astype(np.int64), np.arange(n), np.ones(n, np.int64)
        joined = np.zeros(n, bool)  # to the next one
        if n:
            joined[:-1] = text_of[1:] == text_of[:-1]
        self.left, self.right, self.at, self.half, self.size = ([np.zeros(0, np.int64)] for _ in range(5))
        self.first, self.n_words = [n_words], n_words
        top: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            pairs = np.flatnonzero(joined)
            # Pairs of words: no symbol number reaches 2^31, as there are fewer symbols than twice the words.
            keys, inverse, counts = np.unique(
                symbol[pairs] << 31 | symbol[np.minimum(pairs + 1, len(symbol) - 1)], return_inverse=True, return_counts=True
            )
            order = np.empty(len(keys), np.int64)
            order[np.argsort(counts, kind="stable")] = np.arange(len(keys))
            rank = np.full(len(symbol), -1, np.int64)
            rank[pairs] = np.where(counts[inverse] > 1, order[inverse], -1)
            joined &= rank >= 0  # a pair that occurs once never occurs twice later on
            alive = joined.copy()
            alive[1:] |= joined[:-1]
            top.append((symbol[~alive], start[~alive], length[~alive]))
            symbol, start, length, joined, rank = (x[alive] for x in (symbol, start, length, joined, rank))
            if not joined.any():
                break
            taken = self._take(rank)
            where = np.flatnonzero(taken)
            made, inverse = np.unique(rank[where], return_inverse=True)
            here = np.empty(len(made), np.int64)
            here[inverse[::-1]] = where[::-1]
            self.left.append(symbol[here])
            self.right.append(symbol[here + 1])
            self.at.append(start[here])
            self.half.append(length[here])
            self.size.append(length[here] + length[here + 1])
            symbol[where] = self.first[-1] + inverse
            self.first.append(self.first[-1] + len(made))
            length[where] += length[where + 1]
            joined[where] = joined[where + 1]
            stays = np.ones(len(symbol), bool)
            stays[where + 1] = False
            symbol, start, length, joined = (x[stays] for x in (symbol, start, length, joined))
        symbol, start, length = (np.concatenate(x) for x in zip(*top, strict=True))
        order = np.argsort(start, kind="stable")
        self.symbol, self.start, self.length = symbol[order], start[order], length[order]
        self.left, self.right, self.at, self.half, self.size = (
            np.concatenate(x) for x in (self.left, self.right, self.at, self.half, self.size)
        )

    @staticmethod
    def _take(rank: np.ndarray) -> np.ndarray:
        """Pairs to replace: above both neighbours; of one pair over and over (aaaa), every second."""
        n = len(rank)
        fresh = np.ones(n, bool)
        fresh[1:] = rank[1:] != rank[:-1]
        begin = np.flatnonzero(fresh)
        block = np.cumsum(fresh) - 1
        before = np.concatenate([[-1], rank[begin[1:] - 1]])
        after = np.concatenate([rank[begin[1:]], [-1]])
        best = (rank[begin] > before) & (rank[begin] > after)
        return best[block] & ((np.arange(n) - begin[block]) % 2 == 0) & (rank >= 0)

    def tree(self, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Borders of the balanced tree over what is left of each text: low, border, high."""
        owner = text_of[self.start]
        cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
        lo, hi = cut, np.append(cut[1:], len(owner)) if len(cut) else cut
        ends = self.start + self.length
        out = []
        while len(lo):
            wide = (hi - lo > 1) & (ends[hi - 1] - self.start[lo] >= MIN_LENGTH)
            lo, hi = lo[wide], hi[wide]
            mid = (lo + hi) // 2
            out.append((self.start[lo], self.start[mid], ends[hi - 1]))
            lo, hi = np.concatenate([lo, mid]), np.concatenate([mid, hi])
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def carry(self, symbol: np.ndarray, runs: Runs) -> Runs:
        """Runs of symbols, relative to them, at every place where the symbol is derived."""
        n = self.first[-1] - self.n_words
        counts = np.bincount(symbol, minlength=n)
        by_symbol = np.argsort(symbol, kind="stable")
        offset = np.cumsum(counts) - counts
        needed = counts > 0
        spans = [(a - self.n_words, b - self.n_words) for a, b in zip(self.first, self.first[1:], strict=False)]
        for a, b in spans:
            for child in (self.left[a:b] - self.n_words, self.right[a:b] - self.n_words):
                needed[a:b] |= (child >= 0) & needed[np.maximum(child, 0)]
        out: list[Runs] = [(np.zeros(0, np.int64),) * 3]
        open_s, open_at = self.symbol - self.n_words, self.start
        for a, b in reversed(spans):
            keep = open_s >= 0
            keep[keep] = needed[open_s[keep]]
            open_s, open_at = open_s[keep], open_at[keep]
            now = open_s >= a
            s, at = open_s[now], open_at[now]
            who, k = ranges(counts[s])
            row = by_symbol[offset[s[who]] + k]
            out.append((runs[0][row] + at[who], runs[1][row] + at[who], runs[2][row]))
            open_s = np.concatenate([open_s[~now], self.left[s] - self.n_words, self.right[s] - self.n_words])
            open_at = np.concatenate([open_at[~now], at, at + self.half[s]])
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def crossing(ext: Extensions, low: np.ndarray, border: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, Runs]:
    """Runs inside ``low`` to ``high`` over ``border``: the row each belongs to, start, end, period."""
    periods = np.maximum(high - low, 0) // 3
    cut = np.searchsorted(np.cumsum(periods), np.arange(0, int(periods.sum()) + CHUNK_TRIES, CHUNK_TRIES), side="left")
    cut = np.unique(np.append(cut, len(periods)))
    found = []
    for a, b in zip(cut, cut[1:], strict=False):
        who, q = ranges(periods[a:b])
        who, q = who + a, q + 1
        for back in (False, True):
            at = border[who] - q if back else border[who]
            hit = np.flatnonzero(ext.probed(at, q, low[who], high[who]))
            w, p, c = who[hit], q[hit], at[hit]
            right = ext.reach(c, p, np.maximum(high[w] - c - p, 0), True)
            left = ext.reach(c, p, c - low[w], False)
            good = (left + right >= 2 * p) & (left + right + p >= MIN_LENGTH)
            w, p, c, right, left = (x[good] for x in (w, p, c, right, left))
            found.append((w, c - left, c + p + right, p))
    if not found:
        return np.zeros(0, np.int64), (np.zeros(0, np.int64),) * 3
    w, s, e, p = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((p, e, s, w))
    w, s, e, p = w[order], s[order], e[order], p[order]
    same = np.zeros(len(w), bool)
    same[1:] = (w[1:] == w[:-1]) & (s[1:] == s[:-1]) & (e[1:] == e[:-1])
    return w[~same], (s[~same], e[~same], p[~same])


def maximal(runs: Runs) -> Runs:
    """Runs without parts of others of the same period; of equal stretches the smallest period."""
    s, e, p = runs
    order = np.lexsort((-e, s, p))
    s, e, p = s[order], e[order], p[order]
    if len(s):
        far = p * (int(e.max()) + 1) + e  # grows with the period, so one running maximum serves all periods
        keep = np.ones(len(s), bool)
        keep[1:] = far[1:] > np.maximum.accumulate(far)[:-1]
        s, e, p = s[keep], e[keep], p[keep]
        order = np.lexsort((p, e, s))
        s, e, p = s[order], e[order], p[order]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
        s, e, p = s[keep], e[keep], p[keep]
        order = np.lexsort((p, s))
        s, e, p = s[order], e[order], p[order]
    return s, e, p


def find_runs(words: np.ndarray, text_of: np.ndarray) -> Runs:
    """Start, end and period of all runs, by start and period.

    ``words``: numbers of words, texts one after the other; ``text_of``: each word's text,
    ascending.
    """
    none = (np.zeros(0, np.int64),) * 3
    if len(words) < MIN_LENGTH:
        return none
    ext = Extensions(words)
    own = np.unique(text_of * (int(words.max()) + 1) + words, return_inverse=True)[1]
    grammar = Grammar(own, text_of)
    long = np.flatnonzero(grammar.size >= MIN_LENGTH)
    at = grammar.at[long]
    who, (s, e, p) = crossing(ext, at, at + grammar.half[long], at + grammar.size[long])
    carried = grammar.carry(long[who], (s - at[who], e - at[who], p)) if len(who) else none
    _, top = crossing(ext, *grammar.tree(text_of))
    return maximal(tuple(np.concatenate(x) for x in zip(carried, top, strict=True)))


def summary(runs: list[tuple[int, int, int]], words: list[str], kept: np.ndarray) -> tuple:
    """Columns of one text from its runs (start, length, period) and the words that stay."""
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    # Quotients of lengths below 2^26 differ as floats whenever they differ.
    s, n, p = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    text = " ".join(words) if kept is None else " ".join([w for w, k in zip(words, kept, strict=True) if k])
    return (
        len(runs),
        s,
        n,
        p,
        1000 * n // p if runs else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        listed,
        text,
    )


FIELDS = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, runs string, collapsed string"
)


def chunk_rows(words: list[list[str]]) -> Iterator[tuple]:
    """:data:`FIELDS` for each text."""
    sizes = np.array([len(w) for w in words], np.int64)
    if sizes.sum():
        ids = pa.array([x for w in words for x in w], pa.large_string()).dictionary_encode().indices
        flat = ids.to_numpy(zero_copy_only=False).astype(np.int64)
    else:
        flat = np.zeros(0, np.int64)
    text_of = np.repeat(np.arange(len(words)), sizes)
    s, e, p = find_runs(flat, text_of)
    first = np.cumsum(sizes) - sizes
    gone = np.zeros(len(flat) + 1, np.int64)
    np.add.at(gone, s + p, 1)
    np.add.at(gone, e, -1)
    kept = np.cumsum(gone)[: len(flat)] == 0
    cut = np.searchsorted(s, np.append(first, len(flat)))
    for i, w in enumerate(words):
        a, b = cut[i], cut[i + 1] if i + 1 < len(words) else len(s)
        runs = list(zip((s[a:b] - first[i]).tolist(), (e[a:b] - s[a:b]).tolist(), p[a:b].tolist(), strict=True))
        yield summary(runs, w, kept[first[i] : first[i] + sizes[i]] if runs else None)


Prepare = Callable[[object, list], list]


def _texts(batches: Iterator[pa.RecordBatch], prepare: Prepare | None) -> Iterator[pa.RecordBatch]:
    names = _names()
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in FIELDS.split(", ")]
    for batch in batches:
        begin = 0
        while begin < batch.num_rows:
            keys, words, size, end = [], [], 0, begin
            while end < batch.num_rows and (end == begin or size < CHUNK_WORDS):
                text = batch.column(1)[end].as_py()
                # Bytes split at the six separators alone; lone surrogates come back as they were.
                w = [x.decode() for x in (text or "").encode().split()]
                w = prepare(batch.column(0)[end].as_py(), w) if prepare else w
                words.append(w)
                size += len(w)
                end += 1
            rows = list(zip(*chunk_rows(words), strict=True))
            keys = batch.slice(begin, end - begin)
            columns = [keys.column(i) for i in range(2, batch.num_columns)]
            columns += [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys.schema.names[2:], *names])
            begin = end


def _names() -> list[str]:
    return [f.split(" ")[0] for f in FIELDS.split(", ")]


def collapse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prepare: Prepare | None = None) -> DataFrame:
    """``docs`` with a column ``periodic``: a struct of :data:`FIELDS` for each text.

    ``runs`` lists every run as a line of start, length and period; ``collapsed`` is the
    text's words without those that any run holds after its first period, joined by
    spaces. ``prepare`` may change the words of a text, given its id.
    """
    if "periodic" in docs.columns:
        raise ValueError("the table has a column named periodic already")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text"), row.alias("__row"))
    schema = StructType([whole.schema["__row"], *StructType.fromDDL(FIELDS)])
    out = whole.mapInArrow(lambda batches: _texts(batches, prepare), schema)
    return out.select(*[F.col(f"__row.`{c}`") for c in docs.columns], F.struct(*_names()).alias("periodic"))


def report(docs: DataFrame, prepare: Prepare | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its runs counted, the one of most periods, digests of all runs and of the collapsed text."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    counts = [F.col(f"periodic.{c}") for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256")]
    digest = F.sha2(F.col("periodic.collapsed").cast("binary"), 256).alias("collapsed_sha256")
    return collapse(narrow, prepare=prepare).select("doc_id", *counts, digest)
