"""Periodic runs against a search over all periods."""

import binascii
import hashlib
import os
import random
from fractions import Fraction

import brute
import numpy as np
import pytest

from tallyloom.llm import periodic_runs, queries
from tallyloom.llm.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def all_runs(w):
    """Start, length and period of every run, by trying each period at each place."""
    out = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def want(doc_id, text, change=True):
    w = brute.WORD.findall(text or "")
    h = binascii.crc32(str(doc_id).encode())
    if change and doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    runs = all_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        digest(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def odd_texts(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(150))]
        for _ in range(rng.randrange(4) if len(w) > 5 else 0):
            s, p = rng.randrange(len(w)), rng.randrange(1, max(2, len(w) // 4))
            for i in range(s + p, min(len(w), s + p * rng.randrange(2, 9))):
                w[i] = w[i - p]
        yield w


@pytest.mark.parametrize("seed", range(40))
def test_random_texts(seed):
    texts = list(odd_texts(seed, 12)) + [[0, 1] * seed, [7] * (3 * seed), [], [0, 0, 1] * 11 + [0]]
    flat = np.array([x for w in texts for x in w], np.int64)
    s, e, p = periodic_runs.find_runs(flat, np.repeat(np.arange(len(texts)), [len(w) for w in texts]))
    first, expected = 0, []
    for w in texts:
        expected += [(a + first, n, q) for a, n, q in all_runs(w)]
        first += len(w)
    assert list(zip(s.tolist(), (e - s).tolist(), p.tolist(), strict=True)) == expected


def test_candidates_in_blocks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK_TRIES", 7)
    test_random_texts(3)


def test_grammar_derives_the_texts():
    texts = list(odd_texts(1, 9))
    words = np.array([x + 1000 * i for i, w in enumerate(texts) for x in w], np.int64)
    own = np.unique(words, return_inverse=True)[1]
    g = periodic_runs.Grammar(own, np.repeat(np.arange(len(texts)), [len(w) for w in texts]))

    def derive(x):
        if x < g.n_words:
            return [x]
        return derive(g.left[x - g.n_words]) + derive(g.right[x - g.n_words])

    assert [y for x in g.symbol for y in derive(x)] == own.tolist()
    for k in range(len(g.size)):
        assert own[g.at[k] : g.at[k] + g.size[k]].tolist() == derive(k + g.n_words)
        assert len(derive(g.left[k])) == g.half[k]
    pairs = list(zip(g.symbol, g.symbol[1:], strict=False))
    places = [p for k, p in enumerate(pairs) if k == 0 or pairs[k - 1] != p]
    assert len(set(places)) == len(places)  # no pair is left twice


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    expected = sorted(want(r.doc_id, r.text) for r in docs.collect())
    assert sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()) == expected
    assert any(r[1] for r in expected)


def test_odd_rows(spark):
    loop = "x y z " * 12
    rows = [(10, None), (11, ""), (12, " \t\n"), (13, loop), (13, loop), (None, loop), (14, "a" * 70_000), (15, "ein wort " * 3000), (16, "  " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = periodic_runs.report(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(want(d, t, False)) for d, t in rows)
    assert periodic_runs.report(df.limit(0)).collect() == []
    planted = periodic_runs.report(df, prepare=queries.planted).collect()
    assert sorted(map(str, map(tuple, planted))) == sorted(str(want(d, t)) for d, t in rows)


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "b a " * 20, "s", 5, "r")], "doc_id long, text string, start string, `n.runs` int, __id string")
    row = periodic_runs.collapse(df).first()
    assert tuple(row)[:5] == (1, "b a " * 20, "s", 5, "r")
    assert row.periodic.collapsed == "b a" and row.periodic.runs == "0,40,2\n"
