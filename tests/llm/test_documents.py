"""Operators over documents: whole tables against brute force or SQL, and odd rows."""

import binascii
import os

import brute
import pytest
from compare import compare, connect

from tallyloom.llm import decontamination, mixing, personal_data, quality_classifier, quality_rules, sharding, simhash
from tallyloom.llm import queries as _  # noqa: F401
from tallyloom.llm.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, kept boolean, spans string"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, equal texts, and columns named like results."""
    prose = " ".join(f"word{i % 97}x{i % 89}" for i in range(400))
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one"),
        (5, prose),
        (5, prose),
        (6, prose + " end"),
        (None, prose),
        (7, "Zoë çé\n" * 60),
        (8, "x" * 200_000),
        (9, " ".join(f"long{i}" for i in range(40_000))),
        (10, "4111 1111 1111 1111 " * 700),
    ]
    made = [(i, t, None, None if i == 2 else "s", None, 5, True, "old") for i, t in rows]
    return spark.createDataFrame(made, SCHEMA)


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (8, 0, 0), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    problem, n = compare(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR)
    assert problem is None
    assert n > 0


def test_shards_are_minimal(spark, texts):
    rows = QUERIES["op1_shards"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    loads, shards, slots = {}, {}, {}
    for r in rows:
        text = texts[r["doc_id"]].encode()
        assert r["size"] == len(text) + 1 and r["text_crc32"] == binascii.crc32(text)
        assert r["law"] == "bytes" and r["grown_shard"] is None
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        assert shards.setdefault(text, r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(shards.values()) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for t in texts.values():
        key = __import__("hashlib").md5(t.encode()).hexdigest()
        groups[key] = groups.get(key, 0) + len(t.encode()) + 1
    assert max(loads.values()) == brute.smallest_capacity([groups[k] for k in sorted(groups)], 8)


@pytest.mark.parametrize("n", [1, 2, 3, 20])
def test_shards_of_odd_rows(spark, odd, n):
    rows = sharding.shard(odd, n).collect()
    assert len(rows) == odd.count()
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (1, 2)} == {(1, 0)}
    assert max(r["shard"] for r in rows) < n
    assert sharding.with_shard(odd, n).columns == odd.columns
    assert sharding.shard(empty(spark), n).count() == 0


def test_decontamination_of_odd_rows(spark, odd):
    items = spark.createDataFrame(
        [(10, "Word5x5, WORD6x6!"), (9, "word1x1 " * 3), (7, None), (8, "..."), (9, "one"), (None, "zoë çé")],
        "item_id long, text string",
    )
    for limit in (decontamination.VECTOR_BYTES, 0):  # as a vector, and joined
        rows = decontamination.report(odd, items, limit=limit).collect()
        assert len(rows) == odd.count()
        got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in rows}
        assert got[1] == got[2] == got[3] == (0, 0, 0, False)
        assert got[4] == (1, 1, 1, True)
        assert got[5] == (400, 2, 1, True)
        assert got[7] == (120, 120, 1, True)
        assert got[8] == (1, 0, 0, False)
        assert {r["items_sha256"] for r in rows if r["doc_id"] == 5} == {__import__("hashlib").sha256(b"10").hexdigest()}
    kept = decontamination.remove(odd, items)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 8, 9, 10]
    cut = {r["doc_id"]: r["text"] for r in decontamination.remove(odd, items, "spans").collect()}
    assert cut[4] == "" and cut[1] is None and "word5x5 " not in cut[5] and cut[5].startswith("word0x0 word1x1 ")
    assert decontamination.report(empty(spark), items).count() == 0
    assert decontamination.report(odd, empty(spark, "item_id long, text string")).where("n_hit > 0").count() == 0


def test_many_benchmark_windows(spark):
    """A quarter of a million windows: more than fit a plan's text. Both ways find the same."""
    items = spark.range(250).selectExpr("id as item_id", "concat_ws(' ', transform(sequence(0, 1008), i -> concat('w', id * 1009 + i))) as text")
    texts = [" ".join(f"w{i}" for i in range(5 + 1009 * k, 20 + 1009 * k)) for k in (0, 77, 249)] + ["w1 w2 w3", "q " * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ways = [decontamination.report(docs, items, limit=limit).collect() for limit in (decontamination.VECTOR_BYTES, 0)]
    assert sorted(map(tuple, ways[0])) == sorted(map(tuple, ways[1]))
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in ways[0]}
    assert got == {0: (15, 1), 1: (15, 1), 2: (15, 1), 3: (0, 0), 4: (0, 0)}
    plan = decontamination.find(docs, items)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Subquery")[0] and len(plan) < 200_000


def test_personal_data(spark, texts):
    for r in QUERIES["op9_pii"](spark, SF_DIR).collect():
        counts, digest, listed = brute.pii(texts[r["doc_id"]])
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == counts
        assert r["base_sha256"] == digest
        assert r["spans"] == listed


TRICKY = [
    None, "", "a@b.cc@d.e f@g", "a.b@c.d_x@e.f.", "é a@b.c ü", "x@y..z", "1.2.3.4.5 256.1.1.1 001.2.3.4 1.2.3", "0.0.0.0",
    "4111111111111111", "4111-1111 1111-1111 x", "4111  1111 1111 1111", "12 34 - 4111111111111111", "4111111111111112",
    "+1 (293) 555-9179%%%", "+1234567890123456", "++12 34567890.", "+1 -", "+12 345 678 90 ..", "1" * 50_000, "a" * 50_000 + "@",
    "1.2.3.4 " * 700, "😀 a@b.c 😀 +1 234 567 8901", "+4111 1111 1111 1111", "1 2 3 4 5 6 7 8 9 0 1 2 3 4", "9" * 20,
    "a" * 9 + "." * 9 + "@b.c", "4 4111111111111111", "-4111111111111111-",
    # Two kinds from one place: by kind as listed, whichever ends first.
    "1.2.3.4@host.com", "4111111111111111@x.com", "4111111111111111.1.1.1", "4111111111111111@x.com 1.2.3.4@h.de",
    # Account numbers end where their country's do.
    "DE89370400440532013000 BIC COBADEFF", "DE89370400440532013000 The end", "DE89 3704 0044 0532 0130 00 BIC", "GB29 NWBK 6016 1331 9268 19",
    "NO9386011117947, BE68 5390 0754 7034.", "xDE89370400440532013000", "DE893704004405320130001", "DE89 37040044 0532013000", "ZZ89370400440532013000",
    "DE89  3704 0044 0532 0130 00", "DE89370400440532013000DE89370400440532013000", "MT84MALT011000012345MTLCAST001S",
    # A context word decides about forms that say little.
    "ssn 123-45-6789", "123-45-6789", "social security: 666-12-3456 899-99-9999", "ssn" + " " * 41 + "123-45-6789", "ssn 1123-45-6789",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "04dbebab91ab85687d33eeaaf9ac699e1188f962", "secret " + "a" * 40, "API-KEY " + "a1" * 16 + "=",
]


def random_texts(count):
    """Pieces of personal data run into each other, so that kinds share places and borders."""
    import random

    rng = random.Random(6)
    pieces = [
        "4111111111111111", "1.2.3.4", "4111111111111111@x.com", "1.2.3.4@host.com", "1.2.3.4@host.com", "@", "a.b", ".com", " ", " ", "-", "+", "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "BIC",
        "ssn ", "123-45-6789", "token ", "0f" * 16, "x", "49", "(0)", "+49 30 1234567", "é", "256", ".", "_", "iban ",
    ]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(14))) for _ in range(count)]


def test_personal_data_in_random_texts(spark):
    texts = random_texts(1500)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ties = 0
    for r in personal_data.report(df).collect():
        counts, digest, listed = brute.pii(texts[r["doc_id"]])
        assert (r["spans"], r["base_sha256"]) == (listed, digest), texts[r["doc_id"]]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == counts
        starts = [s.split(":")[1] for s in listed.split(",") if s]
        ties += len(starts) != len(set(starts))
    assert ties > 20


def test_personal_data_positions(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    for r in personal_data.report(df).collect():
        counts, digest, listed = brute.pii(TRICKY[r["doc_id"]])
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == counts, TRICKY[r["doc_id"]]
        assert r["spans"] == listed
        assert r["base_sha256"] == digest


def test_personal_data_of_the_method(spark):
    good, bad = "my iban DE89370400440532013000.", "my iban DE89370400440532013001."
    df = spark.createDataFrame([(1, good), (2, bad), (3, "email a@b.c, a@b.c now"), (4, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in personal_data.report(df).collect()}
    assert rows[1]["spans"] == "iban:8:30" and rows[1]["scores"] == "1.0" and rows[2]["spans"] == ""
    assert rows[3]["scores"] == "1.0,1.0"
    redacted = {r["doc_id"]: r["text"] for r in personal_data.redact(df).collect()}
    assert redacted == {1: "my iban [IBAN].", 2: bad, 3: "email [EMAIL], [EMAIL] now", 4: None}


def test_personal_data_of_odd_rows(spark, odd):
    rows = personal_data.report(odd).collect()
    assert len(rows) == odd.count()
    assert personal_data.redact(odd).columns == odd.columns
    assert personal_data.report(empty(spark)).count() == 0


def test_rules(spark, texts):
    rows = QUERIES["op10_rules"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        want = brute.rules(texts[r["doc_id"]])
        got = tuple(r[c] for c in "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split())
        assert got == want
        assert not (r["kept"] and r["base_failed"])


def test_rules_of_odd_rows(spark, odd, labels):
    rows = quality_rules.report(odd, labels, n_trees=5, sample=4).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_words"] == by_id[3]["n_words"] == 0 and not by_id[1]["kept"]
    assert by_id[7]["n_dup_lines"] == 59
    kept = quality_rules.keep(odd, labels.limit(0))
    assert kept.columns == odd.columns
    good = {i for i, r in by_id.items() if not r["base_failed"]}
    assert {r["doc_id"] for r in kept.collect()} == good  # nothing learned, nothing rejected
    assert {r["kept"] for r in kept.collect()} == {True}
    assert quality_rules.report(empty(spark), labels).count() == 0


def rule_rows(count, seed=4):
    """Texts of ordinary words that vary a little in every rate, and one of symbols."""
    import random

    import pandas as pd
    from tallyloom.llm.statistics import FIELDS, measure

    rng = random.Random(seed)

    def word():
        w = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
        return w.title() if rng.random() < 0.1 else w + rng.choice(["", "", "", "", "!", "#"])

    plain = [rng.choice([" ", "\n"]).join(word() for _ in range(rng.randrange(60, 120))) for _ in range(count)]
    return pd.DataFrame([measure(t) for t in [*plain, "$$$ %%% " * 60]], columns=FIELDS)


def test_isolation_forest_finds_the_odd_one():
    x = rule_rows(60)
    scores = quality_rules.fit(x, 50, 32, 1).score(quality_rules.rates(x))
    assert scores.argmax() == 60 and ((scores > 0) & (scores < 1)).all()


def test_forest_scores_are_mean_path_lengths():
    """Each row walks each tree node by node; leaves add the mean depth of the rows that stayed together."""
    x = rule_rows(80)
    values = quality_rules.rates(x)
    forest = quality_rules.fit(x, 20, 32, 7)
    for row, score in zip(values, forest.score(values), strict=True):
        total = 0.0
        for t in forest.trees:
            at, depth = 0, 0
            while t.below[at] != at:
                at = t.below[at] if row[t.feature[at]] < t.cut[at] else t.above[at]
                depth += 1
            assert depth <= t.height
            total += t.length[at]
            assert t.length[at] >= depth
        want = 2 ** (-total / 20 / quality_rules.average_path(32))
        assert abs(score - want) < 1e-12
    # Of n rows an unsuccessful search passes 2 (1/2 + ... + 1/n) nodes on average.
    for n in (3, 10, 256):
        exact = 2 * sum(1 / i for i in range(2, n + 1))
        assert abs(quality_rules.average_path(n) - exact) < 1 / (n - 1)  # harmonic numbers by ln + 0.577


def test_threshold_against_all_cuts():
    import random

    rng = random.Random(3)
    for _ in range(200):
        tally = [(c, rng.randrange(3), rng.randrange(3)) for c in rng.sample(range(30), 9)]
        loss = rng.choice([0.0, 0.1, 0.3])
        good, bad = sum(t[1] for t in tally), sum(t[2] for t in tally)
        best, cut = 0.0, float("inf")
        for c in sorted((t[0] for t in tally), reverse=True):
            lost = sum(t[1] for t in tally if t[0] >= c)
            caught = sum(t[2] for t in tally if t[0] >= c)
            if good and bad and lost <= loss * good and caught / bad - lost / good > best:
                best, cut = caught / bad - lost / good, c / quality_rules.GRID
        assert quality_rules.best_threshold(tally, loss) == cut


def test_kept_follows_base_and_threshold(spark):
    """The verdict of every row of the table, from the anomalies and the labels alone."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = quality_rules.report(docs, labels).collect()
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    cells = {}
    for r in rows:
        if not r["base_failed"] and known.get(r["doc_id"]) is not None:
            cell = cells.setdefault(int(r["anomaly"] * quality_rules.GRID), [0, 0])
            cell[1 - known[r["doc_id"]]] += 1
    cut = quality_rules.best_threshold([(c, g, b) for c, (g, b) in cells.items()], 0.01)
    assert {r["doc_id"] for r in rows if r["kept"]} == {r["doc_id"] for r in rows if not r["base_failed"] and r["anomaly"] < cut}


def test_fingerprints_and_components(spark, texts):
    rows = QUERIES["op7_simhash"](spark, SF_DIR).collect()
    ids = sorted(texts)
    prints = [(i, brute.fingerprint(texts[i])) for i in ids]
    wanted = {i: (f"{f:016x}", c) for (i, f), c in zip(prints, brute.components(prints), strict=True)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == wanted


@pytest.mark.parametrize("large", [1, 512])
@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 5, 7])
def test_links_of_near_fingerprints(spark, distance, large):
    """Segment values that many share are split without losing a link."""
    import random

    rng = random.Random(distance)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(12):
            for b in rng.sample(range(64), rng.randint(0, 5)):
                base ^= 1 << b
            prints.add(base)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    got = {tuple(sorted(r)) for r in simhash.links(df, distance, large).collect()}
    want = {
        tuple(sorted((signed[a], signed[b]))) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= distance
    }
    assert got == want


def test_links_of_a_family_that_shares_a_segment(spark):
    """1,500 fingerprints agree in their upper half, beyond the bound; the lower halves are near each other."""
    import random

    rng = random.Random(5)
    lows = set()
    while len(lows) < 1500:
        lows.add(sum(1 << b for b in rng.sample(range(32), rng.randint(0, 6))))
    family = sorted((7 << 32) + low for low in lows)
    df = spark.createDataFrame([(f,) for f in family], "fp long")
    assert len(family) > simhash.LARGE
    got = {tuple(sorted(r)) for r in simhash.links(df, 3).collect()}
    assert got == {(a, b) for i, a in enumerate(family) for b in family[i + 1 :] if (a ^ b).bit_count() <= 3}


def test_labels_of_a_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long")
    assert {tuple(r) for r in simhash.smallest_labels(pairs).collect()} == {(i, 0) for i in range(41)} | {(99, 99), (100, 99)}


def test_components_of_odd_rows(spark, odd):
    rows = simhash.components(odd).collect()
    assert len(rows) == odd.count()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows}
    assert got[1] == got[2] == got[3] == ("0" * 16, 1)
    assert got[None][1] == got[5][1] == 5
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(5) == 1 and 2 not in ids and None not in ids
    assert simhash.components(empty(spark)).count() == 0 and simhash.keep_one(empty(spark)).count() == 0


def test_mixing_of_odd_rows(spark, odd):
    rows = mixing.mix(odd)
    assert rows.columns == [*odd.columns, "n_copies", "copy", "shuffle_key"]
    for r in rows.collect():
        assert 0 <= r["copy"] < r["n_copies"]
    weights = spark.createDataFrame([("s", 1.0), ("s", 1.0), ("t", None)], "source string, weight double")
    assert {r["source"] for r in mixing.mix(odd, weights).collect()} <= {"s"}
    assert mixing.mix(odd, weights.limit(0)).count() == 0
    assert mixing.mix(empty(spark)).count() == 0


def test_mixing_reaches_its_rates(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'some text' as text", "if(id % 4 = 0, 'a', 'b') as source")
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    n = {r["source"]: r["count"] for r in mixing.mix(docs, weights).groupBy("source").count().collect()}
    assert abs(n["a"] - 3000) < 250 and abs(n["b"] - 1000) < 150
    draws = mixing.mix(docs, weights).where("source = 'a'").select("doc_id", "n_copies").distinct()
    assert draws.where("n_copies > 1").count() > 700  # rate 3: P(more than one copy) is 0.8


def test_poisson_tables(spark):
    """Equal to the sums of the probabilities; a rate of a million ends soon; none for a rate of zero."""
    import math
    import time

    begin = time.time()
    rows = spark.createDataFrame([("a", 2000.0), ("b", 0.7), (None, 3.0), ("zero", 0.0), ("big", 1e6)], "__source string, rate double")
    sums = {r["__source"]: r["__sums"] for r in mixing.poisson_tables(rows).collect()}
    assert sums["zero"] is None and time.time() - begin < 60
    for source, rate in (("b", 0.7), (None, 3.0), ("a", 2000.0)):
        total = 0.0
        for k, got in enumerate(sums[source]):
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
            assert abs(got - total) < 1e-10
    assert abs(sums["big"][-1] - 1) < 1e-6 and abs(sum(p < 0.5 for p in sums["big"]) - 10**6) <= 1


def test_normal_equations_are_the_sum_over_all_rows(spark):
    """Added in two steps over many partitions: the outer products of all rows."""
    import numpy as np

    rows = [(float(i % 7), float(i * i % 11), float(-i % 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(17)
    got = quality_classifier.partition_sums(df, lambda batch: batch.to_numpy(), 3)
    x = np.array(rows)
    assert np.allclose(got, x.T @ x) and np.allclose(quality_classifier.partition_sums(df.limit(0), lambda b: b.to_numpy(), 3), 0)


def test_features_are_random_cosines():
    import numpy as np

    rng = np.random.default_rng(2)
    f = quality_classifier.Features(rng.normal(size=3), rng.uniform(1, 2, 3), rng.normal(size=(3, 8)), rng.uniform(0, 6, 8))
    s = rng.normal(size=(5, 3))
    for row, got in zip(s, f(s), strict=True):
        want = [1.0]
        for j in range(8):
            angle = sum((row[i] - f.mean[i]) / f.scale[i] * f.directions[i][j] for i in range(3)) + f.phases[j]
            want.append((2 / 8) ** 0.5 * np.cos(angle))
        assert np.allclose(got, want)
    # Many directions: inner products come near the Gaussian kernel.
    wide = quality_classifier.Features(np.zeros(3), np.ones(3), rng.normal(size=(3, 40_000)), rng.uniform(0, 2 * np.pi, 40_000))
    z = wide(s)[:, 1:]
    kernel = np.exp(-((s[:, None] - s[None]) ** 2).sum(-1) / 2)
    assert np.abs(z @ z.T - kernel).max() < 0.05


def test_isotonic_map_against_its_definition():
    """At each cell the greatest, over starts before, of the least mean, over ends after."""
    import random

    rng = random.Random(4)
    for _ in range(60):
        tally = [(c, float(rng.randrange(0, n + 1)), n) for c in sorted(rng.sample(range(50), 8)) for n in [rng.randrange(1, 5)]]
        mean = lambda a, b, t=tally: sum(x[1] for x in t[a : b + 1]) / sum(x[2] for x in t[a : b + 1])
        want = [max(min(mean(a, b) for b in range(i, 8)) for a in range(i + 1)) for i in range(8)]
        at, p = quality_classifier.isotonic(tally)
        centre = lambda c: (c + 0.5) / quality_classifier.CELLS * 2 - 0.5
        for (c, _, _), w in zip(tally, want, strict=True):
            import numpy as np

            assert abs(np.interp(centre(c), at, p) - w) < 1e-9


def test_classifier_on_held_out_rows(spark):
    rows = QUERIES["op8_quality"](spark, "/root/testdata/sf0.01").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    for r in rows:
        assert r["held_out"] == (brute.remainder(r["doc_id"], 4) == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held)
    assert right > 0.93
    pairs = [(a["score"], b["score"]) for a in held for b in held if labels[a["doc_id"]] > labels[b["doc_id"]]]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) > 0.9


def test_classifier_of_odd_rows(spark, odd, labels):
    rows = quality_classifier.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in quality_classifier.score(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.score(empty(spark), labels).count() == 0
