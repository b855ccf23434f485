"""The pipeline, stage by stage, against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import brute

import corpus_pipeline
from tallyloom.llm import quality_rules
from tallyloom.llm import queries as _  # noqa: F401
from tallyloom.llm.registry import ORACLES, QUERIES
from tallyloom.session import materialize

SF_DIR = "/root/testdata/sf0.001"
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ten_words(text):
    words = TOKEN.findall(brute.lower(text))
    return {" ".join(words[i : i + 10]) for i in range(len(words) - 9)}, words


def copies(docs):
    """Draws of each document by inverting its source's Poisson distribution."""
    size = defaultdict(int)
    for _, text, source in docs:
        size[source] += len(text.encode()) + 1
    total, weights = sum(size.values()), sum(math.sqrt(v) for v in size.values())
    out = Counter()
    for i, _, source in docs:
        rate = math.sqrt(size[source]) / weights * total / size[source]
        u = (int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        k, term = 0, math.exp(-rate)
        below = term
        while below < u:
            k += 1
            term *= rate / k
            below += term
        out[i] = k
    return +out


def test_stages_and_run(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = {r["doc_id"]: r for r in table.collect()}
    kept = {r["doc_id"] for r in quality_rules.report(table, labels).where("kept").collect()}
    prints = [(i, brute.fingerprint(rows[i]["text"])) for i in sorted(kept)]
    single = {i for (i, _), c in zip(prints, brute.components(prints), strict=True) if i == c}
    windows = set()
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        found, words = ten_words(r["text"])
        assert len(words) >= 10
        windows |= found
    clean = {i for i in single if windows.isdisjoint(ten_words(rows[i]["text"])[0])}
    mixed = copies([(i, rows[i]["text"], rows[i]["source"]) for i in clean])
    groups = defaultdict(int)
    for i, n in mixed.items():
        groups[hashlib.md5(rows[i]["text"].encode()).hexdigest()] += n * (len(rows[i]["text"].encode()) + 1)
    capacity = brute.smallest_capacity([groups[k] for k in sorted(groups)], 8)

    want = [Counter(kept), Counter(single), Counter(clean), mixed, mixed]
    docs = table
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want, strict=True):
        docs = stage(spark, docs, SF_DIR)
        assert Counter(r["doc_id"] for r in docs.select("doc_id").collect()) == expected, name
        if name != "sharding":
            assert docs.columns == table.columns
        docs = materialize(docs, "test-stage")
    for final in (docs, corpus_pipeline.run(spark, SF_DIR)):
        loads = Counter()
        for r in final.collect():
            assert r["text"] == rows[r["doc_id"]]["text"]
            loads[r["shard"]] += len(r["text"].encode()) + 1
        assert max(loads.values()) == capacity


def test_stages_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0


def test_every_operator_has_a_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_odd_documents_through_the_whole_run(spark, tmp_path):
    """Null texts and ids, repeated ids and rows, long texts, clashing columns; and empty tables."""
    good = " ".join(f"word{i}" for i in range(80))
    long = " ".join(f"w{i % 9000}x" for i in range(60_000))
    rows = [
        (1, good, "en", "a", 1, "x"),
        (1, good + " more", "en", "a", 2, "x"),
        (2, good, "en", "a", 3, None),
        (2, good, "en", "a", 3, None),
        (3, None, "en", "b", None, "y"),
        (4, "", None, None, 0, "y"),
        (None, " ".join(f"other{i}" for i in range(70)), "de", None, 9, "z"),
        (5, long, "de", "b", 4, "z"),
        (6, " ".join(f"bench{i}" for i in range(60)), "de", "b", 5, "z"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/full/documents.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/empty/documents.parquet")
    for folder in ("full", "empty"):
        spark.createDataFrame([(1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{folder}/labels.parquet")
        items = [(7, " ".join(f"bench{i}" for i in range(20, 35))), (None, None)]
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/full/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{tmp_path}/full")
        assert docs.columns == schema.replace(" long", "").replace(" string", "").split(", ")
        docs = spark.createDataFrame(docs.collect(), schema)
    out = corpus_pipeline.run(spark, f"{tmp_path}/full")
    got = out.collect()
    assert {r["doc_id"] for r in got} <= {1, 2, None, 5}  # wordless ones, near copies and benchmark texts are gone
    assert len({r["doc_id"] for r in got} & {1, 2}) <= 1
    assert all(0 <= r["shard"] < 8 for r in got)
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
