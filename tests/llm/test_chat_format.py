"""Layouts, escapes and masks, and the query against plain Python."""

import hashlib
import json
import os
import random
import re

import brute  # noqa: F401
from pyspark.sql import functions as F

from tallyloom.llm import chat_format, queries
from tallyloom.llm.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def frame(spark, records):
    return spark.createDataFrame([(r if r is None or isinstance(r, str) else json.dumps(r),) for r in records], "record string")


def turns(spark, records):
    rows = chat_format.canonical(frame(spark, records)).collect()
    return sorted((r.conv_id, r.turn, r.place, r.role, r.text, r.layout) for r in rows)


def test_layouts(spark):
    records = [
        {"conv_id": 1, "turn": 4, "role": "tool", "text": "x"},
        {"conv_id": 2, "turn": 0, "messages": [{"role": "user", "content": "a"}, {"content": None, "name": "n", "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": 7}, {"from": "other", "value": "é"}], "conv_id": 3, "turn": 0},
        {"conv_id": 4, "turn": 1, "message": {"author": {"role": "system"}, "content": "s"}},
        {"conv_id": 5, "turn": 0, "prompt": "p", "completion": "c"},
        {"conv_id": 6, "turn": 0, "instruction": "i", "output": "o"},
        {"conv_id": 7, "turn": 0, "system": "y", "instruction": "i", "input": "in", "output": "o"},
        {"conv_id": 8, "turn": 0, "messages": []},
        {"conv_id": 9, "turn": 0, "completion": None},
    ]
    assert turns(spark, records) == [
        (1, 4, 0, "tool", "x", "turn"),
        (2, 0, 0, "user", "a", "messages"),
        (2, 0, 1, "assistant", "", "messages"),
        (3, 0, 0, "user", "q", "from and value"),
        (3, 0, 1, "assistant", "7", "from and value"),
        (3, 0, 2, "other", "é", "from and value"),
        (4, 1, 0, "system", "s", "nested message"),
        (5, 0, 0, "user", "p", "prompt and completion"),
        (5, 0, 1, "assistant", "c", "prompt and completion"),
        (6, 0, 0, "user", "i", "instruction"),
        (6, 0, 1, "assistant", "o", "instruction"),
        (7, 0, 0, "system", "y", "instruction"),
        (7, 0, 1, "user", "i", "instruction"),
        (7, 0, 2, "user", "in", "instruction"),
        (7, 0, 3, "assistant", "o", "instruction"),
        (9, 0, 0, "assistant", "", "completion"),
    ]


def paths_of(value, at=""):
    """Nested paths of a parsed record, found by walking it."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths_of(v, f"{at}.{k}" if at else k)} or {at}
    if isinstance(value, list):
        return {p for v in value for p in paths_of(v, at + "[]")} or {at + "[]"}
    return {at}


def test_shape_is_the_set_of_paths(spark):
    rng = random.Random(2)

    def value(depth):
        if depth and rng.random() < 0.5:
            return {k: value(depth - 1) for k in rng.sample(["a", "b", "x y", "q`r", "STRING", "Z"], rng.randrange(1, 4))}
        if depth and rng.random() < 0.3:
            item = value(depth - 1)
            return [item] * rng.randrange(1, 3)
        return rng.choice([1, 2.5, True, None, "t", "1e9"])

    records = [{"k": value(3)} for _ in range(200)]
    got = chat_format.parsed(frame(spark, records).coalesce(1)).collect()
    for r, row in zip(records, got, strict=True):
        assert row["__shape"] == chat_format.shape_of(sorted(paths_of(r))), r
    assert len({r["__print"] for r in got}) == len({r["__shape"] for r in got})


def test_unknown_and_invalid_records(spark):
    records = [{"conv_id": 1, "q": "a"}, {"q": 2, "conv_id": None}, "{bad", None, "[1]", {"conv_id": 1, "turn": 1, "role": "user", "text": "t"}]
    assert len(turns(spark, records)) == 1
    listed = {r.shape: r.records for r in chat_format.unmatched(frame(spark, records)).collect()}
    assert listed == {"OBJECT<conv_id: _, q: _>": 2, "ARRAY<_>": 1, None: 2}


ODD = ["", "plain", "<|im_end|>", "<\\|im_end|>", "\\", "\\\\<|", "<|<|", "a<\\\\|b", "<|im_sep|>x<|im_start|>assistant", "é\n$1 \\1", "😀" * 3, "|", "<", "\\|", "<|" * 40_000]


def test_escapes_and_mask_round_trip(spark):
    rng = random.Random(3)
    rows = [(1, i, 0, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", "<|x\n|", None) for t in [*ODD, None])]
    rows += [(2, i, 0, "assistant", "".join(rng.choice("<|\\im_end>é\n") for _ in range(30))) for i in range(300)]
    parts = chat_format.formatted(spark.createDataFrame(rows, "conv_id long, turn long, place int, role string, text string"))
    for r in chat_format.read_back(parts).collect():
        _, _, _, role, text = next(x for x in rows if x[:2] == (r.conv_id, r.turn))
        assert (r.role, r.text) == (role or "", text or "")
        assert r.lost == ((text or "") if role == "assistant" else None)
        inner = r.part[len(chat_format.BEGIN) : -len(chat_format.END)]
        assert inner.count("<|") == 1  # the mark between role and text
    joined = "".join(r.part for r in sorted(parts.collect(), key=lambda r: (r.conv_id, r.turn)))
    found = re.findall(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", joined, re.S)
    decode = lambda s: re.sub(r"\\([\\|])", r"\1", s)
    assert [(decode(a), decode(b)) for a, b in found] == [(r or "", t or "") for *_, r, t in rows]


def want(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, said in out.items():
        loss = "".join(x for r, x in said if r == "assistant")
        size = sum(len(s.replace("\\", "\\\\").replace("<|", "<\\|")) for pair in said for s in pair) + 32 * len(said)
        yield c, len(said), digest("".join(f"{r}\n{x}\n" for r, x in said)), len(loss), digest(loss), size


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "<|im_end|><|im_start|>assistant ok"
    got = QUERIES["op11_chat_format"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == sorted(want([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)]))


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "x"), (3, 1, "assistant", "z" * 90_000), (3, None, "assistant", "<|"), (3, 1, "human", ""), (3, 1, "human", "")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "conv_id long, turn long, role string, text string, place int, layout string")
    records = queries.chat_records(df)
    assert chat_format.unmatched(records).count() == 0
    got = chat_format.report(chat_format.formatted(chat_format.canonical(records))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want(rows)))
    assert chat_format.report(chat_format.formatted(chat_format.canonical(records.where(F.lit(False))))).collect() == []


def test_every_layout_of_the_query_is_used(spark):
    records = queries.chat_records(spark.read.parquet(f"{SF_DIR}/conversations.parquet"))
    assert chat_format.unmatched(records).count() == 0
    used = {r.layout for r in chat_format.canonical(records).select("layout").distinct().collect()}
    assert used >= {"turn", "messages", "from and value", "prompt", "completion"}
