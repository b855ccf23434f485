"""Conversation repair against all edits of short conversations."""

import binascii
import hashlib
import os
import random
import re
from itertools import groupby

import pytest

from tallyloom.llm import conversation_repair, queries
from tallyloom.llm.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SPACES = " \t\n\x0b\x0c\r"
BEGINS = re.compile(r"(s?(ua)*u?)?")
WHOLE = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """First fault of each (turn, role, text)."""
    seen, out = set(), []
    for _, role, text in rows:
        content = text.strip(SPACES)
        if not content:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if content[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def all_repairs(rows):
    """Least cost, audit and repaired turns, from every edit that can still end well."""
    ways = {("", ()): 0}
    kinds = faults(rows)

    def inserted(ways):
        grown = dict(ways)
        for (audit, turns), cost in ways.items():
            for more in (("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")):
                new = turns + tuple((r, "") for r in more)
                if BEGINS.fullmatch("".join(r[:1] for r, _ in new)):
                    grown[audit + "I" * len(more), new] = cost + 2 * len(more)
        return grown

    for (_, role, text), kind in zip(rows, kinds, strict=True):
        after = {}
        for (audit, turns), cost in inserted(ways).items():
            options = [("D", turns, 3)]
            if kind not in ("blank", "duplicate"):
                for letter, r, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    options.append((letter, turns + ((r, text),), price + (kind == "truncated")))
            for letter, new, price in options:
                if BEGINS.fullmatch("".join(r[:1] or "?" for r, _ in new)):
                    after[audit + letter, new] = cost + price
        least = min(after.values())
        ways = {k: c for k, c in after.items() if c <= least + 8}  # eight pays for any way out of a state
    ends = [(c, a, t) for (a, t), c in inserted(ways).items() if WHOLE.fullmatch("".join(r[:1] for r, _ in t))]
    return min(ends)


def dynamic(rows):
    """The same with whole strings for each ending, for longer conversations."""
    best = {"": (0, "", ())}
    for (_, role, text), kind in zip(rows, faults(rows), strict=True):
        after = {}
        for end, (cost, audit, turns) in best.items():
            options = [(audit + "D", turns, cost + 3)]
            if kind not in ("blank", "duplicate"):
                for n in range(3):
                    for first in ("user", "assistant"):
                        second = "assistant" if first == "user" else "user"
                        more = (first, second)[:n]
                        for letter, r, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                            new = turns + tuple((m, "") for m in more) + ((r, text),)
                            letters = audit + "I" * n + letter
                            options.append((letters, new, cost + 2 * n + price + (kind == "truncated")))
            for letters, new, price in options:
                initials = "".join(r[:1] or "?" for r, _ in new[-4:])
                if not re.fullmatch(r"(ua|au)*[ua]?" if len(new) > 4 else BEGINS, initials):
                    continue
                key = "" if not new else "s" if new[-1][0][:1] == "s" else new[-1][0][:1]
                if key not in after or (price, letters) < after[key][:2]:
                    after[key] = (price, letters, new)
        best = after
    ends = []
    for end, (cost, audit, turns) in best.items():
        more = {"": (), "s": ("user", "assistant"), "u": ("assistant",), "a": ()}[end]
        ends.append((cost + 2 * len(more), audit + "I" * len(more), turns + tuple((m, "") for m in more)))
    return min(ends)


def want(conv_id, rows, search):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    cost, audit, turns = search(rows)
    kinds = faults(rows)
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return (conv_id, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def check(spark, conversations, search):
    rows = [(c, t, r, x) for c, turns in conversations.items() for t, r, x in turns]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r[0]: tuple(r) for r in conversation_repair.report(conversation_repair.repair(df)).collect()}
    assert len(got) == len(conversations)
    for c, turns in conversations.items():
        filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
        assert got[c] == want(c, filled, search), filled


def conversations(seed, count, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "unknown"]
    texts = ["Yes.", "No!", "Why", "", " \n", None, "a.", "b?", "c.", "d. ", "é", "e."]
    out = {}
    for c in range(count):
        n = rng.randrange(1, longest + 1)
        out[c] = [(rng.choice([None, i, i, i, i + rng.randrange(3)]), rng.choice(roles), rng.choice(texts)) for i in range(n)]
    return out


def test_short_conversations_against_all_edits(spark):
    check(spark, conversations(1, 400, 4), all_repairs)


@pytest.mark.parametrize("longest", [9, 60])
def test_longer_conversations(spark, longest):
    check(spark, conversations(longest, 300, longest), dynamic)


def test_spilled_state_and_many_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    monkeypatch.setattr(conversation_repair, "SPILL", 64)
    monkeypatch.setattr(conversation_repair, "BATCH_ROWS", 5)
    try:
        check(spark, conversations(5, 30, 90) | {99: [(i, "user", f"{i % 700}.") for i in range(3000)]}, dynamic)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def damaged(conv_id, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    h = binascii.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
    if h == 0:
        return []
    if h == 1:
        text = ""
    if h == 2:
        text = re.sub("[.!?]", "", text)
    if h == 4:
        role = "user"
    return [(turn, role, text)] * (2 if h == 3 else 1)


def test_query(spark):
    key = lambda r: r[0]
    rows = sorted((tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()), key=key)
    expected = [want(c, [x for r in group for x in damaged(*r)], dynamic) for c, group in groupby(rows, key)]
    got = sorted(tuple(r) for r in QUERIES["op12_repair"](spark, SF_DIR).collect())
    assert got == sorted(expected) and any(r[6] for r in got)


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, place long, gone boolean"
    rows = [(None, None, None, None, 1, None), (None, 3, "user", "a.", 2, False), (5, 1, "user", "x." * 60_000, 3, None), (6, 1, "user", "y", 4, True)]
    df = spark.createDataFrame(rows, schema)
    got = {r[0]: tuple(r) for r in conversation_repair.report(conversation_repair.repair(df, gone="gone")).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[6] == (6, 0, 0, 0, 0, 0, 0, "", empty)
    assert got[None][1:8] == (0, 1, 0, 0, 1, 5, "DKI") and got[5][6:8] == (2, "KI")
    turns = conversation_repair.repair(df, gone="gone").where("place is not null and conv_id = 5").collect()
    assert [(r.place, r.role, r.edit) for r in sorted(turns)] == [(0, "user", "K"), (1, "assistant", "I")]
    assert conversation_repair.report(conversation_repair.repair(df.limit(0))).collect() == []
    dealt = queries.damaged(df)
    assert dealt.where("role is null or text is null").count() == 0
    text = df.withColumn("conv_id", df.conv_id.cast("string"))
    assert {r[0] for r in conversation_repair.report(conversation_repair.repair(text)).collect()} == {None, "5", "6"}
