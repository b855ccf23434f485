"""Cheapest repair of conversations whose turns are missing, blank, repeated, cut off or mislabelled.

Rows are dealt by conversation and sorted by turn; one pass over each sorted partition carries
the state of a shortest-edit search across Arrow batches, so that no conversation has to fit
into memory. A repaired conversation is empty or an optional system turn followed by pairs of
user and assistant turns. Four states stand for what the repaired turns so far end with:
nothing, a system, a user or an assistant turn. Each state keeps its least cost and the order
of its edits among the four (edit strings of different states never are prefixes of each
other, so that order decides all later ties). These cost differences and orders take few
values; a step is looked up by them and by the kind of row. Per row four bytes, a back
pointer for each state, are held in memory up to :data:`SPILL` bytes and beyond that in the
task's own temporary file, as are the rows; a lost executor only means that the task is run again.

Whether an equal row came in an earlier turn is settled before by a partially aggregated
minimum, so the pass doesn't hold the texts it has seen.

Defined results: a null role or text counts as one space, a null turn comes first, a null
conversation id is a conversation; rows of one turn are ordered by role and text, so equal
ones are neighbours and all but the first are duplicates; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize

#: Bytes of rows and of back pointers that a conversation keeps in memory.
SPILL = 1 << 22
#: Rows and characters of text in a batch that leaves the pass.
BATCH_ROWS, BATCH_CHARS = 4096, 1 << 22
#: The six characters that don't count as content.
SPACES = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
#: (state, initial of the next turn): state after it.
MOVES = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
#: State: states that inserted turns lead to, with their number. Inserting a whole pair more only costs.
INSERTS = {
    START: [(START, 0), (USER, 1), (ASSISTANT, 2)],
    SYSTEM: [(SYSTEM, 0), (USER, 1), (ASSISTANT, 2)],
    USER: [(USER, 0), (ASSISTANT, 1)],
    ASSISTANT: [(ASSISTANT, 0), (USER, 1)],
}
#: Insertions that complete the last pair.
FINISH = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
LETTERS = "DKR"
#: What one row adds to an edit string, in ASCII order.
SUFFIXES = sorted("I" * k + x for k in range(3) for x in LETTERS)

#: For each state its cost beyond the least, or none, and its place in the order of edit strings.
State = tuple[tuple[int | None, int], ...]
FIRST: State = ((0, 0), (None, 0), (None, 0), (None, 0))


#: Steps that a worker has met; a plain table, which travels with the functions that use it.
STEPS: dict[tuple[State, str, str], tuple[State, int, int]] = {}


def step(state: State, initial: str, fault: str) -> tuple[State, int, int]:
    """:func:`new_step`, remembered."""
    key = (state, initial, fault)
    if key not in STEPS:
        STEPS[key] = new_step(state, initial, fault)
    return STEPS[key]


def new_step(state: State, initial: str, fault: str) -> tuple[State, int, int]:
    """States after a row, what the least cost grew by, and four back pointers in one number.

    ``initial``: s, u, a or nothing for any other role; ``fault``: ``delete`` or ``truncated``
    or nothing.
    """
    best: dict[int, tuple[int, int, int, int, int]] = {}
    for s, (cost, rank) in enumerate(state):
        if cost is None:
            continue
        options = [(s, 0, "D", DELETE_COST)]  # turns are inserted after a deleted row: D comes before I
        if fault != "delete":
            more = TRUNCATED_COST if fault == "truncated" else 0
            for t, k in INSERTS[s]:
                for letter, role, price in (("K", initial, KEEP_COST), ("R", "u", REROLE_COST), ("R", "a", REROLE_COST)):
                    if (t, role) in MOVES:
                        options.append((MOVES[t, role], k, letter, k * INSERT_COST + price + more))
        for t, k, letter, price in options:
            found = (cost + price, rank, SUFFIXES.index("I" * k + letter), s, k << 2 | LETTERS.index(letter))
            best[t] = min(best.get(t, found), found)
    least = min(b[0] for b in best.values())
    order = sorted(best, key=lambda t: best[t][1:3])
    after = tuple((best[t][0] - least, order.index(t)) if t in best else (None, 0) for t in range(4))
    back = sum((b[3] << 4 | b[4]) << 8 * t for t, b in best.items())
    return after, least, back


@dataclass
class Conversation:
    """What the pass carries of the conversation under way."""

    conv_id: object
    state: State = FIRST
    cost: int = 0
    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    last: tuple | None = None
    back: tempfile.SpooledTemporaryFile = field(default_factory=lambda: tempfile.SpooledTemporaryFile(SPILL))
    kept: tempfile.SpooledTemporaryFile = field(default_factory=lambda: tempfile.SpooledTemporaryFile(SPILL))

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        content = text.rstrip(SPACES)
        fault = ""
        if not content:
            self.blank += 1
            fault = "delete"
        elif seen or self.last == (turn, role, text):
            self.duplicate += 1
            fault = "delete"
        elif content[-1] not in ".!?":
            self.truncated += 1
            fault = "truncated"
        if self.last is not None and self.last[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        self.state, grown, back = step(self.state, initial, fault)
        self.cost += grown
        self.back.write(back.to_bytes(4, "little"))
        data = (role.encode(), text.encode()) if fault != "delete" else (b"", b"")
        self.kept.write(struct.pack("<II", *map(len, data)) + data[0] + data[1])
        self.rows += 1
        self.last = (turn, role, text)

    def edits(self) -> tuple[int, bytearray, int]:
        """Least cost; each row's edit: insertions before it and its letter; insertions at the end."""
        ends = [(c + FINISH[s] * INSERT_COST, rank, s) for s, (c, rank) in enumerate(self.state) if c is not None]
        cost, _, s = min(ends)
        last, out = FINISH[s], bytearray(self.rows)
        block = 1 << 16
        for begin in range((self.rows - 1) // block * block, -1, -block):
            self.back.seek(4 * begin)
            data = self.back.read(4 * min(block, self.rows - begin))
            for i in range(len(data) // 4 - 1, -1, -1):
                pointer = data[4 * i + s]
                out[begin + i], s = pointer & 15, pointer >> 4
        return self.cost + cost, out, last

    def repaired(self) -> Iterator[tuple]:
        """Repaired turns (place, role, text, edit), then the summary with a null place."""
        cost, edits, last = self.edits()
        audit, state, place = [], START, 0

        def inserted(n: int) -> Iterator[tuple]:
            nonlocal state, place
            for _ in range(n):
                role = "assistant" if state == USER else "user"
                state = MOVES[state, role[0]]
                audit.append("I")
                yield place, role, "", "I"
                place += 1

        self.kept.seek(0)
        for edit in edits:
            role_size, text_size = struct.unpack("<II", self.kept.read(8))
            role, text = self.kept.read(role_size).decode(), self.kept.read(text_size).decode()
            yield from inserted(edit >> 2)
            letter = LETTERS[edit & 3]
            audit.append(letter)
            if letter == "D":
                continue
            if letter == "R":
                role = "assistant" if state == USER else "user"
            state = MOVES[state, role[0]]
            yield place, role, text, letter
            place += 1
        yield from inserted(last)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        yield None, None, None, None, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(audit)
        self.back.close()
        self.kept.close()


FIELDS = (
    "place long, role string, text string, edit string, gaps long, blank long, duplicate long, truncated long, illegal long,"
    " cost long, audit string"
)


def _pass(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """From sorted rows (conversation, gone, turn, role, text, seen) to :data:`FIELDS`."""
    fields = [f.split(" ") for f in FIELDS.split(", ")]
    schema = pa.schema([("conv_id", kind)] + [(n, pa.string() if t == "string" else pa.int64()) for n, t in fields])
    held: list[tuple] = []
    chars = 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def finished(conversation: Conversation) -> Iterator[pa.RecordBatch]:
        nonlocal chars
        for out in conversation.repaired():
            held.append((conversation.conv_id, *out, *[None] * (len(fields) - len(out))))
            chars += len(out[2] or "")
            if len(held) >= BATCH_ROWS or chars >= BATCH_CHARS:
                yield batch()
                held.clear()
                chars = 0

    current: Conversation | None = None
    for rows in batches:
        for conv_id, gone, turn, role, text, seen in zip(*[c.to_pylist() for c in rows.columns], strict=True):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    yield from finished(current)
                current = Conversation(conv_id)
            if not gone:
                current.add(turn, role, text, seen)
    if current is not None:
        yield from finished(current)
    if held:
        yield batch()


def repair(rows: DataFrame, gone: str | None = None) -> DataFrame:
    """Repaired turns of conversations (conv_id, turn, role, text), in order within each partition.

    Each conversation gives its repaired turns (``place`` from 0, ``role``, ``text``, ``edit``: K
    kept, R with another role, I inserted) and then, with a null ``place``, its faults, the cost
    and the ``audit``: the initials of all edits, D for deleted rows. Rows whose column ``gone``
    is true are no turns, but their conversations are listed.
    """
    kind = rows.schema["conv_id"].dataType
    no = F.lit(False) if gone is None else F.coalesce(F.col(f"`{gone}`").cast("boolean"), F.lit(False))
    turns = rows.select(
        "conv_id",
        no.alias("gone"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role"), "role", "text")
    turns = turns.withColumn("key", F.unhex(F.sha2(key.cast("binary"), 256)))
    first, last, none = F.min("turn").alias("first"), F.max("turn").alias("last"), F.max(F.col("turn").isNull()).alias("none")
    again = turns.where(~F.col("gone")).groupBy("key").agg(first, last, none)
    again = materialize(again.where("first < last or (none and last is not null)").drop("last"), "repeated-turns")
    seen = F.col("turn").isNotNull() & (F.col("none") | (F.col("turn") > F.col("first")))
    ordered = (
        turns.join(again, "key", "left")
        .select("conv_id", "gone", "turn", "role", "text", F.coalesce(seen, F.lit(False)).alias("seen"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    )
    arrow = pa.int64() if kind.typeName() in ("long", "integer", "short", "byte") else pa.string()
    if arrow == pa.int64():
        ordered = ordered.withColumn("conv_id", F.col("conv_id").cast("long"))
    declared = "long" if arrow == pa.int64() else "string"
    return ordered.mapInArrow(lambda batches: _pass(batches, arrow), f"conv_id {declared}, {FIELDS}")


def _digests(batches: Iterator[pa.RecordBatch], summary: list[str]) -> Iterator[pa.RecordBatch]:
    digest, empty = hashlib.sha256(), True
    for rows in batches:
        out = []
        for place, role, text in zip(*[rows.column(n).to_pylist() for n in ("place", "role", "text")], strict=True):
            if place is None:
                out.append(digest.hexdigest())
                digest, empty = hashlib.sha256(), True
            else:
                digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                empty = False
        told = rows.filter(pc.is_null(rows.column("place"))).select(summary)
        yield pa.RecordBatch.from_arrays([*told.columns, pa.array(out, pa.string())], names=[*summary, "repaired_sha256"])


def report(repaired: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`'s result, not shuffled since: the summary and the digest of its turns."""
    summary = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    kinds = ", ".join(f"`{c}` {repaired.schema[c].dataType.simpleString()}" for c in summary)
    return repaired.mapInArrow(lambda batches: _digests(batches, summary), f"{kinds}, repaired_sha256 string")
