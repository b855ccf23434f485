"""Chat records of many layouts to canonical turns, and turns to marked text with a loss mask.

A record's layout is the set of its nested field paths. Its fingerprint is a hash of the
paths, whatever the values and their scalar types; it selects one of the declared
:class:`Layout` mappings, which says where conversation, order, roles and texts are. The
mappings are expressions over parsed JSON, so a new layout is a declaration, not code.
Records of unknown layouts are listed by :func:`unmatched`; they give no turns.

A turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>``. In roles and texts a backslash
is doubled and ``<|`` becomes ``<\\|``, so that no text can hold a control string, and
:func:`read_back` gives both back exactly. A conversation's formatted text is its parts in
order; a part per turn keeps giant conversations out of single rows. Loss falls on the text
of assistants alone.

Defined results: a null text is empty, a null role too; null conversation ids form one
conversation, null turns come first; turns of one number are ordered by their place in the
record, role and text; repeated records are repeated turns; a record that isn't valid JSON
(a null one as well) has no layout; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Scalar types in the printed schema of a record; a null, and a list of unlike items, counts as one.
SCALAR = r"(?<=^|: |<)(?:VOID|VARIANT|BOOLEAN|BIGINT|DOUBLE|STRING|DECIMAL\(\d+,\d+\))(?=$|,|>)"


@dataclass(frozen=True)
class Layout:
    """Where the turns of records with these ``paths`` are.

    ``paths`` name all fields down to scalars, ``a.b`` inside objects and ``a[].b`` inside
    lists; those that end in ``?`` may be absent. Turns are either the items of the list
    ``turns``, whose ``role`` and ``text`` are paths within an item, or, without a list,
    ``parts``: (role or path with ``$.``, path of the text) in order. ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    parts: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()
    conversation: str = "conv_id"
    order: str = "turn"

    def shapes(self) -> list[str]:
        """Every shape that the layout's records can have."""
        always = [p for p in self.paths if not p.endswith("?")]
        free = [p[:-1] for p in self.paths if p.endswith("?")]
        chosen = [always + list(c) for n in range(len(free) + 1) for c in combinations(free, n)]
        out = [shape_of(paths) for paths in chosen]
        if self.turns:  # an empty list shows no fields of its items
            inside = f"{self.turns}[]"
            out += [shape_of([p for p in paths if not p.startswith(inside)] + [inside]) for paths in chosen]
        return list(dict.fromkeys(out))


def shape_of(paths: list[str]) -> str:
    """The normal form of a set of nested paths."""
    fields: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        while head.endswith("[]"):
            head, rest = head[:-2], "[]" + ("." + rest if rest and not rest.startswith("[]") else rest)
        fields.setdefault(head, []).append(rest)

    def value(rests: list[str]) -> str:
        if rests == [""]:
            return "_"
        if rests[0].startswith("[]"):
            return f"ARRAY<{value([r[2:].removeprefix('.') for r in rests])}>"
        return shape_of(rests)

    quoted = lambda k: k if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", k) else "`" + k.replace("`", "``") + "`"
    return "OBJECT<" + ", ".join(f"{quoted(k)}: {value(fields[k])}" for k in sorted(fields)) + ">"


HUMAN = (("human", "user"), ("gpt", "assistant"))
#: Layouts of public instruction and chat collections.
LAYOUTS = (
    Layout("turn", ("conv_id", "turn", "role", "text"), parts=(("$.role", "text"),)),
    Layout("messages", ("conv_id", "turn?", "messages[].role", "messages[].content", "messages[].name?"), turns="messages"),
    Layout(
        "from and value",
        ("conv_id", "turn?", "conversations[].from", "conversations[].value"),
        turns="conversations",
        role="from",
        text="value",
        roles=HUMAN,
    ),
    Layout("nested message", ("conv_id", "turn", "message.author.role", "message.content"), parts=(("$.message.author.role", "message.content"),)),
    Layout("prompt", ("conv_id", "turn?", "prompt"), parts=(("user", "prompt"),)),
    Layout("completion", ("conv_id", "turn?", "completion"), parts=(("assistant", "completion"),)),
    Layout("prompt and completion", ("conv_id", "turn?", "prompt", "completion"), parts=(("user", "prompt"), ("assistant", "completion"))),
    Layout(
        "instruction",
        ("conv_id", "turn?", "system?", "instruction", "input?", "output"),
        parts=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
)


def parsed(records: DataFrame, record: str = "record") -> DataFrame:
    """``__value``, ``__shape``, ``__print`` and ``layout`` of JSON records; null where invalid or not declared."""
    out = records.select(F.try_parse_json(F.col(f"`{record}`")).alias("__value"))
    out = out.withColumn("__shape", F.regexp_replace(F.expr("schema_of_variant(__value)"), SCALAR, "_"))
    out = out.withColumn("__print", F.xxhash64("__shape"))
    known = {shape: layout.name for layout in LAYOUTS for shape in layout.shapes()}
    names = F.create_map(*[x for shape, name in known.items() for x in (F.xxhash64(F.lit(shape)), F.lit(name))])
    return out.withColumn("layout", F.when(F.col("__shape").isNotNull(), F.try_element_at(names, F.col("__print"))))


def _get(value: str, path: str, kind: str = "string") -> str:
    return f"try_variant_get({value}, '$.{path}', '{kind}')"


def _renamed(role: str, layout: Layout) -> str:
    cases = " ".join(f"when '{a}' then '{b}'" for a, b in layout.roles)
    return f"case {role} {cases} else {role} end" if cases else role


def _turns(layout: Layout) -> str:
    """SQL for roles and texts of a record of the layout."""
    if layout.turns:
        items = _get("__value", layout.turns, "array<variant>")
        role = _renamed(_get("m", layout.role), layout)
        return f"transform({items}, m -> named_struct('role', {role}, 'text', {_get('m', layout.text)}))"
    parts = []
    optional = {p[:-1] for p in layout.paths if p.endswith("?")}
    for role, path in layout.parts:
        said = _renamed(_get("__value", role[2:]), layout) if role.startswith("$.") else f"'{role}'"
        one = f"array(named_struct('role', {said}, 'text', {_get('__value', path)}))"
        none = "cast(array() as array<struct<role: string, text: string>>)"
        parts.append(f"if(variant_get(__value, '$.{path}', 'variant') is null, {none}, {one})" if path in optional else one)
    return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0]


def _mapped(layout: Layout) -> str:
    conversation, order = (_get("__value", p, "bigint") for p in (layout.conversation, layout.order))
    return f"named_struct('conv_id', {conversation}, 'turn', {order}, 'said', {_turns(layout)})"


def canonical(records: DataFrame, record: str = "record") -> DataFrame:
    """Turns of JSON records: conv_id, turn, place in the record, role, text and the layout's name."""
    cases = " ".join(f"when '{x.name}' then {_mapped(x)}" for x in LAYOUTS)
    out = parsed(records, record).where("layout is not null").select("layout", F.expr(f"case layout {cases} end").alias("r"))
    out = out.select("layout", "r.conv_id", "r.turn", F.posexplode("r.said").alias("place", "said"))
    role, text = (F.coalesce(f"said.{c}", F.lit("")).alias(c) for c in ("role", "text"))
    return out.select("conv_id", "turn", "place", role, text, "layout")


def unmatched(records: DataFrame, record: str = "record") -> DataFrame:
    """Shapes that no layout is declared for, with their fingerprints and records; invalid records have none."""
    out = parsed(records, record).where("layout is null")
    return out.groupBy(F.col("__shape").alias("shape"), F.col("__print").alias("fingerprint")).agg(F.count("*").alias("records"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """A ``part`` for each turn, and within it the span under the loss mask (code points; null for none)."""
    begin = F.concat(F.lit(BEGIN), escape(F.coalesce("role", F.lit(""))), F.lit(MIDDLE))
    text = escape(F.coalesce("text", F.lit("")))
    lost = F.col("role") == "assistant"
    return turns.select(
        "conv_id",
        "turn",
        "place",
        F.concat(begin, text, F.lit(END)).alias("part"),
        F.when(lost, F.length(begin)).alias("loss_start"),
        F.when(lost, F.length(begin) + F.length(text)).alias("loss_end"),
    )


def read_back(parts: DataFrame) -> DataFrame:
    """``parts`` with the ``role`` and ``text`` that they were made from and the unescaped text under the mask, ``lost``."""
    marks = [re.escape(x) for x in (BEGIN, MIDDLE, END)]
    pattern = "(?s)^{}(.*?){}(.*){}$".format(*marks)
    masked = F.expr("substring(part, loss_start + 1, loss_end - loss_start)")
    return parts.select(
        *parts.columns,
        unescape(F.regexp_extract("part", pattern, 1)).alias("role"),
        unescape(F.regexp_extract("part", pattern, 2)).alias("text"),
        unescape(masked).alias("lost"),
    )


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    current, out = None, []
    for rows in batches:
        for conv_id, role, text, lost, chars in zip(*[c.to_pylist() for c in rows.columns], strict=True):
            if current is None or current[0] != conv_id:
                if current is not None:
                    out.append(current)
                current = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            current[1] += 1
            current[2].update(f"{role}\n{text}\n".encode())
            if lost is not None:
                current[3] += len(lost)
                current[4].update(lost.encode())
            current[5] += chars
        yield _batch(out, schema)
        out = []
    yield _batch([current] if current is not None else [], schema)


def _batch(done: list[list], schema: pa.Schema) -> pa.RecordBatch:
    rows = [(c, n, t.hexdigest(), m, x.hexdigest(), k) for c, n, t, m, x, k in done]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def report(parts: DataFrame) -> DataFrame:
    """Per conversation: turns, digests of the turns and of the text under the mask, read back from the parts.

    Parts are dealt by conversation and sorted; a pass over each partition carries the
    digests, so no conversation is held.
    """
    order = [F.col("turn").asc_nulls_first(), "place", "part"]
    dealt = parts.withColumn("conv_id", F.col("conv_id").cast("long")).repartition("conv_id").sortWithinPartitions("conv_id", *order)
    said = read_back(dealt).select("conv_id", "role", "text", "lost", F.length("part").cast("long").alias("chars"))
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])
    declared = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in names)
    return said.mapInArrow(lambda batches: _digests(batches, schema), declared)
