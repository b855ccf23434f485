"""Benchmark decontamination by word n-grams, with built-in functions alone.

Benchmark texts become windows of ``n`` words (a shorter text is one window). They travel to
every task as one hashed vector, a slot per hash with the windows filed there: each token
window of a document is looked up by a 64-bit hash and a hit is verified by the words
themselves, so a document is scanned once and nothing of it is shuffled. The vector's size
is checked; a benchmark beyond ``limit`` bytes takes a join of the hashes of all token
windows instead, whose hits are verified by their words alike.

Defined results: a null or wordless text has no words, no hits and no items; a null or
wordless benchmark text gives no window; a null item id is written as the empty string;
equal item ids are one item; repeated documents get a row each; empty tables give no
rows or no hits; :func:`report` ignores other columns, :func:`remove` keeps all, also
those named like a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import UPPER, lower_ascii, row_ids
from tallyloom.session import materialize

#: Fixed value: what separates words, once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for original text.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of benchmark windows that may travel to every task; more are joined.
VECTOR_BYTES = 128 << 20


def words_of(text: Column) -> Column:
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def words_sql(text: str) -> str:
    separators = SEPARATORS.replace("\\", "\\\\")
    lower = f"translate(coalesce(`{text}`, ''), '{UPPER}', '{UPPER.lower()}')"
    return f"filter(split({lower}, '{separators}'), x -> x <> '')"


def benchmark_windows(benchmark: DataFrame, n: int, item_id: str, text: str) -> DataFrame:
    """``gram``, ``len`` and ``item``: each distinct window of each item."""
    words = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("w"))
    windows = words.where(F.size("w") > 0).selectExpr(
        "item", f"least(size(w), {n}) as len", f"explode(sequence(1, greatest(size(w) - {n - 1}, 1))) as at", "w"
    )
    return windows.selectExpr("item", "len", "array_join(slice(w, at, len), ' ') as gram").distinct()


def vector_of(windows: DataFrame) -> tuple[DataFrame, int]:
    """One written row with a slot per hash, each the windows filed there, and the number of slots."""
    distinct = windows.select("gram").distinct().withColumn("h", F.xxhash64(F.split("gram", " ")))
    slots = max(2 * distinct.count(), 1)
    filed = distinct.groupBy(F.pmod("h", F.lit(slots)).alias("slot")).agg(F.collect_list(F.struct("h", "gram")).alias("entries"))
    every = windows.sparkSession.range(slots).withColumnRenamed("id", "slot").join(filed, "slot", "left")
    in_order = F.array_sort(F.collect_list(F.struct("slot", F.coalesce("entries", F.array()).alias("entries"))))
    return materialize(every.agg(F.transform(in_order, lambda x: x["entries"]).alias("vector")), "window-vector"), slots


NOTHING = "cast(array() as array<struct<start: int, len: int, gram: string>>)"


def hits_expr(lengths: list[int], slots: int) -> str:
    """SQL for the verified hits in the word array ``w`` by the vector ``v``: structs of start (from 1), len and gram."""
    parts = [NOTHING]
    for k in lengths:
        at = lambda h: f"get(v, cast(pmod({h}, {slots}L) as int))"
        hashed = f"transform(sequence(1, size(w) - {k - 1}), i -> named_struct('i', i, 'h', xxhash64(slice(w, i, {k}))))"
        likely = f"filter({hashed}, x -> exists({at('x.h')}, e -> e.h = x.h))"
        shown = f"transform({likely}, x -> named_struct('at', x.h, 's', named_struct('start', x.i, 'len', {k}, 'gram', array_join(slice(w, x.i, {k}), ' '))))"
        verified = f"transform(filter({shown}, x -> exists({at('x.at')}, e -> e.gram = x.s.gram)), x -> x.s)"
        parts.append(f"if(size(w) >= {k}, {verified}, {NOTHING})")
    return f"concat({', '.join(parts)})"


#: Words covered by the sorted, possibly overlapping spans ``spans`` (start, len).
COVERED = """
aggregate(array_sort(spans), named_struct('end', 0, 'n', 0),
  (a, s) -> named_struct(
    'end', greatest(a.end, s.start + s.len),
    'n', a.n + greatest(0, s.start + s.len - greatest(s.start, a.end))),
  a -> cast(a.n as bigint))
"""


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    limit: int = VECTOR_BYTES,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Word counts and hits of every document, and the benchmark's windows.

    The first frame has the columns of ``docs``, ``__row``, ``n_words`` and ``spans``, an
    array of (start, len, gram) of the words covered.
    """
    windows = materialize(benchmark_windows(benchmark, n, item_id, item_text), "benchmark-windows")
    sizes = windows.groupBy("len").agg(F.sum(F.octet_length("gram") + 96).alias("bytes")).collect()  # n rows at most
    lengths = sorted(r["len"] for r in sizes)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "spans")]
    if sum(r["bytes"] for r in sizes) <= limit:
        vector, slots = vector_of(windows)
        # A variable of a lambda holds the words: they are split once per row. A column of an
        # earlier projection would not do, since a filter that the optimizer moves below it
        # repeats the column's whole expression in every inner loop. The vector is named once for
        # the like reason: a column used twice would be copied into every row.
        once = F.expr(
            f"transform(array(__vector), v -> transform(array({words_sql(text)}), w -> named_struct('n_words',"
            f" cast(size(w) as bigint), 'spans', {hits_expr(lengths, slots)}))[0])[0]"
        )
        found = row_ids(docs).withColumn("__vector", vector.scalar()).withColumn("__found", once)
        return found.select(*kept, "__row", F.col("__found.n_words"), F.col("__found.spans")), windows
    counted = row_ids(docs).withColumn("w", words_of(F.col(text)))
    every = ", ".join(
        f"if(size(w) >= {k}, transform(sequence(1, size(w) - {k - 1}), i -> named_struct('start', i, 'len', {k},"
        f" 'h', xxhash64(slice(w, i, {k})))), cast(array() as array<struct<start: int, len: int, h: bigint>>))"
        for k in lengths
    )
    hashed = windows.select("len", "gram", F.xxhash64(F.split("gram", " ")).alias("h")).distinct()
    hit = (
        counted.select(F.col("__row").alias("__of"), F.explode(F.expr(f"concat({every})")).alias("x"))
        .select("__of", "x.*")
        .join(hashed, ["len", "h"])
        .groupBy("__of")
        .agg(F.collect_list(F.struct("start", "len", "gram")).alias("__spans"))
    )
    found = counted.join(materialize(hit, "likely-hits"), F.col("__row") == F.col("__of"), "left")
    verified = F.expr(f"coalesce(filter(__spans, s -> s.gram = array_join(slice(w, s.start, s.len), ' ')), {NOTHING})")
    return found.select(*kept, "__row", F.size("w").cast("long").alias("n_words"), verified.alias("spans")), windows


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document: words, covered words, items found and whether it is contaminated."""
    text = options.get("text", "text")
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found, windows = find(narrow, benchmark, n, **(options | {"text": "text"}))
    found = materialize(
        found.withColumn("n_hit", F.expr(COVERED)).select("__row", "doc_id", "n_words", "n_hit", "spans"), "hits"
    )
    items = (
        found.where(F.size("spans") > 0)
        .select("__row", F.explode(F.expr("array_distinct(transform(spans, s -> s.gram))")).alias("gram"))
        .join(windows.select("gram", "item"), "gram")
        .groupBy(F.col("__row").alias("__of"))
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    items = F.coalesce("items", F.array().cast("array<string>")), items
    return found.join(items[1], F.col("__row") == F.col("__of"), "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items[0]).cast("long").alias("n_items"),
        F.sha2(F.array_join(items[0], ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "documents", n: int = 10, **options) -> DataFrame:
    """``docs`` without contaminated documents, or with the covered words cut out of their texts.

    Cutting leaves what separates the words. Documents without hits stay as they are.
    """
    text = options.get("text", "text")
    own = {c: f"__own_{c}" for c in docs.columns if c in ("n_words", "spans")}
    found, _ = find(docs.withColumnsRenamed(own), benchmark, n, **options)
    columns = [F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns]
    if what == "documents":
        return found.where(F.size("spans") == 0).select(*columns)
    if what != "spans":
        raise ValueError(f"documents or spans, not {what}")
    original = F.col(f"`{text}`")
    cut = found.withColumn("__gaps", F.split(original, ANY_CASE_WORD, -1)).withColumn(
        "__words", F.regexp_extract_all(original, F.lit(ANY_CASE_WORD), F.lit(0))
    )
    covered = cut.withColumn(
        "__covered", F.expr("array_distinct(flatten(transform(spans, s -> sequence(s.start, s.start + s.len - 1))))")
    )
    rebuilt = F.expr(
        "concat(__gaps[0], array_join(transform(__words, (x, i) -> concat("
        "if(array_contains(__covered, i + 1), '', x), __gaps[i + 1])), ''))"
    )
    return covered.withColumn(text, F.when(F.size("spans") > 0, rebuilt).otherwise(original)).select(*columns)
