"""Language detection and external commands."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import balance as B
from tallyloom.operators.language_id import detect, detect_rows, row_model, train
from tallyloom.operators.process import map_partitions, pipe_rows
from tallyloom.workload.genomes import N_PARTS, PLAN_SQL, SAM, mapped
from tallyloom.workload.registry import query, table

DETECTED = r"""
with words as (
  select doc_id, lang, unnest(string_split(trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')), ' ')) as word from documents),
per_doc as (select doc_id, lang, word, count(*) as n from words where word <> '' group by all),
grams as (
  select doc_id, lang, substring(' ' || word || ' ', cast(i as bigint), 3) as gram, sum(n) as n
  from (select *, unnest(range(1, length(word) + 1)) as i from per_doc) group by all),
profile as (select doc_id % 2 as p, lang, gram, sum(n) as c from grams group by all),
size as (select p, lang, -ln(sum(c) + v) as base
         from profile join (select p, count(distinct gram) as v from profile group by p) using (p) group by p, lang, v),
total as (select doc_id, 1 - doc_id % 2 as p, sum(n) as g from grams group by doc_id),
lift as (select d.doc_id, f.lang, sum(d.n * ln(f.c + 1)) as l
         from grams d join profile f on f.p = 1 - d.doc_id % 2 and f.gram = d.gram group by all),
scored as (select doc_id, s.lang, coalesce(l, 0) + g * base as score from total join size s using (p) left join lift using (doc_id, lang))
select doc_id, detected from documents left join (select doc_id, arg_max(lang, score) as detected from scored group by doc_id) using (doc_id)
"""


@query("detect_language", DETECTED)
def detect_language(spark, sf_dir):
    """Each half of the documents by a model of the other half."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    halves = [documents.where(F.col("doc_id") % 2 == p) for p in (0, 1)]
    found = [detect(halves[p], train(halves[1 - p]), "doc_id") for p in (0, 1)]
    return found[0].unionByName(found[1]).select("doc_id", "detected")


@query("detect_language_rows", DETECTED)
def detect_language_rows(spark, sf_dir):
    """The same without a shuffle of texts: the weights travel to the rows."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    halves = [documents.where(F.col("doc_id") % 2 == p) for p in (0, 1)]
    found = [detect_rows(halves[p], row_model(train(halves[1 - p]))) for p in (0, 1)]
    return found[0].unionByName(found[1]).select("doc_id", "detected")


@query("pipe_upper", "select doc_id || ' ' || upper(source) as value from documents")
def pipe_upper(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.concat_ws(" ", "doc_id", "source").alias("value"))
    return pipe_rows(lines, ["tr", "a-z", "A-Z"])


def _first_and_last(index, batches):
    """Rows, first and last coordinate of a sorted partition."""
    import pandas as pd

    rows, first, last, ordered = 0, None, None, True
    for batch in batches:
        if batch.empty:
            continue
        place = batch["ref_index"].astype("int64") * (1 << 32) + batch["pos"]
        ordered = ordered and place.is_monotonic_increasing and (last is None or last <= place.iloc[0])
        first = place.iloc[0] if first is None else first
        last, rows = place.iloc[-1], rows + len(batch)
    if rows:
        (first_ref, first_pos), (last_ref, last_pos) = divmod(int(first), 1 << 32), divmod(int(last), 1 << 32)
        yield pd.DataFrame(
            [(index, rows, first_ref, first_pos, last_ref, last_pos, ordered)],
            columns=["partition", "rows", "first_ref", "first_pos", "last_ref", "last_pos", "ordered"],
        )


@query(
    "region_map",
    f"""with recursive {SAM}, {PLAN_SQL}, x as (select p.partition, ref, pos from mapped join plan p on ref = ref_index)
    select partition, count(*) as rows, arg_min(ref, (ref, pos)) as first_ref, arg_min(pos, (ref, pos)) as first_pos,
           arg_max(ref, (ref, pos)) as last_ref, arg_max(pos, (ref, pos)) as last_pos, true as ordered from x group by partition""",
)
def region_map(spark, sf_dir):
    routed = B.balance(mapped(spark, sf_dir), "ref_index", N_PARTS).select("ref_index", "pos")
    schema = "partition int, rows bigint, first_ref int, first_pos int, last_ref int, last_pos int, ordered boolean"
    return map_partitions(routed, ["ref_index", "pos"], _first_and_last, schema)
