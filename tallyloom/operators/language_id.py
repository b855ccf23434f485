"""Language of a text from letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import materialize

#: Mean weight per trigram below which the script decides.
FLOOR = -9.0
#: Languages told by their script alone.
SCRIPTS = {"ja": r"\p{InHiragana}", "ko": r"\p{IsHangul}"}
#: Bytes of weights that a row-local model may hold.
ROW_MODEL_BYTES = 64 << 20
#: Numbers that a task holds at once beside its model, and rows of trigrams that it hands on at once.
PIECE = 1 << 20
ROWS_AT_ONCE = 1 << 16


class LanguageModel(NamedTuple):
    """Trained weights, as written tables; the planner knows their size.

    ``lifts`` has one row per trigram with a list of ``lang`` and ``lift``, what the trigram
    adds to a language that showed it; ``bases`` has one row per language with the weight
    of a trigram that it never showed.
    """

    lifts: DataFrame
    bases: DataFrame


def _letters(text: Column) -> Column:
    """Runs of letters in lower case, a blank between them; NULL stays NULL."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def _code(chars: np.ndarray) -> np.ndarray:
    """Three code points a row as one number, 21 bits each."""
    first, second, third = (chars[..., i].astype(np.int64) for i in range(3))
    return (first << 42) | (second << 21) | third


def _grams_of(letters: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams around the letters of one text, as numbers in order, and how often each occurs."""
    chars = np.frombuffer(f" {letters} ".encode("utf-32-le"), dtype="<u4")
    around = np.lib.stride_tricks.sliding_window_view(chars, 3) if len(chars) > 2 else np.empty((0, 3), "<u4")
    return np.unique(_code(around[around[:, 1] != 32]), return_counts=True)


def with_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row per ``word`` of the whole text: runs of letters, in lower case.

    A text without letters keeps one row with a NULL word.
    """
    letters = F.nullif(_letters(F.col(text)), F.lit(""))
    return texts.withColumn("word", F.explode_outer(F.split(letters, " "))).drop(text)


def with_trigrams(words: DataFrame) -> DataFrame:
    """One row per ``gram`` of ``word``; blanks stand for the word's borders."""
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    return (
        words.withColumn("at", F.explode_outer(F.sequence(F.lit(1), F.length("word"))))
        .withColumn("gram", F.substring(padded, F.col("at"), F.lit(3)))
        .drop("at", "word")
    )


def train(labelled: DataFrame, lang: str = "lang", text: str = "text") -> LanguageModel:
    """Add-one trigram weights per language of labelled texts.

    Words are counted per language before they are cut, so the cutting is done once
    per word.
    """
    words = with_words(labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"))).where("word is not null")
    words = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    counts = materialize(with_trigrams(words).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    vocabulary = counts.select("gram").distinct().count()
    bases = counts.groupBy("lang").agg((-F.log(F.sum("n") + vocabulary)).alias("base"))
    lifts = counts.groupBy("gram").agg(F.collect_list(F.struct("lang", F.log(F.col("n") + 1).alias("lift"))).alias("lifts"))
    return LanguageModel(materialize(lifts, "lifts"), materialize(bases, "bases"))


def detect(
    texts: DataFrame, model: LanguageModel, key: str, text: str = "text", floor: float | None = FLOOR
) -> DataFrame:
    """``key, detected, mean_weight``: the language with the highest summed weight.

    Where the best mean weight per trigram is below ``floor``, text with Hiragana becomes
    ``ja`` and text with Hangul ``ko``; other texts without letters get NULL.

    For models of any size; :func:`detect_rows` needs no shuffle if the weights are small. A
    text's trigrams are counted within its row, so only distinct ones meet the weights. A language's score is its
    base times the trigrams plus the lifts of those it showed, so a text meets only languages
    that share a trigram with it, and the one of highest base. Everything that is folded is a
    number, so no fold sorts its rows.
    """
    # The script's place in SCRIPTS, from 1.
    script = F.coalesce(*[F.when(F.col(text).rlike(p), i) for i, p in enumerate(SCRIPTS.values(), 1)])
    lettered = texts.select(F.col(key).alias("_key"), script.alias("script"), F.coalesce(_letters(F.col(text)), F.lit("")).alias("letters"))
    met = _counted(lettered).join(model.lifts, "gram", "left").select("_key", "script", "n", F.posexplode_outer("lifts").alias("i", "l"))
    once = F.when(F.coalesce("i", F.lit(0)) == 0, F.col("n")).otherwise(0)
    per_language = met.groupBy("_key", F.col("l.lang").alias("lang")).agg(
        F.max("script").alias("script"), F.sum(once).alias("grams"), F.sum(F.col("n") * F.col("l.lift")).alias("lift")
    )
    scored = (
        per_language.join(model.bases, "lang", "left")
        .groupBy("_key")
        .agg(
            F.max("script").alias("script"),
            F.sum("grams").alias("grams"),
            F.collect_list(F.when(F.col("lang").isNotNull(), F.struct("lang", "base", "lift"))).alias("found"),
        )
    )
    top = model.bases.agg(F.max_by("lang", F.struct("base", "lang")).alias("lang"), F.max("base").alias("base")).first()
    fallback = F.struct(
        F.lit(top["lang"]).alias("lang"), F.lit(top["base"]).cast("double").alias("base"), F.lit(0.0).alias("lift")
    )
    score = lambda f: F.struct((f["lift"] + f["base"] * F.col("grams")).alias("s"), f["lang"].alias("name"))
    best = F.array_max(F.transform(F.concat("found", F.array(fallback)), score))
    scored = scored.withColumn("best", best)
    named = F.get(F.array(*[F.lit(x) for x in SCRIPTS]), F.col("script") - 1)
    found, mean = _decide(F.col("best"), F.col("grams"), named, floor)
    return scored.select(F.col("_key").alias(key), found.alias("detected"), mean.alias("mean_weight"))


def _counted(lettered: DataFrame) -> DataFrame:
    """``_key, script, gram, n``: a row per distinct trigram of ``letters``; a text without any keeps one, of NULL and 0."""
    schema = T.StructType([*lettered.drop("letters").schema.fields, T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())])

    def rows_of(batch: pa.RecordBatch, at: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        sizes = [max(len(codes), 1) for codes, _ in found]
        codes = np.concatenate([codes if len(codes) else np.array([-1]) for codes, _ in found])
        n = np.concatenate([n if len(n) else np.array([0]) for _, n in found])
        chars = np.stack([(codes >> shift) & 0x1FFFFF for shift in (42, 21, 0)], axis=1)
        chars[codes < 0] = 32
        grams = pa.array(np.ascontiguousarray(chars.astype("<u4")).view("<U3").ravel().tolist(), pa.string(), mask=codes < 0)
        of = pa.array(np.repeat(np.array(at), sizes))
        arrays = [batch.column(0).take(of), batch.column(1).take(of), grams, pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found, held = [], [], 0
            for i, letters in enumerate(batch.column(2)):
                at.append(i)
                found.append(_grams_of(letters.as_py()))
                held += len(found[-1][0])
                if held >= ROWS_AT_ONCE:
                    yield rows_of(batch, at, found)
                    at, found, held = [], [], 0
            if at:
                yield rows_of(batch, at, found)

    return lettered.mapInArrow(count, schema)


def _decide(best: Column, grams: Column, script: Column, floor: float | None) -> tuple[Column, Column]:
    """Language and mean weight from the best struct of score ``s`` and ``name``."""
    some = grams > 0
    mean = F.when(some, best["s"] / grams)
    found = F.when(some, best["name"])
    if floor is not None:
        found = F.when(mean.isNull() | (mean < floor), F.coalesce(script, found)).otherwise(found)
    return found, mean


class RowModel(NamedTuple):
    """Weights that every task holds whole.

    ``weights`` are broadcast: the trigrams as numbers in order, and their lifts, one row per
    trigram, one column per language in the order of ``langs``.
    """

    langs: list[str]
    bases: list[float]
    weights: Broadcast


def row_model(model: LanguageModel, limit: int = ROW_MODEL_BYTES) -> RowModel:
    """The weights as one sorted table; an error beyond ``limit`` bytes, where :func:`detect` is the way."""
    spark = model.bases.sparkSession
    grams, n_langs = model.lifts.count(), model.bases.count()
    size = grams * (8 * n_langs + 48)
    if size > limit:
        raise ValueError(f"{grams} trigrams of {n_langs} languages take {size} bytes, over {limit}; use detect()")
    rows = sorted((r["lang"], r["base"]) for r in model.bases.collect())
    langs, bases = [r[0] for r in rows], [r[1] for r in rows]
    place = {lang: i for i, lang in enumerate(langs)}
    codes, lifts = np.zeros(grams, np.int64), np.zeros((grams, n_langs))
    for i, row in enumerate(model.lifts.toLocalIterator()):
        codes[i] = _code(np.frombuffer(row["gram"].encode("utf-32-le"), dtype="<u4"))
        for weight in row["lifts"]:
            lifts[i, place[weight["lang"]]] = weight["lift"]
    order = np.argsort(codes)
    return RowModel(langs, bases, spark.sparkContext.broadcast((codes[order], lifts[order])))


def _weigher(weights: Broadcast, n_langs: int):
    """Trigrams of a text and the sum of their lifts, one per language."""
    step = max(PIECE // max(n_langs, 1), 1)

    @F.pandas_udf("grams long, lifts array<double>")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, lifts = weights.value
        for batch in batches:
            sizes, sums = [], []
            for letters in batch:
                codes, n = _grams_of(letters)
                total = np.zeros(n_langs)
                at = np.searchsorted(known, codes)
                hit = at < len(known)
                hit[hit] = known[at[hit]] == codes[hit]
                at, times = at[hit], n[hit]
                # Plain sums, in the same order for each language: equal weights stay equal.
                for i in range(0, len(at), step):
                    total += (lifts[at[i : i + step]] * times[i : i + step, None]).sum(axis=0)
                sizes.append(int(n.sum()))
                sums.append(total)
            yield pd.DataFrame({"grams": pd.Series(sizes, dtype="int64"), "lifts": pd.Series(sums, dtype="object")})

    return weigh


def detect_rows(texts: DataFrame, model: RowModel, text: str = "text", floor: float | None = FLOOR) -> DataFrame:
    """``texts`` with ``detected`` and ``mean_weight``, as :func:`detect` finds them, row by row.

    Nothing is shuffled, so it works in a stream as well: every task holds the weights, and a
    text's trigrams are folded into one sum per language.
    """
    letters = F.coalesce(_letters(F.col(text)), F.lit(""))
    lang = lambda i: F.get(F.array(*[F.lit(x) for x in model.langs]), i)
    base = lambda i: F.get(F.array(*[F.lit(x) for x in model.bases]), i)
    score = lambda f: F.array_max(
        F.transform(f["lifts"], lambda lift, i: F.struct((lift + base(i) * f["grams"]).alias("s"), lang(i).alias("name")))
    )
    script = F.coalesce(*[F.when(F.col(text).rlike(p), name) for name, p in SCRIPTS.items()])

    def decided(f: Column) -> Column:
        found, mean = _decide(score(f), f["grams"], script, floor)
        return F.struct(found.alias("detected"), mean.alias("mean_weight"))

    out = texts.withColumn("_weighed", _weigher(model.weights, len(model.langs))(letters))
    out = out.withColumn("_found", F.get(F.transform(F.array("_weighed"), decided), 0))
    return out.withColumns({c: F.col(f"_found.{c}") for c in ("detected", "mean_weight")}).drop("_found", "_weighed")
