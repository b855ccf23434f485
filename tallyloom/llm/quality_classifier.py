"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Statistics of all documents are written once (a few numbers per document). Random cosine
features approximate a Gaussian kernel over them; each partition sums its share of the
normal equations, and the sums of the partitions are added by Spark. Raw scores of a
calibration fold are tallied on a grid of fixed size, on which pooled adjacent violators
make a monotone map to probabilities. The matrices on the driver depend on the number of
features alone.

Defined results: a null or empty text has zero counts and is scored like any text;
without labelled rows of both kinds every score is the share of good labels, 0.5 without
any; each row of the label table counts, null labels don't; repeated documents get a row
each; a null id belongs to the learning side, but joins no label; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import id_remainder
from tallyloom.llm.statistics import FIELDS, measured
from tallyloom.session import materialize

#: Cells of the calibration tally, over raw scores from -0.5 to 1.5.
CELLS = 4096
FOLDS = 4


def statistics(x: pd.DataFrame) -> np.ndarray:
    """Document statistics; lengths as logarithms, the rest as rates."""
    chars = np.maximum(x["word_chars"].to_numpy(float), 1)
    words = np.maximum(x["n_words"].to_numpy(float), 1)
    lines = np.maximum(x["n_lines"].to_numpy(float), 1)
    return np.column_stack(
        [
            np.log1p(x["n_words"]),
            np.log1p(x["n_words"] / lines),
            x["word_chars"] / words,
            np.sqrt(x["n_distinct"] / words),
            np.sqrt(x["n_symbols"] / words),
            np.sqrt(x["n_upper"] / chars),
            np.sqrt(x["n_digits"] / chars),
            np.sqrt(x["n_exclaims"] / words),
            np.sqrt(x["n_stops"] / words),
            np.sqrt(x["n_pipes"] / words),
            np.sqrt(x["n_dup_lines"] / lines),
            np.sqrt(x["n_repeat_words"] / words),
            x["n_other"] / chars,
        ]
    )


N_STATISTICS = 13


@dataclass
class Features:
    """Standardised statistics through random cosines, with a constant in front."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def __call__(self, s: np.ndarray) -> np.ndarray:
        z = ((s - self.mean) / self.scale) @ self.directions + self.phases
        return np.column_stack([np.ones(len(s)), np.sqrt(2.0 / len(self.phases)) * np.cos(z)])


def partition_sums(labelled: DataFrame, make, n: int) -> np.ndarray:
    """The sum over all rows of the outer products of ``make(batch)``'s rows, added by Spark.

    Partitions are added in two steps, so that no task adds up a row of every one of them.
    """
    fan = max(1, math.isqrt(labelled.rdd.getNumPartitions()))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n, n))
        for batch in batches:
            rows = make(batch)
            total += rows.T @ rows
        yield pd.DataFrame({"i": np.arange(n), "part": TaskContext.get().partitionId() % fan, "row": list(total)})

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": batch["i"].iloc[:1], "row": [np.sum(np.stack(batch["row"]), axis=0)]})

    parts = labelled.mapInPandas(sums, "i int, part int, row array<double>").groupBy("i", "part")
    rows = parts.applyInPandas(add, "i int, row array<double>").groupBy("i").applyInPandas(add, "i int, row array<double>").collect()
    out = np.zeros((n, n))
    for r in rows:
        out[r["i"]] = r["row"]
    return out


def isotonic(tally: list[tuple[int, float, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators over (cell, sum of labels, rows): cell centres and probabilities."""
    blocks: list[list[float]] = []
    for cell, good, n in sorted(tally):
        blocks.append([good, n, cell, cell])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1][0] += last[0]
            blocks[-1][1] += last[1]
            blocks[-1][3] = last[3]
    at = [c for b in blocks for c in (b[2], b[3])]
    p = [b[0] / b[1] for b in blocks for _ in range(2)]
    return (np.array(at) + 0.5) / CELLS * 2 - 0.5, np.array(p)


def cells(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((raw + 0.5) / 2 * CELLS), 0, CELLS - 1).astype(int)


def score(
    docs: DataFrame,
    labels: DataFrame,
    n_features: int = 256,
    width: float = 3.0,
    ridge: float = 1.0,
    held_out: int = 2,
    calibration: int = 1,
    threshold: float = 0.7,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per document: whether it was held out, the calibrated score and the prediction.

    Fold ``calibration`` of the ids' checksums sets the calibration, the other folds but
    ``held_out`` the regression.
    """
    remainder = id_remainder(F.col(doc_id), FOLDS)
    counted = materialize(
        docs.select(F.col(doc_id).alias("doc_id"), remainder.alias("fold"), measured(F.col(text)).alias("c")).select(
            "doc_id", F.coalesce(F.col("fold").cast("int"), F.lit(0)).alias("fold"), "c.*"
        ),
        "document-counts",
    )
    known = labels.select(F.col("doc_id").alias("__labelled"), F.col("quality").alias("__label")).where("__label in (0, 1)")
    learned = materialize(
        counted.where(F.col("fold") != held_out).join(known, F.col("doc_id") == F.col("__labelled")), "labelled-counts"
    )

    def with_one(batch: pd.DataFrame) -> np.ndarray:
        return np.column_stack([np.ones(len(batch)), statistics(batch)])

    fitting = learned.where(F.col("fold") != calibration)
    moments = partition_sums(fitting, with_one, N_STATISTICS + 1)
    n = max(moments[0, 0], 1.0)
    mean = moments[0, 1:] / n
    scale = np.sqrt(np.maximum(np.diag(moments)[1:] / n - mean**2, 0))
    rng = np.random.default_rng(seed)
    features = Features(
        mean,
        np.where(scale > 1e-9, scale, 1.0),
        rng.normal(size=(N_STATISTICS, n_features)) / width,
        rng.uniform(0, 2 * np.pi, n_features),
    )

    def with_label(batch: pd.DataFrame) -> np.ndarray:
        return np.column_stack([features(statistics(batch)), batch["__label"].to_numpy(float)])

    size = n_features + 2
    normal = partition_sums(fitting, with_label, size)
    penalty = ridge * np.eye(size - 1)
    penalty[0, 0] = 1e-9
    weights = np.linalg.solve(normal[:-1, :-1] + penalty, normal[:-1, -1])

    def raw(batch: pd.DataFrame) -> np.ndarray:
        return features(statistics(batch)) @ weights

    @F.pandas_udf("int")
    def cell(x: pd.DataFrame) -> pd.Series:
        return pd.Series(cells(raw(x)), dtype="int32")

    tally = (
        learned.where(F.col("fold") == calibration)
        .groupBy(cell(F.struct(*FIELDS)).alias("cell"))
        .agg(F.sum("__label").cast("double").alias("good"), F.count("*").alias("n"))
        .collect()
    )
    at, p = isotonic([tuple(r) for r in tally])
    good, rows = sum(r["good"] for r in tally), sum(r["n"] for r in tally)
    if not rows or good in (0, rows):  # one kind of label alone
        share = learned.agg(F.avg("__label")).first()[0]
        at, p = np.array([0.0]), np.array([0.5 if share is None else float(share)])

    @F.pandas_udf("double")
    def calibrated(x: pd.DataFrame) -> pd.Series:
        return pd.Series(np.clip(np.interp(raw(x), at, p), 0, 1))

    return counted.withColumn("score", calibrated(F.struct(*FIELDS))).select(
        "doc_id",
        (F.col("fold") == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
