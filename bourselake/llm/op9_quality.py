"""Quality by a support vector machine on Naive Bayes features.

Features are indicators of hashed byte pairs and triples. Their class log-count ratios
are counted over all labelled training rows, combined per task before the shuffle; the
table has one row per feature, bounded by the hash space. The linear hinge-loss model is
fitted by dual coordinate descent on a sample of labelled rows bounded by ``SAMPLE``,
and its margin is turned into a probability on a part of the sample kept out of the fit.
Every document is scored whole, in the scan.

Only documents that may have a label are moved for the join with the labels.

Defined cases: a null or empty text has no feature and gets the score of the bias; a
null label is none; several labels of a document are averaged and rounded up at one
half; without labels of both classes every score is the share of label 1 (one half
without labels); rows with a null id count as training rows. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.llm.common import bound_batches, id_remainder, mark_possible
from bourselake.session import staged

PAIRS, TRIPLE_BITS = 1 << 16, 18
FEATURES = PAIRS + (1 << TRIPLE_BITS)
#: Labelled rows the linear model is fitted on, at most; one in five calibrates it.
SAMPLE = 6_000
PASSES, PENALTY, ACCEPT = 12, 1.0, 0.7


def features(text: str | None) -> np.ndarray:
    """Ids of the hashed byte pairs and triples that occur, ascending."""
    codes = np.frombuffer((text or "").encode(), dtype=np.uint8).astype(np.uint32)
    if len(codes) < 2:
        return np.empty(0, dtype=np.int64)
    pairs = (codes[:-1] << 8) | codes[1:]
    triples = (pairs[:-1] << 8) | codes[2:]
    mixed = (triples * np.uint32(2654435761)) >> np.uint32(32 - TRIPLE_BITS)
    there = np.zeros(FEATURES, dtype=bool)
    there[pairs] = True
    there[PAIRS + mixed.astype(np.int64)] = True
    return np.flatnonzero(there)


def labelled_rows(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, text, label) of the training documents that have a label."""
    known = (
        labels.filter(F.col(name).isNotNull() & F.col("doc_id").isNotNull())
        .filter(id_remainder(4) != 2)
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg((F.avg(name) >= 0.5).cast("int").alias("label"))
    )
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return (
        mark_possible(own, known.select("doc_id"), "doc_id", "_maybe")
        .filter("_maybe")
        .drop("_maybe")
        .join(known, "doc_id")
    )


def class_counts(rows: DataFrame) -> DataFrame:
    """(feature, with_0, with_1) documents; feature -1 counts the classes."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, FEATURES + 1), dtype=np.int64)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                seen[label, 0] += 1
                seen[label, features(text) + 1] += 1
        there = np.flatnonzero(seen.any(axis=0))
        yield pd.DataFrame(
            {"feature": there - 1, "with_0": seen[0, there], "with_1": seen[1, there]}
        )

    counted = rows.select("text", "label").mapInPandas(
        count, "feature bigint, with_0 bigint, with_1 bigint"
    )
    return counted.groupBy("feature").agg(
        F.sum("with_0").alias("with_0"), F.sum("with_1").alias("with_1")
    )


def log_ratios(counted: pd.DataFrame) -> tuple[np.ndarray, int, int]:
    """Smoothed log-count ratio of every feature; rows of class 0 and 1."""
    with_ = np.ones((2, FEATURES), dtype=np.float64)
    classes = np.zeros(2, dtype=np.int64)
    for side, name in enumerate(("with_0", "with_1")):
        own = counted["feature"] >= 0
        with_[side, counted.loc[own, "feature"]] += counted.loc[own, name]
        classes[side] = counted.loc[~own, name].sum()
    share = with_ / with_.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0]), int(classes[0]), int(classes[1])


def scaled(text: str | None, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and their ratios, to length one."""
    ids = features(text)
    values = ratios[ids]
    norm = np.sqrt(values @ values)
    return ids, values / norm if norm else values


def dual_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, passes: int, penalty: float
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, one dual variable at a time.

    The bias is a feature that is one everywhere. Variables are visited in an order
    drawn anew, from a fixed seed, in each pass. Rows of the rarer class weigh more,
    so that both classes have the same total.
    """
    weights, bias = np.zeros(FEATURES), 0.0
    alpha = np.zeros(len(rows))
    squares = np.array([float(v @ v) + 1.0 for _, v in rows])
    share = np.where(signs > 0, np.mean(signs > 0), np.mean(signs < 0))
    upper = penalty * 0.5 / share
    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            ids, values = rows[i]
            slope = signs[i] * (weights[ids] @ values + bias) - 1.0
            now = min(max(alpha[i] - slope / squares[i], 0.0), upper[i])
            step = (now - alpha[i]) * signs[i]
            if step:
                weights[ids] += step * values
                bias += step
                alpha[i] = now
    return weights, bias


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins, by Newton steps."""
    ones = int(labels.sum())
    zeros = len(labels) - ones
    wanted = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    slope, offset = 1.0, 0.0
    x = np.stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        gradient = x @ (wanted - p) - 1e-3 * np.array([slope, offset])
        curve = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(offset)


class Model:
    """Weights per feature, ready to score; ``constant`` if there was nothing to learn."""

    def __init__(self, ratios=None, weights=None, bias=0.0, slope=0.0, offset=0.0, constant=None):
        self.ratios, self.weights, self.bias = ratios, weights, bias
        self.slope, self.offset, self.constant = slope, offset, constant

    def margin(self, text: str | None) -> float:
        ids, values = scaled(text, self.ratios)
        return float(self.weights[ids] @ values) + self.bias

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        at = np.clip(self.slope * self.margin(text) + self.offset, -30, 30)
        return float(1 / (1 + np.exp(-at)))


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, name: str = "quality", sample: int = SAMPLE
) -> Model:
    bound_batches(spark)
    rows = staged(spark, labelled_rows(docs, labels, name), "labelled")
    counted = class_counts(rows).toPandas()  # at most FEATURES + 1 rows
    ratios, zeros, ones = log_ratios(counted)
    if not zeros or not ones:
        return Model(constant=ones / (zeros + ones) if zeros + ones else 0.5)
    # A hash threshold thins the rows on the executors before the bounded choice.
    place = F.xxhash64("doc_id", F.lit("sample"))
    per_class = sample // 2
    chosen = []
    for label, there in ((0, zeros), (1, ones)):
        limit = min(1.0, 1.3 * per_class / there + 50 / there)
        own = rows.filter(F.col("label") == label).filter(
            F.pmod(place, F.lit(1 << 30)) < int(limit * (1 << 30))
        )
        chosen += own.orderBy(place).limit(per_class).select("text", "label").collect()
    order = np.random.default_rng(11).permutation(len(chosen))
    held = order[: max(2, len(order) // 5)]
    used = order[len(held) :] if len(order) > 10 else order
    vectors = [scaled(r["text"], ratios) for r in chosen]
    targets = np.array([r["label"] for r in chosen])
    weights, bias = dual_descent(
        [vectors[i] for i in used], np.where(targets[used] == 1, 1.0, -1.0), PASSES, PENALTY
    )
    margins = np.array([weights[vectors[i][0]] @ vectors[i][1] + bias for i in held])
    # Scores speak of the labelled rows; the curve knows the shares of the chosen ones.
    slope, offset = calibrate(margins, targets[held])
    taken = int(targets.sum())
    prior = np.log(ones / zeros) - np.log(taken / (len(targets) - taken))
    return Model(ratios, weights, bias, slope, offset + float(prior))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two floats per feature

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series([own.score(t) for t in texts], dtype="float64")

    return docs.select(
        "doc_id", (id_remainder(4) == 2).alias("held_out"), score("text").alias("score")
    )


def query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(docs, fit(spark, docs, labels))
    return found.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
