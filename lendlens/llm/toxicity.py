"""Toxicity scores from a linear classifier over character n-grams scaled by naive Bayes ratios.

Features are hashed character n-grams that a text has or hasn't. Each is scaled by the log ratio of
its smoothed frequencies among toxic and other texts; logistic regression weighs the scaled features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, functions as F

from lendlens.llm.common import CHUNK, code_points, grouped, mix, ready
from lendlens.sources.session import stage

ORDERS = (3, 4, 5)
BUCKETS = 1 << 18
#: Features kept: those whose frequencies differ most between the classes.
KEPT = 4096
#: Labelled rows that the classifier is fitted on, at most; those with the smallest id hash.
FITTED_ROWS = 30_000
SMOOTHING = 1.0
THRESHOLD = 0.3


def _gram_buckets(lowered: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Owners and buckets of the n-grams of lower-cased texts, order by order."""
    points = code_points("".join(lowered)).astype(np.uint64)
    owner = np.repeat(np.arange(len(lowered)), [len(t) for t in lowered])
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    rolling = points + np.uint64(1)
    for n in range(2, max(ORDERS) + 1):
        if len(points) < n:
            return
        rolling = rolling[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :]
        if n in ORDERS:
            whole = owner[: len(rolling)] == owner[n - 1 :]
            buckets = (mix(rolling + np.uint64(n << 56)) >> shift).astype(np.int64)
            yield owner[: len(rolling)][whole], buckets[whole]


def present(texts: list[str], place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs. ``place``: the feature of each bucket, -1 for those not kept.

    Long texts are gone through in overlapping stretches, so that memory is bounded by a stretch.
    """
    stretches, owners = [], []
    for k, text in enumerate(texts):
        lowered = text.lower()
        cuts = range(0, len(lowered), CHUNK)
        stretches += [lowered[max(0, at - max(ORDERS) + 1) : at + CHUNK] for at in cuts]
        owners += [k] * len(cuts)
    of, pairs = np.array(owners, np.int64), [np.zeros(0, np.int64)]
    for start, part in grouped(stretches):
        held = [pairs[0]]
        for owner, buckets in _gram_buckets(part):
            if place is not None:
                buckets = place[buckets]
                kept = buckets >= 0
                owner, buckets = owner[kept], buckets[kept]
            held.append(of[start + owner] * BUCKETS + buckets)
        pairs.append(np.unique(np.concatenate(held)))
    found = np.unique(np.concatenate(pairs)) if len(pairs) > 2 else pairs[-1]
    return found // BUCKETS, found % BUCKETS


@dataclass
class Model:
    place: np.ndarray  # bucket -> feature or -1
    weights: np.ndarray  # of the features, the ratio included
    intercept: float

    def score(self, texts: list[str]) -> np.ndarray:
        owner, feature = present(texts, self.place)
        margin = np.bincount(owner, self.weights[feature], minlength=len(texts)) + self.intercept
        return 1 / (1 + np.exp(-margin.clip(-500, 500)))


def labelled(docs: DataFrame, labels: DataFrame, text_col: str = "text", most: int = FITTED_ROWS) -> DataFrame:
    """``t, y`` of documents with a label of 0 or 1, ``most`` of them at most.

    A document with several labels counts as toxic if one says so. The labels' side of the join
    has ``most`` rows of two numbers at most, so it may be broadcast.
    """
    chosen = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    rows = docs.select("doc_id", F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.join(F.broadcast(chosen), "doc_id").select("t", "y")


def fit(rows: DataFrame, kept: int = KEPT) -> Model:
    """Model of ``t, y`` rows. Without rows of both classes every text scores the share of toxic rows (0 if none)."""
    ready(rows.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for start, texts in grouped(batch["t"].tolist()):
                owner, feature = present(texts)
                y = batch["y"].to_numpy()[start : start + len(texts)][owner]
                for k in (0, 1):
                    counts[k] += np.bincount(feature[y == k], minlength=BUCKETS)
        some = np.flatnonzero(counts.sum(axis=0))
        yield pd.DataFrame({"b": some, "c0": counts[0][some], "c1": counts[1][some]})

    sizes = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.0
        return Model(np.full(BUCKETS, -1), np.zeros(1), 500.0 if share == 1 else -500.0)
    share = (F.col("c0") + F.col("c1")) / F.lit(float(n0 + n1))
    gap = F.abs(F.col("c1") / F.lit(float(n1)) - F.col("c0") / F.lit(float(n0)))
    chosen = (
        rows.mapInPandas(count, "b bigint, c0 bigint, c1 bigint")
        .groupBy("b")
        .agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
        .withColumn("z", gap / F.sqrt(share * (F.lit(1.0) - share) + F.lit(1e-9)))
        .orderBy(F.desc("z"), "b")
        .limit(kept)
        .collect()
    )
    place = np.full(BUCKETS, -1)
    place[[r.b for r in chosen]] = np.arange(len(chosen))
    p = (np.array([r.c1 for r in chosen], float) + SMOOTHING) / (n1 + 2 * SMOOTHING)
    q = (np.array([r.c0 for r in chosen], float) + SMOOTHING) / (n0 + 2 * SMOOTHING)
    ratio = np.log(p / q)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, texts in grouped(batch["t"].tolist()):
                owner, feature = present(texts, place)
                ends = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
                out += [feature[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]
            yield pd.DataFrame({"label": batch["y"].astype(float), "f": pd.Series(out, dtype=object)})

    # one small row per labelled text, read once per iteration of the fit
    held = stage(rows.mapInPandas(features, "label double, f array<int>"), "toxicity-features")
    vector = F.udf(lambda f: SparseVector(len(ratio), f, ratio[f]), VectorUDT())
    data = held.select("label", vector("f").alias("features")).persist()
    fitted = LogisticRegression(regParam=1e-3, maxIter=60, standardization=False).fit(data)
    data.unpersist()
    return Model(place, fitted.coefficients.toArray() * ratio, float(fitted.intercept))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row, from the text alone.

    A null text scores as an empty one: the intercept alone. Null ids and repeated rows are
    answered row by row, an empty table gives no rows, other columns are ignored. No shuffle.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores: list[float] = []
            for _, texts in grouped(["" if t is None else t for t in batch["t"]]):
                scores += model.score(texts).tolist()
            yield pd.DataFrame({"doc_id": batch["i"].astype("Int64"), "score": pd.Series(scores, dtype=float)})

    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "doc_id bigint, score double")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns unchanged, null texts kept if an empty text is.

    The score is computed in place, row by row, so ids may be null, repeated or absent.
    """
    ready(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        out: list[float] = []
        for _, part in grouped(["" if t is None else t for t in texts]):
            out += model.score(part).tolist()
        return pd.Series(out, dtype=float)

    return docs.where(scored(F.col(text_col)) < threshold)
