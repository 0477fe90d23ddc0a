"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing, then exact scores.

Vectors are hashed by direction, so that the lengths of others don't move them away from a query.
Among vectors of about one length, the nearest by direction have the largest inner products. A
much longer one is among the nearest at a wide angle, where hashing seldom finds it: vectors are
split into ranges of length, and ranges of few vectors are searched whole. Each table quantises a
few Gaussian projections into a bucket. A query visits its bucket and then perturbed ones, in the
order of their estimated success (the squared distances to the crossed boundaries). Candidates of
all tables merge for exact scores; a query that met too few is compared with all vectors.

Tables, projections, width and probes are fitted: for a bounded sample of queries the true neighbours
are found among all vectors, and of the sets in ``LADDER`` that meet enough of them the one with least
estimated work is taken. The larger the table, the more a selective set is worth.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lendlens.llm.common import ready
from lendlens.sources.session import stage

@dataclass(frozen=True)
class Index:
    """Tables, projections of a bucket, width of a quantisation step (hashed vectors have length 1) and probes."""

    tables: int
    hashes: int
    width: float
    probes: int


#: From the most selective; the last one is taken if none meets enough.
LADDER = (
    Index(48, 14, 2.0, 96),
    Index(32, 12, 2.0, 64),
    Index(24, 10, 2.0, 48),
    Index(16, 8, 1.5, 48),
    Index(8, 6, 1.5, 48),
    Index(12, 6, 1.5, 48),
    Index(8, 6, 2.0, 24),
)
#: Sampled queries, share of their true neighbours that a set must meet, sampled vectors that tell how many it meets at all.
SAMPLE, TARGET, COMPARED = 64, 0.94, 1024
#: Work of one probe, in compared vectors.
PROBE_WORK = 16
#: Greatest by least length of a range; a range of at most so many vectors is searched whole.
RATIO, WHOLE = 1.25, 256
#: Bucket members, and queries of a bucket, that one task compares at once.
BLOCK = 2048


def perturbations(rest: np.ndarray, count: int) -> list[list[tuple[int, int]]]:
    """Sets of (projection, step) in ascending order of their sum of squared boundary distances; the empty set first.

    ``rest``: where in its step each projection lies, 0 to 1.
    """
    moves = sorted([(r * r, i, -1) for i, r in enumerate(rest)] + [((1 - r) ** 2, i, 1) for i, r in enumerate(rest)])
    out: list[list[tuple[int, int]]] = [[]]
    heap = [(moves[0][0], (0,))] if moves else []
    while heap and len(out) < count:
        cost, chosen = heapq.heappop(heap)
        if len({moves[k][1] for k in chosen}) == len(chosen):
            out.append([moves[k][1:] for k in chosen])
        last = chosen[-1] + 1
        if last < len(moves):
            heapq.heappush(heap, (cost - moves[last - 1][0] + moves[last][0], (*chosen[:-1], last)))
            heapq.heappush(heap, (cost + moves[last][0], (*chosen, last)))
    return out


def _projections(size: int, tables: int, hashes: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.Philox(key=size))
    return draw.standard_normal((size, tables * hashes)), draw.random(tables * hashes)


def bucket_keys(x: np.ndarray, index: Index, probing: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the buckets of each vector (row) in each table, and which of them there are.

    Of its own bucket, or ``probing``, of all that a query visits.
    """
    tables, hashes, probes = index.tables, index.hashes, index.probes
    size, size_salt, mask = x.shape[1], 0x9E3779B97F4A7C15, (1 << 64) - 1
    salt = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(hashes)], np.uint64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small numbers stay in range
    x /= np.sqrt((x**2).sum(axis=1, keepdims=True))
    a, b = _projections(size, tables, hashes)
    place = (x @ a / index.width + b).reshape(len(x), tables, hashes)
    home = np.floor(place).astype(np.int64)
    if probing:
        moved = np.repeat(home[:, :, None, :], probes, axis=2)
        found = np.zeros(moved.shape[:3], bool)
        for n in range(len(x)):
            for t in range(tables):
                for k, steps in enumerate(perturbations(place[n, t] - home[n, t], probes)):
                    found[n, t, k] = True
                    for i, step in steps:
                        moved[n, t, k, i] += step
    else:
        moved, found = home[:, :, None, :], np.ones((len(x), tables, 1), bool)
    keys = (moved.astype(np.uint64) * salt).sum(axis=-1) + np.uint64(size * size_salt & mask)
    return keys.view(np.int64), found


def _by_size(batch: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    sizes = batch["e"].map(len)
    for size in sizes.unique():
        part = batch[sizes == size]
        yield part, np.stack(part["e"].to_numpy()).astype(float)


def _hashed(vectors: DataFrame, index: Index, probing: bool) -> DataFrame:
    """``v, t, h`` with ``h`` the hash of a bucket in table ``t``: of its own, or of all visited."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, x in _by_size(batch):
                keys, found = bucket_keys(x, index, probing)
                n, t, k = np.nonzero(found)
                yield pd.DataFrame({"v": part["v"].to_numpy()[n], "t": t, "h": keys[n, t, k]})

    return vectors.mapInPandas(run, "v bigint, t int, h bigint")


def _true_neighbours(distinct: DataFrame, sample: list, keep: int) -> list:
    """``q, v, e`` of the nearest of each sampled query (its own row among them), by all vectors."""
    asked = pd.DataFrame([(r.v, r.e) for r in sample], columns=["v", "e"])
    groups = {x.shape[1]: (part["v"].to_numpy(), x) for part, x in _by_size(asked)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, x in _by_size(batch):
                if x.shape[1] not in groups:
                    continue
                ids, q = groups[x.shape[1]]
                scores = q @ x.T
                top = np.argsort(-scores, axis=1, kind="stable")[:, :keep]
                held = part["e"].to_numpy()[top.ravel()]
                found = {"q": np.repeat(ids, top.shape[1]), "v": part["v"].to_numpy()[top.ravel()]}
                yield pd.DataFrame(found | {"score": np.take_along_axis(scores, top, 1).ravel(), "e": held})

    best = distinct.mapInPandas(run, "q bigint, v bigint, score double, e array<double>")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    return best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= keep).collect()  # SAMPLE * keep rows


def _share_met(index: Index, queries: pd.DataFrame, others: pd.DataFrame) -> float:
    """Share of the pairs ``q, e`` in which the query's probes meet the other vector's buckets."""
    met = total = 0
    for part, x in _by_size(queries):
        keys, found = bucket_keys(x, index, True)
        visited = {v: [set(keys[n, t][found[n, t]].tolist()) for t in range(index.tables)] for n, v in enumerate(part["v"])}
        for other, y in _by_size(others):
            if y.shape[1] != x.shape[1]:
                continue
            homes, _ = bucket_keys(y, index, False)
            for q, own in zip(other["q"], homes[:, :, 0].tolist(), strict=True):
                for v in [q] if q is not None else visited:
                    if v in visited:
                        total += 1
                        met += any(h in seen for h, seen in zip(own, visited[v], strict=True))
    return met / total if total else 1.0


def fitted_index(distinct: DataFrame, queries: DataFrame, count: int) -> Index:
    """The set of ``LADDER`` with least estimated work among those that meet ``TARGET`` of the sampled
    queries' true neighbours. On the driver are SAMPLE queries, their ``count`` neighbours, and COMPARED vectors."""
    sample = queries.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    if not sample:
        return LADDER[-1]
    near = [(r.q, r.e) for r in _true_neighbours(distinct.select("v", "e"), sample, count + 1) if r.q != r.v]
    some = distinct.orderBy(F.xxhash64("v", F.lit(7)), "v").limit(COMPARED).collect()
    asked = pd.DataFrame([(r.v, r.e) for r in sample], columns=["v", "e"])
    true = pd.DataFrame(near, columns=["q", "e"])
    few, others = asked.head(8), pd.DataFrame({"q": pd.Series([None] * len(some), dtype=object), "e": [r.e for r in some]})
    n, best, least = distinct.count(), LADDER[-1], float("inf")
    for index in LADDER:
        if len(true) and _share_met(index, asked, true) < TARGET and index is not LADDER[-1]:
            continue
        work = n * _share_met(index, few, others) + PROBE_WORK * index.tables * index.probes
        if work < least:
            best, least = index, work
    return best


def _nearest(keep: int):
    def best(group: pd.DataFrame) -> pd.DataFrame:
        asks, holds = group[group["ask"]], group[~group["ask"]]
        if not len(asks) or not len(holds):
            return pd.DataFrame({"q": [], "v": [], "score": []}).astype({"q": np.int64, "v": np.int64})
        order = np.argsort(holds["v"].to_numpy(), kind="stable")
        ids = holds["v"].to_numpy()[order]
        scores = np.stack(asks["e"].to_numpy()).astype(float) @ np.stack(holds["e"].to_numpy()[order]).astype(float).T
        top = np.argsort(-scores, axis=1, kind="stable")[:, :keep]
        q = np.repeat(asks["v"].to_numpy(), top.shape[1])
        return pd.DataFrame({"q": q, "v": ids[top.ravel()], "score": np.take_along_axis(scores, top, 1).ravel()})

    return best


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``i, e``: ids and double vectors that can take part, each pair once; -0.0 as 0.0."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("i"),
        F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("e"),
    )
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    fit = F.exists("e", lambda x: x != 0) & ~F.exists("e", bad)
    return rows.where(F.col("i").isNotNull() & F.col("e").isNotNull()).where(fit).dropDuplicates(["i", "e"])


def _ranged(vectors: DataFrame) -> DataFrame:
    """``vectors`` with the number of components ``size`` and of the range of length ``span``."""
    most = F.col("most")
    square = F.aggregate("e", F.lit(0.0), lambda s, x: s + (x / most) * (x / most))
    span = F.floor((F.log(most) + F.log(square) / 2) / F.log(F.lit(RATIO)) + 0.5)
    rows = vectors.withColumn("most", F.array_max(F.transform("e", F.abs)))
    return rows.select("v", "e", F.size("e").alias("size"), span.alias("span"))


def _met(held: DataFrame, asks: DataFrame, distinct: DataFrame, most: int) -> DataFrame:
    """``q, v``: the ``most`` best of what each query ``asks.v`` meets in the buckets ``t, h``, by approximate score."""
    blocks = held.groupBy("t", "h").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(BLOCK))).cast("int").alias("blocks"))
    parts = asks.groupBy("t", "h").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(BLOCK))).cast("int").alias("parts"))
    both = blocks.join(parts, ["t", "h"])
    spot = lambda n: F.pmod(F.xxhash64("v"), F.col(n)).cast("int")
    mine = held.join(both, ["t", "h"]).select(
        "v", "t", "h", spot("blocks").alias("x"), F.explode(F.expr("sequence(0, parts - 1)")).alias("y")
    )
    theirs = asks.join(both, ["t", "h"]).select(
        "v", "t", "h", F.explode(F.expr("sequence(0, blocks - 1)")).alias("x"), spot("parts").alias("y")
    )
    dealt = mine.withColumn("ask", F.lit(False)).union(theirs.withColumn("ask", F.lit(True)))
    dealt = dealt.join(distinct.select("v", "e"), "v")
    met = dealt.groupBy("t", "h", "x", "y").applyInPandas(_nearest(most), "q bigint, v bigint, score double")
    met = met.groupBy("q", "v").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    return met.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most).select("q", "v")


def _listed(met: DataFrame, distinct: DataFrame, named: DataFrame, keep: int) -> DataFrame:
    """``q, i, score``: the ``keep`` best ids of the vectors met, by exact score."""
    a = distinct.select(F.col("v").alias("q"), F.col("e").alias("qe"))
    exact = F.aggregate(F.zip_with("qe", "e", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = met.join(a, "q").join(distinct.select("v", "e"), "v").select("q", "v", exact.alias("score"))
    few = named.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("i"))).where(F.col("r") <= keep)
    listed = scored.join(few.select("v", "i"), "v")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "i")
    return listed.withColumn("r", F.row_number().over(order)).where(F.col("r") <= keep).select("q", "i", "score")


def nearest(
    vectors: DataFrame,
    every: int = 20,
    count: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    index: Index | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``count`` nearest found of each row whose id ``every`` divides.

    All rows but the query's own are candidates; the score is the inner product of the original
    vectors, added up in double precision from the first component on; ties go to the smaller id.
    Equal vectors are searched once, whatever their number, and at the end stand for their
    ``count + 1`` least ids, since no more can be among the nearest. Vectors that are null, empty,
    zero or hold a null or non-finite component, and rows without an id, take no part; vectors of
    another number of components are no candidates of each other. Repeated rows count once. Without
    ``index`` the index is fitted. A query that meets
    fewer than ``count`` others in its buckets is compared with all vectors, so it has fewer rows
    only if the table holds no more; an empty table gives none.
    """
    ready(vectors.sparkSession)
    keep = count + 1
    rows = stage(_usable(vectors, id_col, vector_col), "ann-rows")
    first = Window.partitionBy("e").orderBy("i")
    least = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= keep)
    distinct = stage(least.where("r = 1").select(F.col("i").alias("v"), "e"), "ann-vectors")
    named = stage(rows.join(distinct.select("v", "e"), "e").select("v", "i"), "ann-ids")
    asked = named.where(F.col("i") % every == 0)
    queries = stage(distinct.join(asked.select("v").distinct(), "v", "left_semi"), "ann-queries")

    whole = lambda df: df.select("v", F.lit(-1).alias("t"), F.size("e").cast("bigint").alias("h"))
    span = ["size", "span"]
    ranged = _ranged(distinct)
    small = ranged.groupBy(span).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= WHOLE)
    index = index or fitted_index(distinct, queries, count)
    held = _hashed(distinct, index, False).union(whole(ranged.join(small, span, "left_semi")))
    asks = _hashed(queries, index, True).distinct().union(whole(queries))
    held, asks = stage(held, "ann-index"), stage(asks, "ann-probes")
    met = _met(held, asks, distinct, keep + 3).union(queries.select(F.col("v").alias("q"), "v")).distinct()
    listed = stage(_listed(met, distinct, named, keep), "ann-listed")

    enough = listed.groupBy("q").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= keep).select(F.col("q").alias("v"))
    short = stage(queries.join(enough, "v", "left_anti"), "ann-short")
    if not short.isEmpty():
        met = stage(_met(whole(distinct), whole(short), distinct, keep + 3), "ann-met")
        again = short.select(F.col("v").alias("q"))
        listed = listed.join(again, "q", "left_anti").unionByName(_listed(met, distinct, named, keep))
    asked = asked.select(F.col("v").alias("q"), F.col("i").alias("query_id"))
    out = asked.join(listed, "q").where("i != query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "i")
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return out.select("query_id", "rank", F.col("i").alias("vec_id"), "score")
