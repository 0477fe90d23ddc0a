"""Ordered cumulative sums over a whole table without a global window.

Rows are first collapsed to one per distinct key (map-side combine absorbs hot
keys), distinct keys fall into ranges cut at approximate quantiles, each range
is accumulated on its own, and range totals supply the running offset. The cut
points are literals, so a re-run task assigns the same ranges; equal keys share
a range, so the result is exact wherever the cuts fall.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_RANGE = 250_000
MIN_RANGES = 8
FIRST_RANGES = 64
MAX_RANGES = 4096
_RANGE = "__range"


@dataclass
class Cuts:
    """Range boundaries of a key and the values too frequent for one range."""

    bounds: list[float] = field(default_factory=list)
    heavy: list[float] = field(default_factory=list)
    #: About how many ranges' rows the most frequent value has.
    shares: int = 1

    def assign(self, df: DataFrame, key: str) -> DataFrame:
        if not self.bounds:
            return df.withColumn(_RANGE, F.lit(0.0))
        splits = [float("-inf"), *self.bounds, float("inf")]
        return Bucketizer(splits=splits, inputCol=key, outputCol=_RANGE).transform(df)


def _as_key(key: str) -> Column:
    """The key as double, with -0.0 folded into 0.0 so that equal keys are equal bits."""
    return F.col(key).cast("double") + F.lit(0.0)


def _quantile_points(df: DataFrame, key: str, pieces: int) -> tuple[int, list[float]]:
    """Row count and the ``pieces - 1`` inner approximate quantiles of a key."""
    shares = ", ".join(f"{i / pieces}D" for i in range(1, pieces))
    row = df.agg(
        F.count(key).alias("n"),
        F.expr(f"percentile_approx(cast(`{key}` as double), array({shares}), {8 * pieces})").alias("points"),
    ).first()
    return row["n"], [p + 0.0 for p in row["points"] or []]


def find_cuts(df: DataFrame, key: str, rows_per_range: int = ROWS_PER_RANGE) -> Cuts:
    """Equal-depth boundaries of ``key`` from a sketch pass (two when the table is large).

    A value named by two neighbouring quantiles holds a large share of the
    rows; it is reported as heavy so that row-level joins can treat it apart.
    """
    pieces = FIRST_RANGES
    n, points = _quantile_points(df, key, pieces)
    ranges = min(MAX_RANGES, max(MIN_RANGES, -(-n // rows_per_range)))
    if ranges > pieces:
        pieces = MAX_RANGES
        n, points = _quantile_points(df, key, pieces)
    if not points:
        return Cuts()
    chosen = [points[round(i * pieces / ranges) - 1] for i in range(1, ranges)]
    repeats = Counter(chosen)
    heavy = sorted(v for v, times in repeats.items() if times > 1)
    return Cuts(sorted(repeats), heavy, max(repeats.values(), default=1) + 1)


def running_sums(
    df: DataFrame,
    key: str,
    values: Mapping[str, Column],
    groups: Sequence[str] = (),
    cuts: Cuts | None = None,
) -> DataFrame:
    """One row per (group, distinct key) with totals at and before the key.

    ``values`` maps a name to an aggregate column. The output carries the name
    and ``<name>_before``, the sum over strictly smaller keys of the group.
    Groups are few (models, tiers, columns); null keys are dropped.
    """
    groups = list(groups)
    known = df.where(F.col(key).isNotNull()).withColumn(key, _as_key(key))
    cuts = cuts or find_cuts(known, key)
    ranged = groups + [_RANGE]
    tied = cuts.assign(known, key).groupBy(*ranged, key).agg(*(c.alias(n) for n, c in values.items()))

    earlier = Window.unboundedPreceding, -1
    within = Window.partitionBy(*ranged).orderBy(key).rowsBetween(*earlier)
    local = tied.select(
        "*", *(F.coalesce(F.sum(n).over(within), F.lit(0)).alias(f"{n}_local") for n in values)
    )
    # At most MAX_RANGES rows per group, whatever the data size.
    across = Window.partitionBy(*groups or [F.lit(0)]).orderBy(_RANGE).rowsBetween(*earlier)
    totals = tied.groupBy(*ranged).agg(*(F.sum(n).alias(n) for n in values))
    offsets = totals.select(
        *(F.col(c).alias(f"__of_{c}") for c in ranged),
        *(F.coalesce(F.sum(n).over(across), F.lit(0)).alias(f"{n}_offset") for n in values),
    )
    # A null-safe condition adds no filter to either side, so both read one shuffle of the collapsed rows.
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in ranged))
    return local.join(offsets, same).select(
        *groups,
        key,
        *values,
        *((F.col(f"{n}_local") + F.col(f"{n}_offset")).alias(f"{n}_before") for n in values),
    )


def attach_by_value(
    rows: DataFrame, found: DataFrame, key: str, cuts: Cuts, groups: Sequence[str] = ()
) -> DataFrame:
    """Join per-value results back to rows, left-outer, safe for hot values.

    Heavy values (at most MAX_RANGES, known from the cuts) meet a broadcast
    table of that bounded size; all other values each hold a small share of
    the rows and take an ordinary shuffle join.
    """
    on = [*groups, key]
    rows = rows.withColumn(key, _as_key(key))
    if not cuts.heavy:
        return rows.join(found, on, "left")
    hot = F.coalesce(F.col(key).isin(cuts.heavy), F.lit(False))
    # Few groups times at most MAX_RANGES values.
    hot_part = rows.where(hot).join(F.broadcast(found.where(hot)), on, "left")
    rest = rows.where(~hot).join(found.where(~hot), on, "left")
    return hot_part.unionByName(rest)


def average_ranks(
    df: DataFrame, value: str, groups: Sequence[str] = (), cuts: Cuts | None = None
) -> DataFrame:
    """Rank of each distinct value, ties sharing the mean of their positions."""
    sums = running_sums(df, value, {"n": F.count(F.lit(1))}, groups, cuts)
    rank = F.col("n_before") + (F.col("n") + 1) / 2
    return sums.select(*groups, value, "n", rank.alias("avg_rank"))


def average_rank(df: DataFrame, value: str, output: str = "avg_rank") -> DataFrame:
    """Every row of ``df`` with the average rank of its value; null for null."""
    cuts = find_cuts(df, value)
    ranks = average_ranks(df, value, cuts=cuts).select(value, F.col("avg_rank").alias(output))
    return attach_by_value(df, ranks, value, cuts)
