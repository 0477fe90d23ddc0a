"""Default rates by segment, client repayment profiles and correlations."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendlens.functions.columns import age_years, band, label
from lendlens.operators.features import repayment_scalars
from lendlens.sources.session import let_workers_import, stage

# Bin edges [a, b) and labels.
AGE_EDGES = (18, 25, 35, 45, 55, 65, 100)
AGE_LABELS = ("18-25", "25-34", "35-44", "45-54", "55-64", "65+")
CREDIT_EDGES = (0, 250_000, 500_000, 750_000, 1_000_000, float("inf"))
CREDIT_LABELS = (
    "Tier 1: <$250k",
    "Tier 2: $250k-$500k",
    "Tier 3: $500k-$750k",
    "Tier 4: $750k-$1M",
    "Tier 5: >$1M",
)
# Variables of the repayment correlation matrices.
CORRELATED = (
    "TARGET",
    "AVG_DPD",
    "MAX_DPD",
    "COUNT_LATE_PAYMENTS",
    "PCT_LATE_PAYMENTS",
    "AVG_PAYMENT_RATIO",
    "MIN_PAYMENT_RATIO",
    "AVG_PAYMENT_DEFICIT",
    "TOTAL_PAYMENT_DEFICIT",
    "COUNT_UNDERPAID",
    "AVG_DAYS_EARLY",
    "AMT_CREDIT",
    "EXT_SOURCE_2",
    "EXT_SOURCE_3",
)


def age_group() -> Column:
    return band(age_years(), AGE_EDGES)


def credit_band() -> Column:
    return band(F.col("AMT_CREDIT"), CREDIT_EDGES)


def _rates(target: str = "TARGET") -> list[Column]:
    t = F.col(target)
    return [
        F.count(t).alias("Total"),
        F.coalesce(F.sum(t), F.lit(0)).cast("bigint").alias("Default_Count"),
        F.avg(t).alias("Default_Rate"),
    ]


def _banded(df: DataFrame, number: Column, labels: Sequence[str], name: str) -> DataFrame:
    """Rates per band with a row for every band, populated or not."""
    counted = df.groupBy(number.alias("ordinal")).agg(*_rates())
    every = df.sparkSession.range(len(labels)).select(F.col("id").cast("int").alias("ordinal"))
    zero = F.lit(0).cast("bigint")
    return every.join(counted, "ordinal", "left").select(
        label(F.col("ordinal"), labels).alias(name),
        F.coalesce("Total", zero).alias("Total"),
        F.coalesce("Default_Count", zero).alias("Default_Count"),
        "Default_Rate",
        (F.col("Default_Rate") * 100).alias("Default_Rate_Pct"),
    )


def segment_age(df: DataFrame) -> DataFrame:
    return _banded(df, age_group(), AGE_LABELS, "AGE_GROUP")


def segment_credit_band(df: DataFrame) -> DataFrame:
    return _banded(df, credit_band(), CREDIT_LABELS, "CREDIT_BAND")


def segment_by(df: DataFrame, column: str) -> DataFrame:
    """Rates per observed value, highest rate first."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(*_rates())
    return counted.withColumn("Default_Rate_Pct", F.col("Default_Rate") * 100).orderBy(F.desc("Default_Rate"), column)


def segment_all(df: DataFrame) -> DataFrame:
    """All four cuts from one scan: rows are counted once per (segment, value)."""
    cuts = {
        "age_groups": label(age_group(), AGE_LABELS),
        "credit_bands": label(credit_band(), CREDIT_LABELS),
        "education": F.col("NAME_EDUCATION_TYPE"),
        "contract_type": F.col("NAME_CONTRACT_TYPE"),
    }
    # Collapse to the few value combinations first, so the unpivot is tiny.
    combined = df.groupBy(*(c.alias(n) for n, c in cuts.items())).agg(
        F.count("TARGET").alias("n"), F.sum("TARGET").alias("d")
    )
    entries = [F.struct(F.lit(n).alias("segment"), F.col(n).alias("value"), "n", "d") for n in cuts]
    long = combined.select(F.inline(F.array(*entries))).where("value is not null")
    rate = F.col("Default_Count") / F.nullif(F.col("Total"), F.lit(0))
    summed = long.groupBy("segment", "value").agg(
        F.sum("n").alias("Total"), F.coalesce(F.sum("d"), F.lit(0)).cast("bigint").alias("Default_Count")
    )
    return summed.withColumn("Default_Rate", rate).withColumn("Default_Rate_Pct", F.col("Default_Rate") * 100)


def client_repayment(inst: DataFrame) -> DataFrame:
    """Eleven repayment aggregates per client, in one group-by."""
    return (
        repayment_scalars(inst)
        .groupBy("SK_ID_CURR")
        .agg(
            F.count("AMT_INSTALMENT").alias("TOTAL_INSTALLMENTS"),
            F.avg("DPD").alias("AVG_DPD"),
            F.max("DPD").cast("double").alias("MAX_DPD"),
            F.sum("IS_LATE").alias("COUNT_LATE_PAYMENTS"),
            F.avg("IS_LATE").alias("PCT_LATE_PAYMENTS"),
            F.avg("PAYMENT_RATIO").alias("AVG_PAYMENT_RATIO"),
            F.min("PAYMENT_RATIO").alias("MIN_PAYMENT_RATIO"),
            F.coalesce(F.sum("PAYMENT_DEFICIT"), F.lit(0.0)).alias("TOTAL_PAYMENT_DEFICIT"),
            F.avg("PAYMENT_DEFICIT").alias("AVG_PAYMENT_DEFICIT"),
            F.sum("IS_UNDERPAID").alias("COUNT_UNDERPAID"),
            F.avg("DAYS_EARLY").alias("AVG_DAYS_EARLY"),
        )
    )


def repay_target_join(apps: DataFrame, profiles: DataFrame) -> DataFrame:
    """Inner join of client profiles with the label and key application amounts."""
    wanted = ["SK_ID_CURR", "TARGET", "AMT_CREDIT", "AMT_INCOME_TOTAL", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    return apps.select(*wanted).join(profiles, "SK_ID_CURR")


#: Rows of a range of one variable that a task ranks, and the most ranges of a variable.
STRIP_ROWS, MAX_STRIPS = 100_000, 1024
#: Rows whose ranks of all variables one task puts together.
BUCKET_ROWS = 50_000


def _known(batch: pa.RecordBatch | pa.Table, k: int) -> np.ndarray:
    """Which of the first ``k`` columns are not null, by row."""
    return np.array([np.asarray(batch.column(i).is_valid()) for i in range(k)])


def _listed(batch: pa.RecordBatch, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Known entries and values of ``k`` array columns of ``width`` elements each."""
    known, values = _known(batch, k), np.zeros((k, width, batch.num_rows))
    for i, c in enumerate(batch.columns):
        values[i][:, known[i]] = c.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, width).T
    return known, values


_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy", "lx", "hx", "ly", "hy")
_MOMENT_ROWS = "i bigint, j bigint, " + ", ".join(f"{n} double" for n in _MOMENTS)


def _moments_of(parts: Iterator[tuple[np.ndarray, np.ndarray]], k: int, variants: Sequence[int]) -> dict:
    """``i, j, n`` and moments of every pair of ``k`` variables, from known entries and values of some rows each."""
    pairs = [(i, j) for i in range(k) for j in range(i)]
    total = np.zeros((len(pairs), 6))
    ends = np.tile([np.inf, -np.inf, np.inf, -np.inf], (len(pairs), 1))
    for known, values in parts:
        for at, (i, j) in enumerate(pairs):
            both = known[i] & known[j]
            if not both.any():
                continue
            x, y = values[i, variants[j]][both], values[j, variants[i]][both]
            total[at] += [both.sum(), x.sum(), y.sum(), x @ x, y @ y, x @ y]
            ends[at, ::2] = np.minimum(ends[at, ::2], [x.min(), y.min()])
            ends[at, 1::2] = np.maximum(ends[at, 1::2], [x.max(), y.max()])
    found = {"i": [i for i, _ in pairs], "j": [j for _, j in pairs]}
    return found | {n: np.column_stack([total, ends])[:, c] for c, n in enumerate(_MOMENTS)}


def _added_up(moments: DataFrame) -> DataFrame:
    merge = {"lx": F.min, "ly": F.min, "hx": F.max, "hy": F.max}
    return moments.groupBy("i", "j").agg(*(merge.get(n, F.sum)(n).alias(n) for n in _MOMENTS))


def _pair_moments(wide: DataFrame, k: int, variants: Sequence[int]) -> DataFrame:
    """``i, j, n`` and centred moments of every pair of ``k`` variables, one row per pair and task before the sum.

    ``wide`` has an array column v0, v1, ... per variable, null in a gap. For the pair (i, j), element
    ``variants[j]`` of v_i meets element ``variants[i]`` of v_j. Values are centred by the caller.
    """
    width = 1 + max(variants, default=0)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict(_moments_of((_listed(batch, k, width) for batch in batches), k, variants))

    let_workers_import(wide.sparkSession)
    return _added_up(wide.mapInArrow(fold, _MOMENT_ROWS))


def _matrix(moments: DataFrame, columns: Sequence[str], known: DataFrame) -> DataFrame:
    """Both halves and the diagonal of a correlation matrix in long form; null for a constant variable."""
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread = F.sqrt((F.col("sxx") - sx * sx / n) * (F.col("syy") - sy * sy / n))
    varies = (F.col("n") > 1) & (F.col("lx") < F.col("hx")) & (F.col("ly") < F.col("hy"))
    r = F.when(varies, (F.col("sxy") - sx * sy / n) / spread).alias("correlation")
    halves = moments.select(F.inline(F.array(F.struct("i", "j", r), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), r))))
    whole = halves.unionByName(known)
    name = lambda c: label(F.col(c).cast("int"), columns)
    return whole.select(name("i").alias("variable"), name("j").alias("other"), "correlation")


def _diagonal(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i, j, correlation`` of each variable with itself: 1, or null where it doesn't vary."""
    found = df.agg(*(F.struct(F.min(c).alias("l"), F.max(c).alias("h")).alias(c) for c in columns))
    entries = [
        F.struct(
            F.lit(i).cast("bigint").alias("i"),
            F.lit(i).cast("bigint").alias("j"),
            F.when(F.col(c)["l"] < F.col(c)["h"], 1.0).alias("correlation"),
        )
        for i, c in enumerate(columns)
    ]
    return found.select(F.inline(F.array(*entries)))


def pearson_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pairwise-complete Pearson correlations; null for a constant column.

    Every pair is worked out once: tasks fold their rows into moments, which are added up.
    """
    columns = [c for c in columns if c in df.columns]
    typed = stage(df.select(*(F.col(c).cast("double").alias(c) for c in columns)), "pearson")
    means = typed.agg(*(F.avg(c).alias(c) for c in columns)).first()
    centred = [F.when(F.col(c).isNotNull(), F.array(F.col(c) - F.lit(means[c] or 0.0))).alias(f"v{i}") for i, c in enumerate(columns)]
    moments = _pair_moments(typed.select(*centred), len(columns), [0] * len(columns))
    return _matrix(moments, columns, _diagonal(typed, columns))


class _Places:
    """Ranges of one variable; a frequent value, the lower bound of its range, has an even place of its own."""

    def __init__(self, points: Sequence[float]):
        repeats = Counter(p + 0.0 for p in points)
        self.bounds = np.array(sorted(repeats), float)
        self.lower = np.concatenate([[np.nan], self.bounds])
        self.frequent = np.array([False, *(repeats[v] > 1 for v in self.bounds.tolist())])
        self.size = 2 * len(self.lower)

    def of(self, values: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.bounds, values, side="right")
        return 2 * at + ~(self.frequent[at] & (self.lower[at] == values))


def spearman_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """Pairwise-complete Spearman correlations: Pearson on average ranks.

    For a pair, ranks are taken among rows where both are known, so a value has one rank among all rows
    and one for every different set of gaps. Counts per range of each variable give the ranks of frequent
    values, which are looked up; other values go, one row each, to the task of their range, are ranked
    there, and return to their row, whose pairs are folded as for Pearson.
    """
    columns = [c for c in columns if c in df.columns]
    k = len(columns)
    values = [(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in columns]
    typed = stage(df.select(*values, F.monotonically_increasing_id().alias("__row")), "spearman")
    pattern = sum((F.col(c).isNotNull().cast("int") * (1 << i) for i, c in enumerate(columns)), F.lit(0))
    seen = typed.groupBy(pattern.alias("known")).count().collect()  # sets of known variables
    n, gaps, variants = sum(r["count"] for r in seen), [], []
    for i in range(k):  # variables with the same gaps share a variant of the ranks
        if all(r["known"] >> i & 1 for r in seen):
            variants.append(0)
            continue
        like = [v for v, g in enumerate(gaps, 1) if all((r["known"] >> i ^ r["known"] >> g) & 1 == 0 for r in seen)]
        if not like:
            gaps.append(i)
        variants.append(like[0] if like else len(gaps))
    width = 1 + len(gaps)

    ranges = min(MAX_STRIPS, max(8, -(-n // strip_rows)))
    shares = ", ".join(f"{i / ranges}D" for i in range(1, ranges))
    cut = typed.agg(*(F.expr(f"percentile_approx(`{c}`, array({shares}), {8 * ranges})").alias(c) for c in columns)).first()
    places = [_Places(cut[c] or []) for c in columns]

    def numbers(batch: pa.RecordBatch | pa.Table, i: int) -> np.ndarray:
        column = batch.column(i)
        return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [np.zeros((width, p.size), np.int64) for p in places]
        for batch in batches:
            known = _known(batch, k)
            for i, p in enumerate(places):
                at = p.of(numbers(batch, i))
                for v in range(width):
                    rows = known[i] & known[gaps[v - 1]] if v else known[i]
                    cells[i][v] += np.bincount(at[rows], minlength=p.size)
        for i, c in enumerate(cells):
            v, at = np.nonzero(c)
            yield pa.RecordBatch.from_pydict({"i": np.full(len(v), i), "v": v, "place": at, "n": c[v, at]})

    let_workers_import(df.sparkSession)
    counted = typed.select(*columns).mapInArrow(count, "i bigint, v bigint, place bigint, n bigint")
    found = counted.groupBy("i", "v", "place").agg(F.sum("n").alias("n")).toArrow()  # counts per range
    sizes = [np.zeros((width, p.size)) for p in places]
    for i, v, at, m in zip(*(found[c].to_pylist() for c in ("i", "v", "place", "n")), strict=True):
        sizes[i][v, at] = m
    middle = n / 2  # keeps the sums of squares small
    before = [c.cumsum(axis=1) - c for c in sizes]
    frequent = [b + (c + 1) / 2 - middle for b, c in zip(before, sizes)]
    stride = max(p.size for p in places)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = _known(batch, k)
            bits = sum((known[g].astype(np.int64) << v for v, g in enumerate(gaps)), np.zeros(batch.num_rows, np.int64))
            row = numbers(batch, k)
            for i, p in enumerate(places):
                value = numbers(batch, i)
                at = p.of(value)
                rows = np.flatnonzero(known[i] & (at % 2 == 1))
                dealt = {"strip": i * stride + at[rows], "row": row[rows], "bits": bits[rows], "value": value[rows]}
                yield pa.RecordBatch.from_pydict(dealt)

    def rank(key: tuple, table: pa.Table) -> pa.Table:
        i, place = divmod(key[0].as_py(), stride)
        value = table["value"].to_numpy()
        order = np.argsort(value, kind="stable")
        starts = np.flatnonzero(np.diff(value[order], prepend=-np.inf) != 0)
        run = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(order)))
        bits, ranked = table["bits"].to_numpy()[order], {"row": table["row"].to_numpy()[order], "i": np.full(len(order), i)}
        for v in range(width):
            tied = np.add.reduceat(bits >> (v - 1) & 1 if v else np.ones(len(order), np.int64), starts)
            ranked[f"r{v}"] = (before[i][v, place] + tied.cumsum() - tied + (tied + 1) / 2 - middle)[run]
        return pa.table(ranked)

    dealt = typed.mapInArrow(deal, "strip bigint, row bigint, bits bigint, value double")
    kind = "row bigint, i bigint, " + ", ".join(f"r{v} double" for v in range(width))
    ranks = dealt.groupBy("strip").applyInArrow(rank, kind)
    # Few rows and their ranks meet in one task each.
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(max(8, -(-n // BUCKET_ROWS)))).alias("bucket")

    def fold(left: pa.Table, right: pa.Table) -> pa.Table:
        row, known, ranked = left["__row"].to_numpy(), _known(left, k), np.zeros((k, width, left.num_rows))
        order = np.argsort(row)
        of, back = right["i"].to_numpy(), order[np.searchsorted(row, right["row"].to_numpy(), sorter=order)]
        for i, p in enumerate(places):
            ranked[i] = frequent[i][:, p.of(numbers(left, i))]
            for v in range(width):
                ranked[i, v, back[of == i]] = right[f"r{v}"].to_numpy()[of == i]
        return pa.table(_moments_of(iter([(known, ranked)]), k, variants))

    rows = typed.select(*columns, "__row", bucket("__row")).groupBy("bucket")
    met = rows.cogroup(ranks.select("*", bucket("row")).groupBy("bucket")).applyInArrow(fold, _MOMENT_ROWS)
    return _matrix(_added_up(met), columns, _diagonal(typed, columns))
