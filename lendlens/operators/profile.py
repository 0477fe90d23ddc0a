"""Profiling: missing values, column ranges, class balance, distributions.

Every report costs a fixed number of narrow scans and returns a few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendlens.functions.columns import age_years, cap_at
from lendlens.operators.quantiles import exact_quantiles

_INTEGERS = {"tinyint", "smallint", "int", "bigint"}
_FLOATS = {"float", "double"}
_NARROWER = (("tinyint", -(2**7), 2**7 - 1), ("smallint", -(2**15), 2**15 - 1), ("int", -(2**31), 2**31 - 1))


def _one_row_each(df: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per mapping."""
    entries = [F.struct(*(c.alias(n) for n, c in row.items())) for row in rows]
    return df.select(F.inline(F.array(*entries)))


def missing_summary(df: DataFrame, top_n: int | None = None) -> DataFrame:
    """Columns with missing values: count, percentage and type, worst first."""
    counted = df.agg(F.count(F.lit(1)).alias("total"), *(F.count(F.col(c)).alias(c) for c in df.columns))
    rows = [
        {
            "column": F.lit(name),
            "missing_count": F.col("total") - F.col(name),
            "missing_pct": (F.col("total") - F.col(name)) * 100.0 / F.nullif(F.col("total"), F.lit(0)),
            "dtype": F.lit(kind),
        }
        for name, kind in df.dtypes
    ]
    report = _one_row_each(counted, rows).where(F.col("missing_count") > 0)
    report = report.orderBy(F.desc("missing_pct"), "column")
    return report if top_n is None else report.limit(top_n)


def row_missing(df: DataFrame) -> Column:
    """Number of null cells in a row."""
    total = F.lit(0).cast("bigint")
    for c in df.columns:
        total = total + F.col(c).isNull().cast("int")
    return total


def inspect_dataset(df: DataFrame, name: str = "dataset") -> DataFrame:
    """One row: shape, columns with gaps, missing cells and the type mix."""
    kinds: dict[str, int] = {}
    for _, kind in df.dtypes:
        kinds[kind] = kinds.get(kind, 0) + 1
    n_cols = len(df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("total"), *(F.count(F.col(c)).alias(c) for c in df.columns))
    gaps = [F.col("total") - F.col(c) for c in df.columns]
    missing, with_gaps = F.lit(0), F.lit(0)
    for gap in gaps:
        missing = missing + gap
        with_gaps = with_gaps + (gap > 0).cast("int")
    cells = F.col("total") * n_cols
    return counted.select(
        F.lit(name).alias("name"),
        F.col("total").alias("n_rows"),
        F.lit(n_cols).cast("bigint").alias("n_cols"),
        with_gaps.cast("bigint").alias("columns_with_missing"),
        missing.alias("missing_cells"),
        F.when(cells > 0, missing * 100.0 / cells).otherwise(0.0).alias("missing_pct"),
        F.lit(",".join(f"{k}:{kinds[k]}" for k in sorted(kinds))).alias("dtype_counts"),
    )


def _chosen_type(kind: str, low: Column, high: Column) -> Column:
    if kind in _FLOATS:
        return F.lit("float")
    choice = F.lit("bigint")
    for name, bottom, top in reversed(_NARROWER):
        choice = F.when((low > bottom) & (high < top), name).otherwise(choice)
    return choice


def numeric_narrowing(df: DataFrame) -> DataFrame:
    """Observed range of each numeric column and the smallest type for it.

    Integer bounds are strict, so a column reaching a type's limit moves up.
    """
    numeric = [(n, k) for n, k in df.dtypes if k in _INTEGERS | _FLOATS]
    ranged = df.agg(*(f(F.col(n)).alias(f"{n}_{s}") for n, _ in numeric for s, f in (("lo", F.min), ("hi", F.max))))
    rows = []
    for name, kind in numeric:
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        rows.append(
            {
                "column": F.lit(name),
                "min_value": low.cast("double"),
                "max_value": high.cast("double"),
                "current_type": F.lit(kind),
                "chosen_type": _chosen_type(kind, low, high),
            }
        )
    return _one_row_each(ranged, rows)


def narrow_types(df: DataFrame) -> DataFrame:
    """``df`` cast to the types chosen by ``numeric_narrowing``."""
    chosen = {r["column"]: r["chosen_type"] for r in numeric_narrowing(df).collect()}
    return df.select(*(F.col(c).cast(chosen[c]).alias(c) if c in chosen else F.col(c) for c in df.columns))


def target_distribution(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Rows and share per class, with the table total and the default rate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(target) == 0).alias("n0"),
        F.count_if(F.col(target) == 1).alias("n1"),
    )
    labelled = F.nullif(F.col("n0") + F.col("n1"), F.lit(0))
    rows = [
        {
            "TARGET": F.lit(value),
            "n": F.col(f"n{value}"),
            "share_pct": F.col(f"n{value}") * 100.0 / labelled,
            "total_records": F.col("total"),
            "default_rate_pct": F.col("n1") * 100.0 / labelled,
        }
        for value in (0, 1)
    ]
    return _one_row_each(counted, rows)


def imbalance_ratio(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Negatives per positive, also the class weight of the boosted models."""
    return df.agg(
        F.count_if(F.col(target) == 0).alias("n_negative"),
        F.count_if(F.col(target) == 1).alias("n_positive"),
    ).withColumn("ratio", F.try_divide(F.col("n_negative").cast("double"), F.col("n_positive")))


def _median_rows(df: DataFrame, variables: Mapping[str, Column], target: str) -> DataFrame:
    wanted = {
        f"{name}|{value}": (F.when(F.col(target) == value, column.cast("double")), [0.5])
        for name, column in variables.items()
        for value in (0, 1)
    }
    found = exact_quantiles(df, wanted)
    rows = [
        (name, value, found[f"{name}|{value}"][0]) for name in variables for value in (0, 1)
    ]
    return df.sparkSession.createDataFrame(rows, "variable string, TARGET int, median double")


def class_medians(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Medians of credit, income (up to its own 99th percentile), annuity and age by class."""
    income = F.col("AMT_INCOME_TOTAL").cast("double")
    top = exact_quantiles(df, {"income": (income, [0.99])})["income"][0]
    variables = {
        "AMT_CREDIT": F.col("AMT_CREDIT"),
        "AMT_INCOME_TOTAL": F.when(income <= F.lit(top), income),
        "AMT_ANNUITY": F.col("AMT_ANNUITY"),
        "AGE_YEARS": age_years(),
    }
    return _median_rows(df, variables, target)


def ext_score_medians(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Medians of the external scores by class."""
    scores = [c for c in ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3") if c in df.columns]
    return _median_rows(df, {c: F.col(c) for c in scores}, target)


def _equal_width(df: DataFrame, column: str, bins: int) -> tuple[float, float, Column]:
    """Range of a column and the bin number of a value; the last bin is closed."""
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    low, high = row["lo"], row["hi"]
    if low is None:
        return 0.0, 0.0, F.lit(None).cast("int")
    low, width = float(low), (float(high) - float(low)) / bins
    if width == 0:
        return low, width, F.when(F.col(column).isNotNull(), 0)
    number = F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("int")
    return low, width, cap_at(number, bins - 1)


def class_density(df: DataFrame, column: str, bins: int = 50, target: str = "TARGET") -> DataFrame:
    """Histogram density of a column per class over shared equal-width bins."""
    _, width, number = _equal_width(df, column, bins)
    counted = df.where(F.col(column).isNotNull()).groupBy(target, number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # The window sees the aggregated report only: at most ``bins`` rows per class.
    total = F.sum("n").over(Window.partitionBy(target))
    scale = F.nullif(total * F.lit(width), F.lit(0.0))
    return counted.select(target, "bin", "n", (F.col("n") / scale).alias("density"))


def score_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts per equal-width bin between the column's extremes, empty bins kept."""
    low, width, number = _equal_width(df, column, bins)
    counted = df.where(F.col(column).isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def trimmed_box_stats(df: DataFrame, columns: Sequence[str], target: str = "TARGET") -> DataFrame:
    """Box-plot statistics by class after trimming each column to [p01, p95]."""
    edges = exact_quantiles(df, {c: (F.col(c).cast("double"), [0.01, 0.95]) for c in columns})
    kept = {}
    for c in columns:
        low, high = edges[c]
        for value in (0, 1):
            inside = (F.col(target) == value) & (F.col(c) >= F.lit(low)) & (F.col(c) <= F.lit(high))
            kept[c, value] = F.when(inside, F.col(c).cast("double"))
    boxes = exact_quantiles(df, {f"{c}|{v}": (x, [0.25, 0.5, 0.75]) for (c, v), x in kept.items()})
    means = df.agg(
        *(F.struct(F.count(x).alias("n"), F.avg(x).alias("mean")).alias(f"{c}|{v}") for (c, v), x in kept.items())
    ).first()
    rows = [
        (c, v, means[f"{c}|{v}"]["n"], means[f"{c}|{v}"]["mean"], *boxes[f"{c}|{v}"]) for c, v in kept
    ]
    kind = "metric string, TARGET int, n bigint, mean double, q25 double, median double, q75 double"
    return df.sparkSession.createDataFrame(rows, kind)
