"""Cleaning of applications and instalments.

Each step acts on the columns that are present. Fill values (medians, modes)
are scalars found by narrow passes and enter the plan as literals, so the
cleaning itself is one row-wise projection over the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lendlens.functions.columns import age_years, flag, padded_ratio
from lendlens.operators.profile import row_missing
from lendlens.operators.quantiles import exact_medians

# Fixed values of the data model.
NOT_EMPLOYED = 365243
RARE_CODES = {"CODE_GENDER": "XNA", "NAME_FAMILY_STATUS": "Unknown"}
MISSING_LABEL = "Unknown_Missing"
BUREAU_COLUMNS = tuple(f"AMT_REQ_CREDIT_BUREAU_{span}" for span in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR"))
SOCIAL_COLUMNS = tuple(f"{kind}_{days}_CNT_SOCIAL_CIRCLE" for days in (30, 60) for kind in ("OBS", "DEF"))
AMOUNT_COLUMNS = ("AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS")
SCORE_COLUMNS = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def string_columns(df: DataFrame) -> list[str]:
    return [n for n, kind in df.dtypes if kind == "string"]


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [n for n, kind in df.dtypes if kind in kinds or kind.startswith("decimal")]


@dataclass(frozen=True)
class FillValues:
    """Scalars learned from a table: column medians and modes."""

    medians: Mapping[str, float | None]
    modes: Mapping[str, str | None]


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-null value per column, the smallest one on a tie.

    Values are counted with a map-side combine; one row per column is returned.
    """
    if not columns:
        return {}
    pairs = F.inline(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns)))
    counted = df.select(pairs).where("value is not null").groupBy("name", "value").count()
    best = counted.groupBy("name").agg(F.min(F.struct(-F.col("count"), "value")).alias("top"))
    found = {r["name"]: r["top"]["value"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


def learn_fills(df: DataFrame) -> FillValues:
    """Medians and modes needed by ``clean_applications``."""
    return FillValues(
        exact_medians(df, present(df, AMOUNT_COLUMNS + SCORE_COLUMNS)),
        column_modes(df, present(df, tuple(RARE_CODES))),
    )


def clean_employment(df: DataFrame) -> DataFrame:
    """Turn the not-employed sentinel into a flag and null; add years employed (null -> 0)."""
    days = F.nullif(F.col("DAYS_EMPLOYED"), F.lit(NOT_EMPLOYED))
    return df.withColumns(
        {
            "DAYS_EMPLOYED_ANOM": flag(F.col("DAYS_EMPLOYED") == NOT_EMPLOYED),
            "YEARS_EMPLOYED": F.coalesce(-days / F.lit(365.25), F.lit(0.0)),
            "DAYS_EMPLOYED": days,
        }
    )


def rare_code_to_mode(df: DataFrame, modes: Mapping[str, str | None]) -> DataFrame:
    """Replace rare codes by the column's mode."""
    changed = {
        c: F.when(F.col(c) == RARE_CODES[c], F.lit(modes[c])).otherwise(F.col(c))
        for c in present(df, tuple(RARE_CODES))
        if modes.get(c) is not None
    }
    return df.withColumns(changed) if changed else df


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    chosen = present(df, columns)
    return df.fillna(0.0, chosen) if chosen else df


def median_impute(df: DataFrame, medians: Mapping[str, float | None], columns: Sequence[str] = AMOUNT_COLUMNS) -> DataFrame:
    fills = {c: medians[c] for c in present(df, columns) if medians.get(c) is not None}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()}) if fills else df


def ext_score_impute(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Flag missing external scores, then fill them with the median."""
    flags = {f"{c}_IS_MISSING": F.col(c).isNull().cast("int") for c in present(df, SCORE_COLUMNS)}
    return median_impute(df.withColumns(flags) if flags else df, medians, SCORE_COLUMNS)


def explicit_missing(df: DataFrame) -> DataFrame:
    """Missing categories become a category of their own."""
    return df.fillna(MISSING_LABEL, string_columns(df))


def canonical_ratios(df: DataFrame) -> DataFrame:
    """Age in years and the three canonical ratios (denominators padded by 1e-5)."""
    credit, income, annuity = F.col("AMT_CREDIT"), F.col("AMT_INCOME_TOTAL"), F.col("AMT_ANNUITY")
    return df.withColumns(
        {
            "AGE_YEARS": age_years(),
            "CREDIT_TO_INCOME_RATIO": padded_ratio(credit, income),
            "ANNUITY_TO_INCOME_RATIO": padded_ratio(annuity, income),
            "CREDIT_TO_GOODS_RATIO": padded_ratio(credit, F.col("AMT_GOODS_PRICE")),
        }
    )


def clean_applications(df: DataFrame, fills: FillValues | None = None) -> DataFrame:
    """All application steps in order; ratios use the imputed amounts."""
    fills = fills or learn_fills(df)
    out = clean_employment(df)
    out = rare_code_to_mode(out, fills.modes)
    out = zero_fill(out, BUREAU_COLUMNS)
    out = zero_fill(out, SOCIAL_COLUMNS)
    out = median_impute(out, fills.medians)
    out = ext_score_impute(out, fills.medians)
    return canonical_ratios(explicit_missing(out))


def clean_instalments(df: DataFrame) -> DataFrame:
    """Flag missed payments; a missing payment is 0, a missing entry day is the due day."""
    return df.withColumns(
        {
            "IS_MISSED_PAYMENT": F.col("AMT_PAYMENT").isNull().cast("int"),
            "AMT_PAYMENT": F.coalesce(F.col("AMT_PAYMENT"), F.lit(0.0)),
            "DAYS_ENTRY_PAYMENT": F.coalesce(F.col("DAYS_ENTRY_PAYMENT"), F.col("DAYS_INSTALMENT")),
        }
    )


def _repairs(df: DataFrame, fills: FillValues) -> list[tuple[str, str, str | float | None, Column]]:
    """``step, field, replacement, touched``: what ``clean_applications`` changes, in its order."""
    missing = lambda c: F.col(c).isNull()
    found = []
    if "DAYS_EMPLOYED" in df.columns:
        found.append(("employment_sentinel", "DAYS_EMPLOYED", None, F.col("DAYS_EMPLOYED") == NOT_EMPLOYED))
    for c in present(df, tuple(RARE_CODES)):
        if fills.modes.get(c) is not None:
            found.append(("rare_code", c, fills.modes[c], F.col(c) == RARE_CODES[c]))
    for step, columns in (("bureau_zero_fill", BUREAU_COLUMNS), ("social_zero_fill", SOCIAL_COLUMNS)):
        found += [(step, c, 0.0, missing(c)) for c in present(df, columns)]
    for step, columns in (("median_fill", AMOUNT_COLUMNS), ("score_fill", SCORE_COLUMNS)):
        for c in present(df, columns):
            if fills.medians.get(c) is not None:
                found.append((step, c, float(fills.medians[c]), missing(c)))
    # codes that the mode replaced are not null, so only true gaps count here
    found += [("category_fill", c, MISSING_LABEL, missing(c)) for c in string_columns(df)]
    return found


def _either(replacement: str | float | None) -> tuple[str | None, float | None]:
    """A text's replacement, or a number's."""
    return (None, replacement) if isinstance(replacement, float) else (replacement, None)


def clean_and_report(df: DataFrame, path: str, fills: FillValues | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes the cleaned table to ``path``; returns it and the report of what was changed."""
    fills = fills or learn_fills(df)
    out = clean_applications(df, fills)
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path), cleaning_report(df, fills)


def cleaning_report(df: DataFrame, fills: FillValues | None = None) -> DataFrame:
    """What ``clean_applications`` changes, by one scan of the columns that it touches.

    One row per step and field (``step, field, replacement, value, records``; a text's replacement or
    a number's value) and, under the step ``shape``, rows, columns and missing cells before and after.
    """
    fills = fills or learn_fills(df)
    repairs = _repairs(df, fills)
    marks = {f"__r{i}": flag(touched) for i, (_, _, _, touched) in enumerate(repairs)} | {"__before": row_missing(df)}
    cleaned = clean_applications(df.withColumns(marks), fills)
    kept = [c for c in cleaned.columns if not c.startswith("__")]
    counted = cleaned.withColumn("__after", row_missing(cleaned.select(*kept))).agg(
        F.count(F.lit(1)).alias("rows"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*marks, "__after"])
    )
    entries = [(step, c, *_either(value), F.col(f"__r{i}")) for i, (step, c, value, _) in enumerate(repairs)]
    for when, columns in (("before", df.columns), ("after", kept)):
        shapes = (("rows", F.col("rows")), ("columns", F.lit(len(columns))), ("missing_cells", F.col(f"__{when}")))
        entries += [("shape", f"{name}_{when}", None, None, value) for name, value in shapes]
    kinds = {"step": "string", "field": "string", "replacement": "string", "value": "double"}
    rows = [
        F.struct(*(F.lit(x).cast(kind).alias(n) for x, (n, kind) in zip(e, kinds.items())), e[4].cast("bigint").alias("records"))
        for e in entries
    ]
    return counted.select(F.inline(F.array(*rows)))


def generic_impute(df: DataFrame) -> DataFrame:
    """Fill every string column with its mode and every numeric one with its median."""
    strings, numbers = string_columns(df), numeric_columns(df)
    modes = column_modes(df, strings)
    medians = exact_medians(df, numbers)
    fills = {c: F.coalesce(F.col(c), F.lit(modes[c] or "Unknown")) for c in strings}
    for c in numbers:
        if medians[c] is not None:
            fills[c] = F.coalesce(F.col(c), F.lit(medians[c]))
    return df.withColumns(fills) if fills else df
