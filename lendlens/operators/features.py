"""Application and instalment features, and the joined feature matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendlens.functions.columns import (
    age_years,
    clip,
    flag,
    floor_at,
    padded_ratio,
    row_mean,
    row_std,
)
from lendlens.operators.clean import SCORE_COLUMNS, numeric_columns

RECENT_DAYS = -180


def calculate_dti(df: DataFrame) -> DataFrame:
    """Debt-to-income with an exact division; null for a zero income."""
    ratio = F.try_divide(F.col("AMT_ANNUITY").cast("double"), F.col("AMT_INCOME_TOTAL"))
    return df.withColumn("DEBT_TO_INCOME_RATIO", ratio)


def calculate_employment_ratio(df: DataFrame) -> DataFrame:
    """Days employed over days lived with an exact division."""
    ratio = F.try_divide(F.col("DAYS_EMPLOYED").cast("double"), F.col("DAYS_BIRTH"))
    return df.withColumn("EMPLOYMENT_TO_AGE_RATIO", ratio)


def burden_ratios(df: DataFrame) -> DataFrame:
    """Five burden ratios, denominators padded by 1e-5."""
    credit, income = F.col("AMT_CREDIT"), F.col("AMT_INCOME_TOTAL")
    annuity, goods = F.col("AMT_ANNUITY"), F.col("AMT_GOODS_PRICE")
    return df.withColumns(
        {
            "DEBT_TO_INCOME_RATIO": padded_ratio(annuity, income),
            "CREDIT_TO_INCOME_RATIO": padded_ratio(credit, income),
            "ANNUITY_TO_INCOME_RATIO": padded_ratio(annuity, income),
            "CREDIT_TO_GOODS_RATIO": padded_ratio(credit, goods),
            "PAYMENT_BURDEN_INDEX": padded_ratio(annuity, credit),
        }
    )


def demographic_ratios(df: DataFrame) -> DataFrame:
    """Employment over age, and income per family member before and after the annuity."""
    income, members = F.col("AMT_INCOME_TOTAL"), F.col("CNT_FAM_MEMBERS")
    left_over = income - F.coalesce(F.col("AMT_ANNUITY"), F.lit(0.0))
    return df.withColumns(
        {
            "EMPLOYMENT_TO_AGE_RATIO": padded_ratio(F.col("DAYS_EMPLOYED"), F.col("DAYS_BIRTH")),
            "DISPOSABLE_INCOME_PER_MEMBER": padded_ratio(left_over, members),
            "INCOME_PER_FAMILY_MEMBER": padded_ratio(income, members),
        }
    )


def ext_score_features(df: DataFrame) -> DataFrame:
    """Combinations of the external scores; an absent score column counts as 0.5.

    Mean and minimum skip nulls; product and weighted sum do not.
    """
    absent = {c: F.lit(0.5) for c in SCORE_COLUMNS if c not in df.columns}
    if absent:
        df = df.withColumns(absent)
    one, two, three = (F.col(c) for c in SCORE_COLUMNS)
    with_mean = df.withColumn("EXT_SOURCE_MEAN", row_mean([one, two, three]))
    mean = F.col("EXT_SOURCE_MEAN")
    return with_mean.withColumns(
        {
            "EXT_SOURCE_MIN": F.least(one, two, three),
            "EXT_SOURCE_PRODUCT": one * two * three,
            "EXT_SOURCE_WEIGHTED": one * 2 + two * 3 + three,
            "EXT_SOURCE_X_AGE": mean * age_years(),
            "EXT_SOURCE_X_DTI": mean * F.col("DEBT_TO_INCOME_RATIO"),
        }
    )


def credit_term(df: DataFrame) -> Column:
    """Contract months in [6, 60]: the stored term, else credit over annuity."""
    if "CREDIT_TERM_MONTHS" in df.columns:
        return clip(F.col("CREDIT_TERM_MONTHS"), 6.0, 60.0)
    return clip(F.col("AMT_CREDIT") / floor_at(F.col("AMT_ANNUITY"), 1.0), 6.0, 60.0)


def metadata_app_features(df: DataFrame) -> DataFrame:
    """Application features known by name from the published feature list.

    EXT_SOURCE_STD is the sample deviation of a row's known scores.
    """
    scores = [F.col(c) for c in SCORE_COLUMNS]
    years = F.coalesce(-F.nullif(F.col("DAYS_EMPLOYED"), F.lit(365243)) / F.lit(365.25), F.lit(0.0))
    return df.withColumns(
        {
            "CREDIT_TERM_MONTHS": credit_term(df),
            "CREDIT_TO_AGE_RATIO": padded_ratio(F.col("AMT_CREDIT"), age_years()),
            "EXT_SOURCE_STD": row_std(scores),
            "EXT_SOURCE_MAX": F.greatest(*scores),
            "EXT_SOURCE_X_EMPLOYED": row_mean(scores) * years,
        }
    )


def application_features(df: DataFrame) -> DataFrame:
    """Burden, demographic and external-score features in one projection."""
    return ext_score_features(demographic_ratios(burden_ratios(df)))


def instalment_scalars(df: DataFrame) -> DataFrame:
    """Days past due, late flag, padded payment ratio and deficit per payment."""
    due, paid = F.col("AMT_INSTALMENT"), F.col("AMT_PAYMENT")
    late_by = floor_at(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT"), 0)
    return df.withColumns(
        {
            "DPD": late_by,
            "LATE_PAYMENT": flag(late_by > 0),
            "PAYMENT_RATIO": padded_ratio(paid, due),
            "PAYMENT_DEFICIT": floor_at(due - paid, 0.0),
        }
    )


def repayment_scalars(df: DataFrame) -> DataFrame:
    """As above with an unpadded ratio (1 for a non-positive due amount), days early and underpaid flag."""
    due, paid = F.col("AMT_INSTALMENT"), F.col("AMT_PAYMENT")
    entered, planned = F.col("DAYS_ENTRY_PAYMENT"), F.col("DAYS_INSTALMENT")
    late_by = floor_at(entered - planned, 0)
    deficit = floor_at(due - paid, 0.0)
    return df.withColumns(
        {
            "DPD": late_by,
            "DAYS_EARLY": floor_at(planned - entered, 0),
            "PAYMENT_DEFICIT": deficit,
            "PAYMENT_RATIO": F.when(due > 0, paid / due).otherwise(F.lit(1.0)),
            "IS_LATE": flag(late_by > 0),
            "IS_UNDERPAID": flag(deficit > 1.0),
        }
    )


def _recent(value: Column) -> Column:
    return F.when(F.col("DAYS_INSTALMENT") >= RECENT_DAYS, value)


def _coded_aggregates(ratio: str = "PAYMENT_RATIO") -> list[Column]:
    return [
        F.avg("DPD").alias("INST_AVG_DPD"),
        F.max("DPD").cast("double").alias("INST_MAX_DPD"),
        F.avg("LATE_PAYMENT").alias("INST_PCT_LATE"),
        F.avg(ratio).alias("INST_AVG_PAYMENT_RATIO"),
        F.sum("PAYMENT_DEFICIT").alias("INST_TOTAL_DEFICIT"),
        F.avg("PAYMENT_DEFICIT").alias("INST_AVG_DEFICIT"),
        F.avg(_recent(F.col("DPD"))).alias("INST_REC180_AVG_DPD"),
    ]


def _published_aggregates() -> list[Column]:
    deficit = F.col("PAYMENT_DEFICIT")
    return [
        F.count(F.lit(1)).alias("INST_TOTAL_INSTALLMENTS"),
        F.sum("IS_LATE").alias("INST_COUNT_LATE"),
        F.min("PAYMENT_RATIO").alias("INST_MIN_PAYMENT_RATIO"),
        F.stddev_samp("PAYMENT_RATIO").alias("INST_PAYMENT_RATIO_STD"),
        F.avg(deficit).alias("__avg_deficit"),
        F.max(deficit).alias("INST_MAX_DEFICIT"),
        F.sum("IS_UNDERPAID").alias("INST_COUNT_UNDERPAID"),
        F.avg("IS_UNDERPAID").alias("INST_PCT_UNDERPAID"),
        F.avg("DAYS_EARLY").alias("INST_AVG_DAYS_EARLY"),
        F.sum("IS_MISSED_PAYMENT").alias("INST_COUNT_MISSED"),
        F.count(_recent(F.lit(1))).alias("INST_REC180_COUNT"),
        F.avg(_recent(F.col("IS_LATE"))).alias("INST_REC180_PCT_LATE"),
        F.avg(_recent(deficit)).alias("INST_REC180_AVG_DEFICIT"),
    ]


def _dpd_velocity() -> Column:
    return padded_ratio(F.col("INST_REC180_AVG_DPD"), F.col("INST_AVG_DPD"))


def _deficit_velocity() -> Column:
    return padded_ratio(F.col("INST_REC180_AVG_DEFICIT"), F.col("__avg_deficit"))


def _no_gaps(df: DataFrame) -> DataFrame:
    """Gaps of numbers as 0; the key is left as it is, so its partitioning is known to what follows."""
    return df.fillna(0.0, [c for c in numeric_columns(df) if c != "SK_ID_CURR"])


def instalment_features(df: DataFrame) -> DataFrame:
    """Per-client repayment features; recency shares the same aggregate.

    One group-by with partial sums on the map side, so a client owning a large
    share of all payments still sends one row per task.
    """
    grouped = instalment_scalars(df).groupBy("SK_ID_CURR").agg(*_coded_aggregates())
    return _no_gaps(grouped.withColumn("INST_DPD_VELOCITY", _dpd_velocity()))


def metadata_inst_features(df: DataFrame) -> DataFrame:
    """Per-client features known by name from the published feature list.

    Expects cleaned instalments (with IS_MISSED_PAYMENT).
    """
    grouped = repayment_scalars(df).groupBy("SK_ID_CURR").agg(*_published_aggregates())
    return _no_gaps(grouped.withColumn("INST_DEFICIT_VELOCITY", _deficit_velocity()).drop("__avg_deficit"))


def client_features(df: DataFrame) -> DataFrame:
    """Both feature sets from one scan and one shuffle of the cleaned instalments."""
    padded = instalment_scalars(df).withColumnRenamed("PAYMENT_RATIO", "PADDED_RATIO")
    grouped = (
        repayment_scalars(padded)
        .groupBy("SK_ID_CURR")
        .agg(*_coded_aggregates("PADDED_RATIO"), *_published_aggregates())
    )
    with_velocity = grouped.withColumns(
        {"INST_DPD_VELOCITY": _dpd_velocity(), "INST_DEFICIT_VELOCITY": _deficit_velocity()}
    )
    return _no_gaps(with_velocity.drop("__avg_deficit"))


def attach_instalments(apps: DataFrame, inst_features: DataFrame) -> DataFrame:
    """Left join of client features; clients without history get zeros and a flag."""
    marked = inst_features.withColumn("__seen", F.lit(1))
    joined = apps.join(marked, "SK_ID_CURR", "left")
    return joined.withColumn("NO_INSTALLMENT_HISTORY", F.col("__seen").isNull().cast("int")).drop("__seen")


def feature_matrix(apps: DataFrame, inst: DataFrame) -> DataFrame:
    """Application features left-joined with instalment features, gaps as 0.

    Payments are reduced to one row per client before they meet the join.
    """
    joined = attach_instalments(application_features(apps), instalment_features(inst))
    return _no_gaps(joined)
