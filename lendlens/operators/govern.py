"""Fairness by group and portfolio stress scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendlens.functions.columns import band, clip, guarded_ratio, label

# Cohorts (a, b] and stress multipliers on PD and LGD.
COHORT_EDGES = (18, 30, 45, 60, 100)
COHORT_LABELS = ("18-30", "31-45", "46-60", "60+")
SCENARIOS = {
    "Baseline": (1.00, 1.00),
    "Adverse": (1.40, 1.15),
    "Severely Adverse": (2.20, 1.35),
}


def age_cohort() -> Column:
    years = F.abs(F.col("DAYS_BIRTH")) / F.lit(365.25)
    return label(band(years, COHORT_EDGES, closed="right"), COHORT_LABELS)


def declined(score: str = "PD", threshold: float = 0.5) -> Column:
    """1 when the application is declined (score strictly above the threshold)."""
    return (F.col(score) > threshold).cast("int")


def fairness_metrics(df: DataFrame, attribute: Column, label_column: str = "TARGET", decision: str = "declined") -> DataFrame:
    """Approval, true and false positive rates and size per group of a sensitive attribute."""
    y, d = F.col(label_column), F.col(decision)
    counted = (
        df.select(attribute.alias("group"), y.alias("y"), d.alias("d"))
        .where("group is not null")
        .groupBy("group")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if((F.col("d") == 1) & (F.col("y") == 1)).alias("tp"),
            F.count_if((F.col("d") == 1) & (F.col("y") == 0)).alias("fp"),
            F.count_if((F.col("d") == 0) & (F.col("y") == 0)).alias("tn"),
            F.count_if((F.col("d") == 0) & (F.col("y") == 1)).alias("fn"),
        )
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counted.select(
        "group",
        guarded_ratio(tn + fn, F.col("n")).alias("Approval_Rate"),
        guarded_ratio(tp, tp + fn).alias("True_Positive_Rate"),
        guarded_ratio(fp, fp + tn).alias("False_Positive_Rate"),
        F.col("n").alias("Population_Count"),
    )


def disparate_impact(fairness: DataFrame) -> DataFrame:
    """Each group's approval rate over the best group's."""
    # The window sees one row per group of the attribute.
    best = F.max("Approval_Rate").over(Window.partitionBy(F.lit(0)))
    ratio = F.col("Approval_Rate") / F.nullif(best, F.lit(0.0))
    return fairness.select("group", "Approval_Rate", ratio.alias("Disparate_Impact_Ratio"))


def stress_test(losses: DataFrame, scenarios: dict[str, tuple[float, float]] = SCENARIOS) -> DataFrame:
    """Expected loss under PD and LGD multipliers; all scenarios share one scan."""
    ead = F.col("EAD")
    sums = [F.sum(ead).alias("ead")]
    for i, (on_pd, on_lgd) in enumerate(scenarios.values()):
        pd = clip(F.col("PD") * F.lit(on_pd), 0.0, 1.0)
        lgd = clip(F.col("LGD") * F.lit(on_lgd), 0.0, 1.0)
        sums.append(F.sum(pd * lgd * ead).alias(f"el{i}"))
    entries = [
        F.struct(
            F.lit(name).alias("scenario"),
            F.bround(F.col("ead") / 1e9, 4).alias("Total_EAD_Billions"),
            F.bround(F.col(f"el{i}") / 1e9, 4).alias("Total_Expected_Loss_Billions"),
            F.bround(F.try_divide(F.col(f"el{i}"), F.col("ead")), 4).alias("Portfolio_Expected_Loss_Rate"),
            F.lit(on_pd).alias("PD_Multiplier"),
            F.lit(on_lgd).alias("LGD_Multiplier"),
        )
        for i, (name, (on_pd, on_lgd)) in enumerate(scenarios.items())
    ]
    return losses.agg(*sums).select(F.inline(F.array(*entries)))
