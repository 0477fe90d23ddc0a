"""Loss given default, exposure, expected loss and portfolio summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendlens.functions.columns import clip, floor_at, guarded_ratio

MIN_LGD, MAX_LGD = 0.05, 0.95
REVOLVING = "Revolving loans"
REVOLVING_CCF = 0.75
OUTSTANDING_SHARE = 0.70
INTEREST_MARGIN = 0.03
CARRIED = (
    "SK_ID_CURR",
    "TARGET",
    "NAME_CONTRACT_TYPE",
    "FLAG_OWN_REALTY",
    "FLAG_OWN_CAR",
    "NAME_EDUCATION_TYPE",
    "AGE_YEARS",
)


def _either(df: DataFrame, column: str, text: str) -> Column:
    """Condition "column is the text or the number 1"; false when absent or null."""
    if column not in df.columns:
        return F.lit(False)
    kind = dict(df.dtypes)[column]
    match = F.col(column) == text if kind == "string" else F.col(column).cast("int") == 1
    return F.coalesce(match, F.lit(False))


def lgd_heuristic(df: DataFrame) -> DataFrame:
    """Adds LGD = 1 - recovery from collateral, owned assets, repayment record and contract.

    A missing goods price counts as the credit amount, a zero credit as 1, a
    missing payment ratio as 1; absent columns take their neutral value.
    """
    collateral = F.lit(1.0)
    if {"AMT_GOODS_PRICE", "AMT_CREDIT"} <= set(df.columns):
        credit = F.col("AMT_CREDIT")
        cover = F.coalesce(F.col("AMT_GOODS_PRICE"), credit) / F.when(credit == 0, 1.0).otherwise(credit)
        collateral = clip(cover, 0.0, 1.3)
    realty = F.when(_either(df, "FLAG_OWN_REALTY", "Y"), 0.15).otherwise(0.0)
    car = F.when(_either(df, "FLAG_OWN_CAR", "Y"), 0.10).otherwise(0.0)
    revolving = F.when(_either(df, "NAME_CONTRACT_TYPE", REVOLVING), 0.20).otherwise(0.0)
    repaid = F.lit(1.0)
    if "INST_AVG_PAYMENT_RATIO" in df.columns:
        repaid = clip(F.coalesce(F.col("INST_AVG_PAYMENT_RATIO"), F.lit(1.0)), 0.0, 1.5)
    discipline = clip(repaid - 0.5, 0.0, 1.0)
    recovery = F.lit(0.20) + F.lit(0.25) * collateral + realty + car + F.lit(0.15) * discipline - revolving
    return df.withColumn("LGD", clip(F.lit(1.0) - recovery, MIN_LGD, MAX_LGD))


def _with_factor(df: DataFrame, cash_factor: Column, ccf: float) -> DataFrame:
    factor = F.when(_either(df, "NAME_CONTRACT_TYPE", REVOLVING), F.lit(ccf)).otherwise(cash_factor)
    return df.withColumn("EAD_FACTOR", factor).withColumn("EAD", F.col("AMT_CREDIT") * F.col("EAD_FACTOR"))


def ead_static(
    df: DataFrame,
    ccf: float = REVOLVING_CCF,
    outstanding: float = OUTSTANDING_SHARE,
    margin: float = INTEREST_MARGIN,
) -> DataFrame:
    """Exposure: revolving limit times the conversion factor, else a fixed outstanding share."""
    return _with_factor(df, F.lit(outstanding * (1.0 + margin)), ccf)


def ead_dynamic(
    df: DataFrame, durations: DataFrame, ccf: float = REVOLVING_CCF, margin: float = INTEREST_MARGIN
) -> DataFrame:
    """Exposure amortised to each client's duration, joined on the client key.

    Outstanding share = 1 - duration / term, at least 15%. Needs
    CREDIT_TERM_MONTHS; a client without a duration keeps the fixed share.
    """
    joined = df.join(durations.select("SK_ID_CURR", F.col("duration").alias("__months")), "SK_ID_CURR", "left")
    term = clip(F.coalesce(F.col("CREDIT_TERM_MONTHS"), F.lit(24.0)), 6.0, 60.0)
    elapsed = clip(F.col("__months"), 1.0, term)
    share = clip(F.lit(1.0) - elapsed / term, 0.15, 1.0)
    cash = F.coalesce(share, F.lit(OUTSTANDING_SHARE)) * F.lit(1.0 + margin)
    return _with_factor(joined, cash, ccf).drop("__months")


def risk_tier(pd: Column) -> Column:
    return F.when(pd < 0.20, "Prime").when(pd >= 0.50, "Subprime").otherwise("Near-Prime")


def expected_loss(df: DataFrame) -> DataFrame:
    """Loan-level PD, LGD, EAD, their product, its rate and the risk tier, with known metadata."""
    pd, lgd, ead = clip(F.col("PD"), 0.0, 1.0), clip(F.col("LGD"), 0.0, 1.0), floor_at(F.col("EAD"), 0.0)
    credit = F.col("AMT_CREDIT") if "AMT_CREDIT" in df.columns else ead
    loss = pd * lgd * ead
    return df.select(
        *(c for c in CARRIED if c in df.columns),
        pd.alias("PD"),
        lgd.alias("LGD"),
        ead.alias("EAD"),
        credit.cast("double").alias("AMT_CREDIT"),
        loss.alias("EXPECTED_LOSS"),
        F.when(ead > 0, loss / ead * 100.0).otherwise(0.0).alias("EL_RATE_PCT"),
        risk_tier(pd).alias("RISK_TIER"),
    )


def portfolio_summary(losses: DataFrame) -> DataFrame:
    """One row of portfolio totals, means and the overall loss rate."""
    summed = losses.agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.sum("AMT_CREDIT").alias("total_original_credit_limit"),
        F.sum("EAD").alias("total_portfolio_ead"),
        F.sum("EXPECTED_LOSS").alias("total_portfolio_expected_loss"),
        F.avg("PD").alias("mean_pd"),
        F.avg("LGD").alias("mean_lgd"),
        F.avg("EAD").alias("mean_ead"),
        F.avg("EXPECTED_LOSS").alias("mean_el_per_loan"),
    )
    rate = guarded_ratio(F.col("total_portfolio_expected_loss"), F.col("total_portfolio_ead")) * 100.0
    return summed.withColumn("portfolio_el_rate_pct", rate)


def _breakdown(losses: DataFrame, by: str) -> DataFrame:
    grouped = losses.groupBy(by).agg(
        F.count("EXPECTED_LOSS").alias("Loan_Count"),
        F.sum("EAD").alias("Total_EAD"),
        F.sum("EXPECTED_LOSS").alias("Total_EL"),
        F.avg("PD").alias("Mean_PD"),
        F.avg("LGD").alias("Mean_LGD"),
        F.avg("EXPECTED_LOSS").alias("Mean_EL"),
    )
    return grouped.withColumn("EL_Rate_Pct", F.try_divide(F.col("Total_EL"), F.col("Total_EAD")) * 100.0)


def tier_breakdown(losses: DataFrame) -> DataFrame:
    """Counts, sums, means, loss share and loss rate per risk tier."""
    # The window sees one row per tier.
    whole = F.sum("Total_EL").over(Window.partitionBy(F.lit(0)))
    return _breakdown(losses, "RISK_TIER").withColumn("EL_Share_Pct", F.try_divide(F.col("Total_EL"), whole) * 100.0)


def contract_breakdown(losses: DataFrame) -> DataFrame:
    return _breakdown(losses, "NAME_CONTRACT_TYPE").drop("Mean_EL")
