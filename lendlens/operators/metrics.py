"""Evaluation of scores against labels.

Ranking metrics rest on cumulative class counts over distinct scores
(``running_sums``); several models are evaluated in one pass by grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendlens.functions.columns import guarded_ratio
from lendlens.operators.prefix import running_sums

# Unit economics and grid of the threshold sweep.
INTEREST_PER_GOOD = 58_000.0
LOSS_PER_BAD = 302_000.0
SWEEP_START, SWEEP_END, SWEEP_COUNT = 0.01, 0.99, 100


def score_ladder(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: class counts at it, strictly below it, and in total.

    Totals come from a plain counting scan, one row per model.
    """
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    ladder = running_sums(known, score, {"pos": pos, "neg": neg}, by)
    totals = known.groupBy(*by).agg(pos.alias("n_pos"), neg.alias("n_neg"))
    if by:
        return ladder.join(totals, list(by))
    row = totals.first()
    return ladder.withColumns({"n_pos": F.lit(row["n_pos"]), "n_neg": F.lit(row["n_neg"])})


def _auc() -> Column:
    """ROC-AUC over a ladder; a tie counts half, null with a single class."""
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max(F.col("n_pos").cast("double") * F.col("n_neg"))
    return won / F.nullif(pairs, F.lit(0.0))


def auc_from_ladder(ladder: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC and Gini."""
    return ladder.groupBy(*by).agg(_auc().alias("roc_auc")).withColumn("gini", 2 * F.col("roc_auc") - 1)


def roc_auc_gini(df: DataFrame, label: str = "TARGET", score: str = "PD", by: Sequence[str] = ()) -> DataFrame:
    return auc_from_ladder(score_ladder(df, label, score, by), by)


def _ks(score: str) -> Column:
    """Least struct of (negative gap, score) over a ladder; null with a single class."""
    share = lambda n: F.when(F.col(f"n_{n}") > 0, (F.col(f"{n}_before") + F.col(n)) / F.col(f"n_{n}"))
    gap = F.abs(share("pos") - share("neg"))
    # Rounding settles which of two equal gaps wins, whatever their last bits are.
    return F.min(F.when(gap.isNotNull(), F.struct((-F.round(gap, 12)).alias("gap"), F.col(score).alias("at"))))


def ks_from_ladder(ladder: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Largest gap between the class distribution functions and the lowest score where it occurs."""
    top = ladder.groupBy(*by).agg(_ks(score).alias("best")).where("best is not null")
    return top.select(
        *by,
        F.coalesce(-F.col("best.gap"), F.lit(0.0)).alias("ks_statistic"),
        F.col("best.at").alias("ks_threshold"),
    )


def ks_statistic(df: DataFrame, label: str = "TARGET", score: str = "PD", by: Sequence[str] = ()) -> DataFrame:
    return ks_from_ladder(score_ladder(df, label, score, by), score, by)


def _precision_recall() -> tuple[Column, Column]:
    """Area under precision-recall by trapezoid, and average precision, over a ladder.

    At each distinct score s the classifier "score >= s" has
    tp = total - before; the previous (stricter) point has tp minus the ties,
    so no neighbouring row is needed. The curve starts at recall 0, precision 1.
    """
    tp, fp = F.col("n_pos") - F.col("pos_before"), F.col("n_neg") - F.col("neg_before")
    tp_prev, fp_prev = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / F.nullif(tp + fp, F.lit(0))
    precision_prev = F.when(tp_prev + fp_prev > 0, tp_prev / F.nullif(tp_prev + fp_prev, F.lit(0))).otherwise(1.0)
    step = F.col("pos") / F.nullif(F.col("n_pos"), F.lit(0))
    return F.sum(step * (precision + precision_prev) / 2), F.sum(step * precision)


def pr_from_ladder(ladder: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    area, average = _precision_recall()
    return ladder.groupBy(*by).agg(area.alias("pr_auc"), average.alias("average_precision"))


def pr_auc_trapezoid(df: DataFrame, label: str = "TARGET", score: str = "PD", by: Sequence[str] = ()) -> DataFrame:
    return pr_from_ladder(score_ladder(df, label, score, by), by).select(*by, "pr_auc")


def average_precision(df: DataFrame, label: str = "TARGET", score: str = "PD", by: Sequence[str] = ()) -> DataFrame:
    return pr_from_ladder(score_ladder(df, label, score, by), by).select(*by, "average_precision")


def brier_score(df: DataFrame, label: str = "TARGET", score: str = "PD", by: Sequence[str] = ()) -> DataFrame:
    gap = F.col(score) - F.col(label)
    return df.groupBy(*by).agg(F.avg(gap * gap).alias("brier_score"))


def confusion_metrics(
    df: DataFrame, label: str = "TARGET", score: str = "PD", threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts at ``score >= threshold`` and the rates from them (0 when undefined)."""
    hit, bad = F.col(score) >= threshold, F.col(label) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(hit & bad).alias("tp"),
        F.count_if(hit & ~bad).alias("fp"),
        F.count_if(~hit & ~bad).alias("tn"),
        F.count_if(~hit & bad).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.withColumns(
        {
            "total_samples": tp + fp + tn + fn,
            "accuracy": guarded_ratio(tp + tn, tp + fp + tn + fn),
            "precision": guarded_ratio(tp, tp + fp),
            "recall_sensitivity": guarded_ratio(tp, tp + fn),
            "specificity": guarded_ratio(tn, tn + fp),
            "f1_score": guarded_ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def model_benchmark(
    df: DataFrame, label: str = "TARGET", score: str = "PD", threshold: float = 0.5, model: str = "model_name"
) -> DataFrame:
    """Every metric per model of a long (model, key, label, score) table."""
    by = [model]
    ladder = score_ladder(df, label, score, by)
    area, average = _precision_recall()
    ranked = ladder.groupBy(*by).agg(
        _auc().alias("roc_auc"), area.alias("pr_auc"), average.alias("average_precision"), _ks(score).alias("best")
    )
    ranked = ranked.withColumns(
        {
            "gini": 2 * F.col("roc_auc") - 1,
            "ks_statistic": F.coalesce(-F.col("best.gap"), F.lit(0.0)),
            "ks_threshold": F.col("best.at"),
        }
    ).drop("best")
    # one row per model on every side
    out = ranked.join(brier_score(df, label, score, by), by).join(confusion_metrics(df, label, score, threshold, by), by)
    return out.withColumn("eval_threshold", F.lit(threshold))


def threshold_profit_sweep(df: DataFrame, label: str = "TARGET", score: str = "PD") -> DataFrame:
    """Approval, default rate and profit at 100 thresholds; approved means score < threshold.

    Each row is assigned the first threshold that approves it; 100 counts are
    then accumulated, instead of comparing every row with every threshold.
    """
    step = (SWEEP_END - SWEEP_START) / (SWEEP_COUNT - 1)
    at = lambda k: F.lit(SWEEP_START) + k * F.lit(step)
    p = F.col(score)
    guess = F.greatest(F.lit(0).cast("bigint"), F.floor((p - F.lit(SWEEP_START)) / F.lit(step)))
    # The guess may be off by one in the last bit; the comparison settles it.
    first = F.when(p < at(guess), guess).when(p < at(guess + 1), guess + 1).otherwise(guess + 2)
    counted = (
        df.where(p.isNotNull())
        .groupBy(first.alias("k"))
        .agg(F.count_if(F.col(label) == 0).alias("good"), F.count_if(F.col(label) == 1).alias("bad"))
    )
    ladder = df.sparkSession.range(SWEEP_COUNT + 2).withColumnRenamed("id", "k").join(counted, "k", "left")
    # At most 102 rows from here on.
    upto = Window.partitionBy(F.lit(0)).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(0))
    zero = F.lit(0).cast("bigint")
    swept = ladder.select(
        "k",
        F.sum(F.coalesce("good", zero)).over(upto).alias("tn"),
        F.sum(F.coalesce("bad", zero)).over(upto).alias("fn"),
        F.sum(F.coalesce("good", zero)).over(whole).alias("goods"),
        F.sum(F.coalesce("bad", zero)).over(whole).alias("bads"),
    ).where(F.col("k") < SWEEP_COUNT)
    approved = F.col("tn") + F.col("fn")
    interest, losses = F.col("tn") * F.lit(INTEREST_PER_GOOD), F.col("fn") * F.lit(-LOSS_PER_BAD)
    return swept.select(
        at(F.col("k")).alias("threshold"),
        guarded_ratio(approved, F.col("goods") + F.col("bads")).alias("approval_rate"),
        guarded_ratio(F.col("fn"), approved).alias("portfolio_default_rate"),
        F.col("tn").alias("approved_good_tn"),
        F.col("fn").alias("approved_bad_fn"),
        (F.col("goods") - F.col("tn")).alias("rejected_good_fp"),
        (F.col("bads") - F.col("fn")).alias("rejected_bad_tp"),
        interest.alias("interest_earned_usd"),
        losses.alias("default_losses_usd"),
        (interest + losses).alias("net_profit_usd"),
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """R2, MAE, RMSE and the mean and population deviation of the prediction."""
    y, p = F.col(actual), F.col(predicted)
    sums = df.agg(
        F.avg((y - p) * (y - p)).alias("mse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.var_pop(y).alias("var"),
        F.avg(p).alias("mean_pred"),
        F.stddev_pop(p).alias("std_pred"),
    )
    return sums.select(
        (1 - F.col("mse") / F.nullif(F.col("var"), F.lit(0.0))).alias("r2_score"),
        "mae",
        F.sqrt("mse").alias("rmse"),
        "mean_pred",
        "std_pred",
    )
