"""Time-to-default: data set, Kaplan-Meier, concordance, calibration, personas."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendlens.functions.columns import cap_at, floor_at
from lendlens.operators.features import credit_term
from lendlens.operators.prefix import find_cuts, running_sums
from lendlens.operators.quantiles import exact_medians, exact_quantiles
from lendlens.sources.session import let_workers_import, stage

# Default covariates, tier names and horizons.
COVARIATES = (
    "EXT_SOURCE_MEAN",
    "EXT_SOURCE_MIN",
    "PAYMENT_BURDEN_INDEX",
    "DEBT_TO_INCOME_RATIO",
    "ANNUITY_TO_INCOME_RATIO",
    "AGE_YEARS",
    "YEARS_EMPLOYED",
    "INST_AVG_DPD",
    "INST_PCT_LATE",
    "INST_AVG_DEFICIT",
    "INST_TOTAL_INSTALLMENTS",
    "REGION_RATING_CLIENT_W_CITY",
    "AMT_CREDIT",
    "AMT_ANNUITY",
)
TIERS = ("Prime (Tier 1 - Low Risk)", "Near-Prime (Tier 2)", "Subprime (Tier 3 - High Risk)")
MILESTONES = (12, 24, 36, 48, 60)
# Mean share of the term at which a default occurs, for clients often late and for others.
EARLY_SHARE, USUAL_SHARE = 3.0 / 11.0, 2.0 / 5.0
MAX_MONTHS = 60
#: Rows of a range of risks or durations whose pairs one task counts, and the most ranges of either.
STRIP_ROWS, GRID_RANGES = 100_000, 512


def survival_dataset(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Duration in months and event flag with right-censoring at the contract term.

    A default happens in EVENT_MONTH when that column is present, else at the
    mean share of the term.
    """
    term = credit_term(df)
    if "EVENT_MONTH" in df.columns:
        month = F.col("EVENT_MONTH").cast("double")
    elif "INST_PCT_LATE" in df.columns:
        month = term * F.when(F.col("INST_PCT_LATE") > 0.3, EARLY_SHARE).otherwise(USUAL_SHARE)
    else:
        month = term * F.lit(USUAL_SHARE)
    defaulted = cap_at(floor_at(month, 1.0), term)
    return df.select(
        "SK_ID_CURR",
        F.when(F.col("TARGET") == 1, defaulted).otherwise(term).alias("duration"),
        F.col("TARGET").cast("int").alias("event"),
        *keep,
    )


def learn_scalers(df: DataFrame, covariates: Sequence[str] = COVARIATES) -> dict[str, tuple[float, float, float]]:
    """Median, mean and population deviation per covariate (after the median fill).

    A column without values has median 0; a deviation below 1e-7 counts as 1.
    """
    chosen = [c for c in covariates if c in df.columns]
    medians = {c: m if m is not None else 0.0 for c, m in exact_medians(df, chosen).items()}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in chosen}
    row = df.agg(*(F.struct(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).alias(c) for c, x in filled.items())).first()
    return {
        c: (medians[c], row[c]["m"] or 0.0, row[c]["s"] if (row[c]["s"] or 0.0) >= 1e-7 else 1.0) for c in chosen
    }


def standardize(df: DataFrame, scalers: dict[str, tuple[float, float, float]]) -> DataFrame:
    """Median-filled z-scores of the scaled columns."""
    return df.withColumns(
        {
            c: (F.coalesce(F.col(c).cast("double"), F.lit(median)) - F.lit(mean)) / F.lit(std)
            for c, (median, mean, std) in scalers.items()
        }
    )


def risk_terciles(df: DataFrame, score: str = "EXT_SOURCE_MEAN") -> DataFrame:
    """Adds ``tier`` from the 33rd and 66th percentile of the median-filled score."""
    value = F.col(score).cast("double")
    median = exact_quantiles(df, {"m": (value, [0.5])})["m"][0]
    filled = F.coalesce(value, F.lit(median))
    low, high = exact_quantiles(df, {"q": (filled, [0.33, 0.66])})["q"]
    tier = F.when(filled >= F.lit(high), TIERS[0]).when(filled < F.lit(low), TIERS[2]).otherwise(TIERS[1])
    return df.withColumn("tier", tier)


def kaplan_meier(df: DataFrame, by: str = "tier") -> DataFrame:
    """Survival curve per group at each distinct duration.

    Events and exits are counted per (group, duration) before any ordering;
    the product over times is a cumulative sum of logs, with the step where
    everyone at risk defaults handled apart (its log is undefined).
    """
    counts = {"exits": F.count(F.lit(1)), "events": F.sum("event")}
    cuts = find_cuts(df, "duration")
    ladder = running_sums(df, "duration", counts, [by], cuts)
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("size"))
    steps = ladder.join(sizes, by).withColumn("at_risk", F.col("size") - F.col("exits_before"))
    wiped = F.col("events") == F.col("at_risk")
    log_keep = F.when(wiped, 0.0).otherwise(F.ln(F.when(wiped, 1.0).otherwise(1 - F.col("events") / F.col("at_risk"))))
    # The step values ride on the same ranges: two more sums over distinct durations.
    logged = steps.select(by, "duration", "at_risk", "events", log_keep.alias("step"), wiped.cast("int").alias("zero"))
    summed = running_sums(
        logged,
        "duration",
        {"step_sum": F.sum("step"), "zeros": F.sum("zero"), "at_risk": F.max("at_risk"), "events": F.max("events")},
        [by],
        cuts,
    )
    survival = F.when(F.col("zeros_before") + F.col("zeros") > 0, 0.0).otherwise(
        F.exp(F.col("step_sum_before") + F.col("step_sum"))
    )
    return summed.select(by, "duration", "at_risk", "events", survival.alias("survival"))


def km_milestones(curve: DataFrame, by: str = "tier", months: Sequence[int] = MILESTONES) -> DataFrame:
    """Survival read from the step curve at each milestone (1 before the first step)."""
    reads = [
        F.coalesce(
            F.max_by(F.when(F.col("duration") <= m, F.col("survival")), F.when(F.col("duration") <= m, F.col("duration"))),
            F.lit(1.0),
        ).alias(f"{m}M_Survival")
        for m in months
    ]
    return curve.groupBy(by).agg(*reads)


def _later_rows(cls: np.ndarray, value: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many rows (``n`` counts them) of higher classes have a lower value, and the same value.

    Classes are dense ranks. Two different ones first differ at exactly one bit, so a pair is met once,
    among the rows that share the bits above it.
    """
    below, same = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
    by_value = np.lexsort((cls, value))

    def at_start(changes: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return sums[np.maximum.accumulate(np.where(changes, np.arange(len(changes)), 0))]

    def differs(*columns: np.ndarray) -> np.ndarray:
        return np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])

    for bit in reversed(range(int(cls.max()).bit_length())):
        order = by_value[np.argsort(cls[by_value] >> (bit + 1), kind="stable")]
        group, v, high = cls[order] >> (bit + 1), value[order], cls[order] >> bit & 1
        ones = np.cumsum(n[order] * high)
        before = ones - n[order] * high
        run = differs(group, v)
        start = at_start(run, before)
        here = np.add.reduceat(n[order] * high, np.flatnonzero(run))[np.cumsum(run) - 1]
        below[order] += np.where(high == 0, start - at_start(differs(group), before), 0)
        same[order] += np.where(high == 0, here, 0)
    return below, same


def _classes(t: np.ndarray, event: np.ndarray) -> np.ndarray:
    """Dense ranks of (duration, censored): a defaulted row is comparable with every row of a higher class."""
    ranks = np.unique(t, return_inverse=True)[1]
    return np.unique(2 * ranks + (event != 1), return_inverse=True)[1]


def concordance_index(
    df: DataFrame, risk: str, duration: str = "duration", event: str = "event", strip_rows: int = STRIP_ROWS
) -> DataFrame:
    """Harrell's C of a risk score, on the durations as they are.

    A pair counts when one client defaults and the other is known to last
    longer; equal durations count only as default against censored. Risks and
    durations are cut into ranges. Pairs that differ in both ranges follow from
    one count per pair of ranges; pairs in one range of the duration are counted
    in that range's task, from its counts by duration and risk range; pairs in
    one range of the risk in that range's task, row by row. A frequent risk is a
    range of its own, whose pairs are ties. Each row moves once per step and is
    never copied; the driver holds at most a million counts. Rows without a
    risk, duration or event are left out.
    """
    let_workers_import(df.sparkSession)
    used = {"risk": F.col(risk).cast("double") + F.lit(0.0), "t": F.col(duration).cast("double") + F.lit(0.0)}
    used["event"] = F.col(event).cast("int")
    known = stage(df.select(*(c.alias(n) for n, c in used.items())).dropna(), "concordance")
    size = known.count()
    per_range = max(strip_rows, -(-size // GRID_RANGES))
    times, risks = find_cuts(known, "t", per_range), find_cuts(known, "risk", per_range)
    timed = times.assign(known, "t").withColumn("strip", F.col("__range").cast("int")).drop("__range")
    hot = F.col("risk").isin(risks.heavy) if risks.heavy else F.lit(False)
    # A frequent risk is its range's lower bound: an even place, before the rest of the range.
    place = 2 * F.col("__range").cast("int") + F.when(hot, 0).otherwise(1)
    placed = risks.assign(timed, "risk").withColumn("place", place).drop("__range")
    places = 2 * (len(risks.bounds) + 1)

    def by_time(key: tuple, table: pa.Table) -> pa.Table:
        t, defaulted, at, n = (table[c].to_numpy() for c in ("t", "event", "place", "n"))
        cls, first = _classes(t, defaulted), defaulted == 1
        below, same = _later_rows(cls, at, n)
        per_class = np.zeros(cls.max() + 2, np.int64)
        np.add.at(per_class, cls, n)
        later = per_class[::-1].cumsum()[::-1][cls + 1]
        lost = np.where(first, n, 0)
        cells = np.zeros((2, places), np.int64)
        np.add.at(cells[0], at, lost)
        np.add.at(cells[1], at, n)
        found = [(lost * below).sum(), (lost * same)[at % 2 == 0].sum(), (lost * later).sum()]
        columns = [[key[0].as_py()], *([int(f)] for f in found), [cells[0].tolist()], [cells[1].tolist()]]
        return pa.table(dict(zip(("strip", "won", "tied", "pairs", "lost", "kept"), columns, strict=True)))

    def by_risk(key: tuple, table: pa.Table) -> pa.Table:
        value, t, defaulted = (table[c].to_numpy() for c in ("risk", "t", "event"))
        below, same = _later_rows(_classes(t, defaulted), value, np.ones(len(t), np.int64))
        first = defaulted == 1
        return pa.table({"won": [int(below[first].sum())], "tied": [int(same[first].sum())]})

    counted = placed.groupBy("strip", "t", "event", "place").agg(F.count(F.lit(1)).alias("n"))
    kind = "strip bigint, won bigint, tied bigint, pairs bigint, lost array<bigint>, kept array<bigint>"
    strips = sorted(counted.groupBy("strip").applyInArrow(by_time, kind).collect())
    won, tied, pairs = (sum(r[c] for r in strips) for c in ("won", "tied", "pairs"))
    if strips:
        lost, kept = (np.array([r[c] for r in strips], np.int64) for c in ("lost", "kept"))
        later = kept[::-1].cumsum(axis=0)[::-1] - kept
        won += int((lost * (later.cumsum(axis=1) - later)).sum())
        tied += int((lost * later)[:, ::2].sum())
        pairs += int((lost.sum(axis=1) * later.sum(axis=1)).sum())
    rest = placed.where("place % 2 = 1").groupBy("place").applyInArrow(by_risk, "won bigint, tied bigint")
    total = lambda c, more: (F.coalesce(F.sum(c), F.lit(0)) + F.lit(more)).cast("double")
    comparable = F.lit(float(pairs) if size else None).cast("double")
    return (
        rest.agg(total("won", won).alias("concordant"), total("tied", tied).alias("tied"))
        .select(*(F.when(comparable.isNotNull(), F.col(c)).alias(c) for c in ("concordant", "tied")), comparable.alias("comparable"))
        .withColumn("c_index", (F.col("concordant") + F.col("tied") / 2) / F.nullif(F.col("comparable"), F.lit(0.0)))
    )


def survival_calibration(df: DataFrame, pd_at, horizons: Sequence[int] = MILESTONES) -> DataFrame:
    """Predicted against observed default per horizon, among loans whose status is known.

    ``pd_at(t)`` gives the predicted PD column; all horizons share one scan.
    """
    aggregates = []
    for t in horizons:
        known = (F.col("duration") > t) | (F.col("event") == 1)
        seen = ((F.col("duration") <= t) & (F.col("event") == 1)).cast("double")
        pd = F.when(known, pd_at(t))
        seen = F.when(known, seen)
        aggregates.append(
            F.struct(
                F.lit(t).alias("horizon_months"),
                F.avg((pd - seen) * (pd - seen)).alias("brier_score"),
                F.avg(pd).alias("mean_predicted_pd"),
                F.avg(seen).alias("observed_default_rate"),
                F.count_if(known).alias("evaluated_loans"),
            ).alias(f"t{t}")
        )
    long = df.agg(*aggregates).select(F.inline(F.array(*(F.col(f"t{t}") for t in horizons))))
    ratio = F.col("mean_predicted_pd") / F.greatest(F.col("observed_default_rate"), F.lit(1e-5))
    return long.withColumn("calibration_ratio", ratio)


def persona_metric() -> Column:
    return F.col("EXT_SOURCE_MEAN") - F.col("PAYMENT_BURDEN_INDEX") - F.col("INST_PCT_LATE")


def borrower_personas(df: DataFrame, keep: Sequence[str] = (), metric: Column | None = None) -> DataFrame:
    """Best, median-nearest and worst borrower by the score metric; smallest key on a tie."""
    value = persona_metric() if metric is None else metric
    scored = df.select("SK_ID_CURR", value.alias("metric"), *keep).where("metric is not null")
    middle = exact_quantiles(scored, {"m": (F.col("metric"), [0.5])})["m"][0]
    row = F.struct("SK_ID_CURR", "metric", *keep)
    pick = lambda order: F.min(F.struct(order.alias("o"), F.col("SK_ID_CURR").alias("k"), row.alias("row")))
    chosen = scored.agg(
        pick(-F.col("metric")).alias("p0"),
        pick(F.abs(F.col("metric") - F.lit(middle))).alias("p1"),
        pick(F.col("metric")).alias("p2"),
    )
    names = ("Prime Borrower Persona", "Near-Prime Borrower Persona", "Subprime Borrower Persona")
    entries = [F.struct(F.lit(n).alias("persona"), F.col(f"p{i}.row").alias("row")) for i, n in enumerate(names)]
    return chosen.select(F.inline(F.array(*entries))).select("persona", "row.*")
