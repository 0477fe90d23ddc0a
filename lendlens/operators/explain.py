"""Attributions, adverse-action notices, counterfactuals and what-if runs.

Everything is computed inside the row with array expressions: a client's few
features never leave it, so nothing is exploded, shuffled or ranked globally.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lendlens.operators.clean import SCORE_COLUMNS
from lendlens.operators.encode import readable_name
from lendlens.functions.columns import RATIO_EPSILON, padded_ratio
from lendlens.operators.learn import Folded
from lendlens.operators.scoring import CENTRE, SLOPE, logit_to_pd
from lendlens.sources.session import let_workers_import
from lendlens.sources.tables import nan_to_null

# Allowed score moves of the counterfactual grid.
MOVES = (0.0, 0.05, 0.1, 0.2, 0.3)
MAX_GRID = 1000
# Distances are compared in whole units of 1e-9.
DISTANCE_UNITS = 1e9
APPROVAL_PD = 0.5
SIMULATOR_EPSILON = 1e-6


def proxy_weights() -> dict[str, float]:
    """Weights of the closed-form logit on the three scores."""
    return {c: SLOPE / len(SCORE_COLUMNS) for c in SCORE_COLUMNS}


def feature_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = df.agg(*(F.avg(c).alias(c) for c in features)).first()
    return {c: row[c] or 0.0 for c in features}


def with_contributions(
    df: DataFrame, weights: Mapping[str, float], means: Mapping[str, float], intercept: float
) -> DataFrame:
    """Adds ``contributions`` (array per feature), ``base`` and ``score``.

    A linear score's exact Shapley value of feature j is w_j * (x_j - mean_j);
    the base is the score at the means.
    """
    parts = [
        F.struct(
            (F.lit(w) * (F.col(c) - F.lit(means[c]))).alias("contribution"),
            F.lit(i).alias("position"),
            F.lit(c).alias("feature"),
            F.col(c).cast("double").alias("value"),
        )
        for i, (c, w) in enumerate(weights.items())
    ]
    base = intercept + sum(w * means[c] for c, w in weights.items())
    score = F.lit(base)
    for part in parts:
        score = score + part["contribution"]
    return df.withColumns({"contributions": F.array(*parts), "base": F.lit(base), "score": score})


def proxy_contributions(scored: DataFrame, means: Mapping[str, float] | None = None) -> DataFrame:
    """Contributions to the closed-form logit of a scored table."""
    means = means or feature_means(scored, SCORE_COLUMNS)
    return with_contributions(scored, proxy_weights(), means, -SLOPE * CENTRE)


def fitted_contributions(df: DataFrame, folded: Folded) -> DataFrame:
    """Exact contributions to the log odds of a fitted regression, categories included.

    A number adds weight * (value - mean), a category its level's weight less the mean weight. Gaps
    of numbers count as the mean.
    """
    weights = {c: folded.level_weight(c) for c in folded.levels}
    row = df.agg(*(F.avg(c).alias(c) for c in folded.numbers), *(F.avg(w).alias(c) for c, w in weights.items())).first()
    means = {c: row[c] or 0.0 for c in (*folded.numbers, *weights)}
    base = folded.intercept + sum(w * means[c] for c, w in folded.numbers.items()) + sum(means[c] for c in weights)
    parts = []
    for i, c in enumerate((*folded.numbers, *weights)):
        number = c in folded.numbers
        value = F.col(c).cast("double") if number else F.lit(None).cast("double")
        size = F.lit(folded.numbers[c]) * (F.coalesce(value, F.lit(means[c])) - F.lit(means[c])) if number else weights[c] - F.lit(means[c])
        level = F.lit(None).cast("string") if number else F.col(c)
        named = {"contribution": size, "position": F.lit(i), "feature": F.lit(c), "value": value, "level": level}
        parts.append(F.struct(*(x.alias(n) for n, x in named.items())))
    found = df.withColumns({"contributions": F.array(*parts), "base": F.lit(base)})
    return found.withColumn("score", F.aggregate("contributions", F.col("base"), lambda a, p: a + p["contribution"]))


def attributions(explained: DataFrame) -> DataFrame:
    """Long form: one row per client and feature."""
    long = explained.select("SK_ID_CURR", F.inline("contributions"))
    return long.select("SK_ID_CURR", "feature", "value", "contribution")


def global_attribution(explained: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature."""
    sized = explained.agg(
        *(F.avg(F.abs(F.col("contributions")[i]["contribution"])).alias(f) for i, f in enumerate(features))
    )
    entries = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("mean_abs_contribution")) for f in features]
    return sized.select(F.inline(F.array(*entries)))


def adverse_actions(explained: DataFrame, features: Sequence[str], top_n: int = 4) -> DataFrame:
    """Per client the score and up to ``top_n`` strictly risk-raising reasons, largest first.

    Contributions that carry a ``level`` (categories of a fitted model) show it beside the value.
    """
    levelled = "level" in explained.schema["contributions"].dataType.elementType.fieldNames()
    names = F.create_map(*(F.lit(t) for f in features for t in (f, readable_name(f))))
    raising = F.filter("contributions", lambda p: p["contribution"] > 0)
    # Ascending by negated size, then by feature position.
    keyed = F.transform(
        raising,
        lambda p: F.struct((-p["contribution"]).alias("key"), p["position"].alias("position"), p.alias("part")),
    )
    reasons = F.transform(
        F.slice(F.array_sort(keyed), 1, top_n),
        lambda k: F.struct(
            F.try_element_at(names, k["part"]["feature"]).alias("Feature"),
            k["part"]["feature"].alias("RawFeatureName"),
            F.round(k["part"]["contribution"], 4).alias("Contribution"),
            F.round(k["part"]["value"], 4).alias("FeatureValue"),
            *([k["part"]["level"].alias("FeatureLevel")] if levelled else []),
        ),
    )
    kept = [c for c in ("SK_ID_CURR", "TARGET") if c in explained.columns]
    return explained.select(*kept, F.round("score", 4).alias("Risk_Score_LogOdds"), reasons.alias("Reasons"))


def top_risk_notices(notices: DataFrame, n: int = 3) -> DataFrame:
    return notices.orderBy(F.desc("Risk_Score_LogOdds"), "SK_ID_CURR").limit(n)


def client_profile(losses: DataFrame, notices: DataFrame) -> DataFrame:
    """Client view: loss row joined with the client's reasons."""
    return losses.join(notices.select("SK_ID_CURR", "Risk_Score_LogOdds", "Reasons"), "SK_ID_CURR")


def counterfactual_grid(
    scored: DataFrame, threshold: float = APPROVAL_PD, risky_above: float = 0.6, moves: Sequence[float] = MOVES
) -> DataFrame:
    """Smallest change of the external scores that brings PD under ``threshold``.

    Each risky client compares a fixed grid of moves inside its own row: the
    moved scores are computed once per score, a grid entry is their sum, and
    ``least`` keeps the nearest entry below the threshold (ties to the earlier
    one). Clients the grid cannot help get nulls.
    """
    grid = list(product(range(len(moves)), repeat=len(SCORE_COLUMNS)))
    if len(grid) > MAX_GRID:
        raise ValueError(f"grid of {len(grid)} entries exceeds {MAX_GRID}")
    risky = scored.where(F.col("PD") > risky_above)
    moved, shift = {}, {}
    for i, c in enumerate(SCORE_COLUMNS):
        for j, m in enumerate(moves):
            moved[f"n{i}_{j}"] = F.least(F.col(c) + F.lit(m), F.lit(1.0))
            shift[f"d{i}_{j}"] = F.rint((F.col(f"n{i}_{j}") - F.col(c)) * F.lit(DISTANCE_UNITS)).cast("bigint")
    tried = risky.withColumns(moved).withColumns(shift)
    # PD is below the threshold when the logit is below the threshold's logit.
    cut = math.log(threshold / (1.0 - threshold))
    entries = []
    for number, steps in enumerate(grid):
        total = " + ".join(f"n{i}_{j}" for i, j in enumerate(steps))
        far = " + ".join(f"d{i}_{j}" for i, j in enumerate(steps))
        reached = f"{SLOPE}D * (({total}) / {len(SCORE_COLUMNS)} - {CENTRE}D) < {cut!r}D"
        # One number orders entries by distance, then by position in the grid.
        entries.append(f"if({reached}, ({far}) * {MAX_GRID} + {number}, null)")
    best = tried.withColumn("best", F.expr(f"least({', '.join(entries)})"))
    best = best.withColumn("grid_id", (F.col("best") % MAX_GRID).cast("int"))

    new = {}
    for i, c in enumerate(SCORE_COLUMNS):
        step = F.floor(F.col("grid_id") / len(moves) ** (len(SCORE_COLUMNS) - 1 - i)) % len(moves)
        options = F.array(*(F.col(f"n{i}_{j}") for j in range(len(moves))))
        new[f"to_{c}"] = F.get(options, step.cast("int"))
    chosen = best.withColumns(new)
    mean = sum((F.col(f"to_{c}") for c in SCORE_COLUMNS[1:]), F.col(f"to_{SCORE_COLUMNS[0]}")) / len(SCORE_COLUMNS)
    return chosen.select(
        "SK_ID_CURR",
        F.col("PD").alias("original_pd"),
        "grid_id",
        (F.floor(F.col("best") / MAX_GRID) / F.lit(DISTANCE_UNITS)).alias("distance"),
        logit_to_pd(F.lit(SLOPE) * (mean - F.lit(CENTRE))).alias("new_pd"),
        *(F.when(F.col(f"to_{c}") != F.col(c), F.col(f"to_{c}")).alias(f"new_{c}") for c in SCORE_COLUMNS),
    )


# What a client or underwriter can change, and by how much.
ACTIONABLE = (
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "NAME_CONTRACT_TYPE",
    "DEBT_TO_INCOME_RATIO",
    "CREDIT_TERM_MONTHS",
    "PAYMENT_BURDEN_INDEX",
    *SCORE_COLUMNS,
)
CREDIT_FACTORS, ANNUITY_FACTORS = (1.0, 0.95, 0.9, 0.8, 0.7), (1.0, 0.95, 0.9, 0.8, 0.7)
CONTRACT_COST = 0.25


class _Recourse:
    """Search for the cheapest mixed move of each row of a batch."""

    def __init__(self, folded: Folded, cut: float, contracts: Sequence[str], moves: Sequence[float]):
        self.folded, self.cut, self.contracts, self.moves = folded, cut, list(contracts), moves
        offers = list(product(range(len(CREDIT_FACTORS)), range(len(ANNUITY_FACTORS)), range(len(self.contracts) + 1)))
        price = lambda o: (1 - CREDIT_FACTORS[o[0]]) + (1 - ANNUITY_FACTORS[o[1]])
        self.offers = sorted(((round(price(o) * DISTANCE_UNITS), o) for o in offers), key=lambda x: (x[0], x[1]))
        self.steps = np.array(list(product(range(len(moves)), repeat=len(SCORE_COLUMNS))))

    def offer_log_odds(self, rows: Mapping[str, np.ndarray], credit: np.ndarray, annuity: np.ndarray, contract: np.ndarray) -> np.ndarray:
        """Everything but the scores, with the ratios that follow from the offer worked out anew."""
        folded = self.folded
        changed = {
            "AMT_CREDIT": credit,
            "AMT_ANNUITY": annuity,
            "DEBT_TO_INCOME_RATIO": annuity / (rows["AMT_INCOME_TOTAL"] + RATIO_EPSILON),
            "PAYMENT_BURDEN_INDEX": annuity / (credit + RATIO_EPSILON),
            "CREDIT_TERM_MONTHS": np.clip(credit / np.maximum(annuity, 1.0), 6.0, 60.0),
        }
        total = np.full(len(credit), folded.intercept)
        for c, w in folded.numbers.items():
            if c not in SCORE_COLUMNS:
                total = total + w * changed.get(c, rows.get(c))
        for c, known in folded.levels.items():
            seen = contract if c == "NAME_CONTRACT_TYPE" else rows[c]
            total = total + np.array([known.get(x, folded.unseen[c]) for x in seen])
        return total

    def search(self, rows: Mapping[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Least distance (or -1), offer, score steps and log odds per row; ties go to the earlier offer and step.

        Offers are tried from the cheapest on. A row leaves an offer unvisited when the offer alone costs
        as much as the best move found, or when even the largest score moves, whose effect is monotone,
        don't bring it under the threshold.
        """
        n = len(rows["AMT_CREDIT"])
        weights = [self.folded.numbers.get(c, 0.0) for c in SCORE_COLUMNS]
        moved = [np.minimum(rows[c][:, None] + np.array(self.moves)[None, :], 1.0) for c in SCORE_COLUMNS]
        gain = [w * m for w, m in zip(weights, moved)]
        far = [np.rint((m - rows[c][:, None]) * DISTANCE_UNITS).astype(np.int64) for m, c in zip(moved, SCORE_COLUMNS)]
        least = sum(g.min(axis=1) for g in gain)
        best = np.full(n, np.iinfo(np.int64).max)
        offer, step, odds = np.full(n, -1), np.full(n, -1), np.zeros(n)
        for number, (price, (i, j, k)) in enumerate(self.offers):
            own = rows["NAME_CONTRACT_TYPE"]
            contract = own if k == 0 else np.full(n, self.contracts[k - 1], object)
            cost = price + (round(CONTRACT_COST * DISTANCE_UNITS) if k else 0)
            open_rows = (cost < best) & ((k == 0) | (contract != own))
            if not open_rows.any():
                continue
            at = np.flatnonzero(open_rows)
            part = {c: v[at] for c, v in rows.items()}
            base = self.offer_log_odds(part, part["AMT_CREDIT"] * CREDIT_FACTORS[i], part["AMT_ANNUITY"] * ANNUITY_FACTORS[j], contract[at])
            reach = base + least[at] < self.cut
            at, base = at[reach], base[reach]
            if not len(at):
                continue
            total = base[:, None] + sum(g[at][:, self.steps[:, d]] for d, g in enumerate(gain))
            distance = cost + sum(f[at][:, self.steps[:, d]] for d, f in enumerate(far))
            distance = np.where(total < self.cut, distance, np.iinfo(np.int64).max)
            chosen = distance.argmin(axis=1)
            line = np.arange(len(at))
            better = distance[line, chosen] < best[at]
            hit = at[better]
            best[hit], offer[hit], step[hit] = distance[line, chosen][better], number, chosen[better]
            odds[hit] = total[line, chosen][better]
        return np.where(offer >= 0, best, -1), offer, step, odds


def actionable_counterfactuals(
    df: DataFrame,
    folded: Folded,
    contracts: Sequence[str],
    threshold: float = APPROVAL_PD,
    risky_above: float = 0.6,
    moves: Sequence[float] = MOVES,
) -> DataFrame:
    """Cheapest mix of a smaller credit, a smaller annuity, another contract and better scores that brings
    a risky client's PD under ``threshold``, for a fitted regression on ``ACTIONABLE`` and fixed columns.

    The ratios and the term follow from the offer. Distance adds up the cut shares of credit and annuity,
    ``CONTRACT_COST`` for another contract and the score moves. A client whom no mix helps gets nulls.
    The search is exact; it runs inside the row's batch, so nothing is exploded or shuffled.
    """
    let_workers_import(df.sparkSession)
    columns = [*dict.fromkeys(["AMT_CREDIT", "AMT_ANNUITY", "AMT_INCOME_TOTAL", "NAME_CONTRACT_TYPE", *folded.numbers, *folded.levels, *SCORE_COLUMNS])]
    texts = {"NAME_CONTRACT_TYPE", *folded.levels}
    recourse = _Recourse(folded, math.log(threshold / (1.0 - threshold)), contracts, moves)
    kinds = "SK_ID_CURR bigint, original_pd double, new_pd double, distance double, new_AMT_CREDIT double, new_AMT_ANNUITY double, new_NAME_CONTRACT_TYPE string"
    kinds += "".join(f", new_{c} double" for c in SCORE_COLUMNS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = {c: batch[c].to_numpy(object if c in texts else float) for c in columns}
            best, offer, step, odds = recourse.search(rows)
            found = best >= 0
            picked = np.array([recourse.offers[o][1] for o in np.where(found, offer, 0)]).reshape(-1, 3)
            cut = lambda name, factors, axis: np.where(found & (picked[:, axis] > 0), rows[name] * np.array(factors)[picked[:, axis]], np.nan)
            names = [None, *recourse.contracts]
            out = {
                "SK_ID_CURR": batch["SK_ID_CURR"],
                "original_pd": batch["__pd"],
                "new_pd": np.where(found, 1 / (1 + np.exp(-odds)), np.nan),
                "distance": np.where(found, best / DISTANCE_UNITS, np.nan),
                "new_AMT_CREDIT": cut("AMT_CREDIT", CREDIT_FACTORS, 0),
                "new_AMT_ANNUITY": cut("AMT_ANNUITY", ANNUITY_FACTORS, 1),
                "new_NAME_CONTRACT_TYPE": [names[k] if f else None for k, f in zip(picked[:, 2], found)],
            }
            taken = recourse.steps[np.where(found, step, 0)]
            for d, c in enumerate(SCORE_COLUMNS):
                new = np.minimum(rows[c] + np.array(moves)[taken[:, d]], 1.0)
                out[f"new_{c}"] = np.where(found & (new != rows[c]), new, np.nan)
            yield pd.DataFrame(out)

    known = df.dropna(subset=[c for c in columns if c not in texts]).withColumn("__pd", F.lit(1.0) / (F.lit(1.0) + F.exp(-folded.log_odds())))
    listed = known.where(F.col("__pd") > risky_above).select("SK_ID_CURR", "__pd", *(F.col(c) if c in texts else F.col(c).cast("double").alias(c) for c in columns))
    return nan_to_null(listed.mapInPandas(run, kinds))


def restructure_pd(logit: Column, dti: Column, weight: float = 1.0) -> Column:
    """PD of the closed-form logit plus a burden term, ``weight * min(DTI, 1)``."""
    return logit_to_pd(logit + F.lit(weight) * F.least(dti, F.lit(1.0)))


def what_if_restructure(scored: DataFrame, scenarios: Mapping[str, tuple[float, float]], weight: float = 1.0) -> DataFrame:
    """PD before and after scaling annuity and credit, per client and scenario.

    ``scenarios`` maps a name to (annuity factor, credit factor).
    """
    income, annuity = F.col("AMT_INCOME_TOTAL"), F.col("AMT_ANNUITY")
    options = F.array(
        *(
            F.struct(F.lit(n).alias("scenario"), F.lit(float(a)).alias("annuity_factor"), F.lit(float(c)).alias("credit_factor"))
            for n, (a, c) in scenarios.items()
        )
    )
    listed = scored.select("*", F.inline(options))
    old_dti = padded_ratio(annuity, income, SIMULATOR_EPSILON)
    new_annuity = annuity * F.col("annuity_factor")
    new_dti = padded_ratio(new_annuity, income, SIMULATOR_EPSILON)
    priced = listed.select(
        "SK_ID_CURR",
        "scenario",
        new_annuity.alias("new_annuity"),
        (F.col("AMT_CREDIT") * F.col("credit_factor")).alias("new_credit"),
        new_dti.alias("new_dti"),
        restructure_pd(F.col("LOGIT"), old_dti, weight).alias("original_pd"),
        restructure_pd(F.col("LOGIT"), new_dti, weight).alias("new_pd"),
    )
    old, new = F.col("original_pd"), F.col("new_pd")
    verdict = (
        F.when((new < APPROVAL_PD) & (old >= APPROVAL_PD), "moved to approve")
        .when(new >= APPROVAL_PD, "still rejected")
        .otherwise("no change")
    )
    return priced.withColumns({"pd_change": new - old, "verdict": verdict})
