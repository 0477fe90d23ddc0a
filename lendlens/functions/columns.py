"""Null-aware column expressions with the semantics the operators rely on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

DAYS_PER_YEAR = 365.25
RATIO_EPSILON = 1e-5


def floor_at(value: Column, low: float | Column) -> Column:
    """Clip from below; nulls stay null (``greatest`` would replace them)."""
    bound = low if isinstance(low, Column) else F.lit(low)
    return F.when(value < bound, bound).otherwise(value)


def cap_at(value: Column, high: float | Column) -> Column:
    bound = high if isinstance(high, Column) else F.lit(high)
    return F.when(value > bound, bound).otherwise(value)


def clip(value: Column, low: float | Column, high: float | Column) -> Column:
    return cap_at(floor_at(value, low), high)


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def padded_ratio(top: Column, bottom: Column, epsilon: float = RATIO_EPSILON) -> Column:
    """``top / (bottom + epsilon)``, null when the padded bottom is zero."""
    return top / F.nullif(bottom + F.lit(epsilon), F.lit(0.0))


def guarded_ratio(top: Column, bottom: Column, empty: float = 0.0) -> Column:
    """``top / bottom``; ``empty`` when the bottom is not positive or unknown."""
    return F.when(bottom > 0, top.cast("double") / bottom).otherwise(F.lit(empty))


def row_count(columns: Sequence[Column]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + c.isNotNull().cast("int")
    return total


def row_sum(columns: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0.0))
    return total


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean of the non-null values of a row; null when there is none."""
    return row_sum(columns) / F.nullif(row_count(columns), F.lit(0))


def row_std(columns: Sequence[Column]) -> Column:
    """Sample standard deviation of a row's non-null values; null below two."""
    mean = row_mean(columns)
    squares = row_sum([(c - mean) * (c - mean) for c in columns])
    n = row_count(columns)
    return F.sqrt(squares / F.when(n > 1, n - 1))


def age_years(days_birth: str = "DAYS_BIRTH") -> Column:
    return -F.col(days_birth) / F.lit(DAYS_PER_YEAR)


def band(value: Column, edges: Sequence[float], closed: str = "left") -> Column:
    """0-based bin number for ``edges``; null outside them.

    ``closed='left'`` bins are [a, b), ``closed='right'`` bins are (a, b].
    """
    number = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        low, high = F.lit(float(edges[i])), F.lit(float(edges[i + 1]))
        if closed == "left":
            inside = (value >= low) & (value < high)
        else:
            inside = (value > low) & (value <= high)
        number = F.when(inside, F.lit(i)).otherwise(number)
    return number


def label(number: Column, labels: Sequence[str]) -> Column:
    """Text of a 0-based bin number; null stays null."""
    return F.get(F.array(*(F.lit(t) for t in labels)), number)


def to_places(value: Column, digits: int) -> Column:
    """Round to ``digits`` places with double arithmetic only (no decimal conversion)."""
    scale = F.lit(10.0**digits)
    return F.rint(value * scale) / scale + F.lit(0.0)


def steady_round(value: Column, digits: int) -> Column:
    """Round after a nudge of about 1% of the last kept digit.

    Decimal amounts often sit exactly on a rounding boundary, where the order
    of a floating-point sum decides the result; the nudge takes them off it.
    """
    return to_places(value.cast("double") + F.lit(10.0**-digits / 70), digits)


def hash_order(key: str | Column = "SK_ID_CURR") -> Column:
    """Multiplicative hash of a non-negative integer key, in [0, 2**32).

    Keys are folded to 31 bits first so that the product stays inside a long;
    larger keys may therefore share a hash.
    """
    c = F.col(key) if isinstance(key, str) else key
    return ((c.cast("bigint") % F.lit(2147483648)) * F.lit(2654435761)) % F.lit(4294967296)
