"""Exact quantiles and order statistics by counting slices of an order-preserving integer key.

Spark's ``percentile`` keeps every distinct value of a column in one task. Here every value becomes
an unsigned 64-bit number in the same order, and its bits are fixed from the top in four passes: a
pass counts, for all columns and ranks at once, the values that share the bits found so far by their
next sixteen. Each task adds up its own counts before the shuffle, so nothing but counts moves,
every column takes the same path at every size, and results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType

from lendlens.sources.session import let_workers_import

SLICE = 16
PASSES = 64 // SLICE
SLOTS = 1 << SLICE
_TOP = np.uint64(1 << 63)

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def _plain(value: Column, kind: DataType) -> tuple[Column, bool]:
    """The column as bigint or double, and whether it is whole."""
    if isinstance(kind, _WHOLE):
        return value.cast("bigint"), True
    if isinstance(kind, (DoubleType, FloatType, DecimalType)):
        return value.cast("double"), False
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("bigint"), True
    raise TypeError(f"no order-preserving key for {kind.simpleString()}")


def to_keys(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of 64-bit integers or doubles; -0.0 is 0.0, NaN is the largest."""
    if values.dtype.kind == "i":
        return values.astype(np.int64).view(np.uint64) ^ _TOP
    plain = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = plain.view(np.uint64)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def from_key(key: int, whole: bool) -> int | float:
    bits = np.array([key], np.uint64)
    if whole:
        return int((bits ^ _TOP).view(np.int64)[0])
    return float(np.where(bits & _TOP, bits ^ _TOP, ~bits).view(np.float64)[0])


@dataclass
class _Search:
    """The bits found so far of the value at a rank; ``rank`` counts within the values that share them."""

    column: int
    rank: int
    bits: int = 0


def _count_slices(df: DataFrame, searched: Sequence[tuple[int, int]], done: int) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Per (column, bits found so far): the next slices that occur, in order, and how often.

    At most SLOTS numbers per entry reach the driver.
    """
    wanted = list(searched)
    shift = np.uint64(64 - SLICE * (done + 1))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(wanted), SLOTS), np.int64)
        for batch in batches:
            keys = {}
            for number, (column, bits) in enumerate(wanted):
                if column not in keys:
                    keys[column] = to_keys(batch.column(column).drop_null().to_numpy(zero_copy_only=False))
                mine = keys[column] >> shift
                if done:
                    mine = mine[mine >> np.uint64(SLICE) == np.uint64(bits)]
                counts[number] += np.bincount((mine & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        number, slot = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"number": number, "slot": slot, "n": counts[number, slot]})

    counted = df.mapInArrow(fold, "number bigint, slot bigint, n bigint").groupBy("number", "slot").agg(F.sum("n").alias("n"))
    found = counted.toArrow().sort_by([("number", "ascending"), ("slot", "ascending")])
    number, slot, n = (found[c].to_numpy() for c in ("number", "slot", "n"))
    return {key: (slot[number == i], n[number == i]) for i, key in enumerate(wanted)}


def select_ranks(
    df: DataFrame, wanted: Mapping[str, tuple[Column, Callable[[int], Sequence[int]]]]
) -> dict[str, tuple[int, list]]:
    """Values at 0-based ranks of each column's sorted non-null values.

    ``wanted`` maps a name to a column (whole numbers, dates, or anything that is a double) and to a
    function from the non-null count to the ranks. Returns (count, values) per name; ranks outside
    the data give None, dates come back as days.
    """
    if not wanted:
        return {}
    let_workers_import(df.sparkSession)
    names = list(wanted)
    columns = df.select(*(wanted[c][0].alias(f"c{i}") for i, c in enumerate(names)))
    plain = [_plain(F.col(f"c{i}"), f.dataType) for i, f in enumerate(columns.schema)]
    keyed = columns.select(*(c.alias(f"c{i}") for i, (c, _) in enumerate(plain)))

    first = _count_slices(keyed, [(i, 0) for i in range(len(names))], 0)
    totals = [int(first[i, 0][1].sum()) for i in range(len(names))]
    slots: list[list[_Search | None]] = []
    for i, name in enumerate(names):
        ranks = wanted[name][1](totals[i])
        slots.append([_Search(i, int(r)) if 0 <= r < totals[i] else None for r in ranks])
    searches = [s for group in slots for s in group if s is not None]
    counted = first
    for done in range(PASSES):
        if done:
            counted = _count_slices(keyed, sorted({(s.column, s.bits) for s in searches}), done) if searches else {}
        for s in searches:
            slot, n = counted[s.column, s.bits]
            ends = n.cumsum()
            at = int(np.searchsorted(ends, s.rank, side="right"))
            s.rank -= int(ends[at] - n[at])
            s.bits = s.bits << SLICE | int(slot[at])
    return {
        name: (totals[i], [None if s is None else from_key(s.bits, plain[i][1]) for s in slots[i]])
        for i, name in enumerate(names)
    }


def exact_quantiles(df: DataFrame, wanted: Mapping[str, tuple[Column, Sequence[float]]]) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles; None for a column without values."""

    def ranks_for(points: Sequence[float]) -> Callable[[int], list[int]]:
        return lambda n: [r for p in points for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]

    selected = select_ranks(df, {name: (value, ranks_for(points)) for name, (value, points) in wanted.items()})
    result: dict[str, list[float | None]] = {}
    for name, (_, points) in wanted.items():
        n, values = selected[name]
        result[name] = []
        for i, p in enumerate(points):
            low, high = values[2 * i], values[2 * i + 1]
            if low is None:
                result[name].append(None)
                continue
            part = p * (n - 1) - math.floor(p * (n - 1))
            result[name].append(float(low) + (float(high) - float(low)) * part)
    return result


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Median per column, skipping nulls."""
    found = exact_quantiles(df, {c: (F.col(c).cast("double"), [0.5]) for c in columns})
    return {c: v[0] for c, v in found.items()}
