"""Best-fit packing by a configuration linear program over the histogram of lengths.

Only the histogram (as many rows as a window has tokens) reaches the driver. There the covering
program "as few windows as possible, every length as often as it occurs" is solved by
multiplicative weights: prices of lengths, a knapsack that finds the windows worth most, prices of
covered lengths going down. Its fractions are rounded down and what they leave is packed by best
fit, length by length with counts. The outcome is a plan of window fillings and how often each is
used. Pieces take their places in it by arithmetic on their rank among pieces of equal length, so
no window is ever gathered in a task and nothing grows with the corpus but the table of pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lendlens.llm.bpe import ByteBPE, opened
from lendlens.llm.common import ready
from lendlens.sources.session import stage

WINDOW = 2048
END_OF_TEXT = 0
#: Rounds of pricing: a length gets this part of its demand a round at most, and there are so many times more of them.
ROUNDS, ROUNDS_MORE = 32, 4
#: How fast a covered length's price falls, and how much less than the best a used filling may be worth.
RATE, SLACK = 0.05, 0.05

PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, part int, place bigint"
SLOTS = "length int, first bigint, last bigint, ways bigint, base bigint, inner int"

Filling = tuple[tuple[int, int], ...]  # (length, how many of it), longest first


def knapsack(lengths: np.ndarray, prices: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per capacity up to ``window``: the greatest worth, and the last length taken for it (-1: none).

    Any length may be taken again; a capacity may stay partly empty. Ties go to the longest.
    """
    worth = np.zeros(window + 1)
    taken = np.full(window + 1, -1, np.int64)
    order = np.argsort(-lengths, kind="stable")
    sizes, values = lengths[order], prices[order]
    shortest = int(sizes[-1])
    for room in range(shortest, window + 1):
        at = int(np.searchsorted(-sizes, -room))  # lengths that fit are from here on
        gains = worth[room - sizes[at:]] + values[at:]
        k = int(np.argmax(gains))
        if gains[k] > worth[room - 1]:
            worth[room], taken[room] = gains[k], order[at + k]
        else:
            worth[room], taken[room] = worth[room - 1], -2  # leave one place empty
    return worth, taken


def _filled(room: int, lengths: np.ndarray, taken: np.ndarray) -> Counter:
    """What the knapsack takes at a capacity: index of length, how often."""
    out: Counter = Counter()
    while room > 0 and taken[room] != -1:
        if taken[room] == -2:
            room -= 1
            continue
        out[int(taken[room])] += 1
        room -= int(lengths[taken[room]])
    return out


def fractions(histogram: Mapping[int, int], window: int, rounds: int = ROUNDS, rate: float = RATE) -> dict[Filling, float]:
    """Multiplicative weights on the covering program: fillings and how often each is used.

    Prices start at each length's share of a window. Each round's knapsack finds the best filling
    around every length; those worth nearly as much as the best of all are used, best first, until
    one of their lengths has got its part of a round (``1 / rounds`` of its demand). Then every length's price falls exponentially in the part of its demand that
    is covered. A covered length is priced no more, and no filling holds a length more often than
    the histogram does, so nothing is covered twice. What the rounds leave is not in the result.
    """
    lengths = np.array(sorted(histogram, reverse=True), np.int64)
    demand = np.array([histogram[int(x)] for x in lengths], float)
    covered = np.zeros(len(lengths))
    used: dict[Filling, float] = {}
    for _ in range(ROUNDS_MORE * rounds):
        live = np.flatnonzero(demand - covered > 1e-6 * demand)
        if not len(live):
            break
        sizes = lengths[live]
        share = covered[live] / demand[live]
        prices = sizes / window * np.exp(-rate * (share - share.min()))
        worth, taken = knapsack(sizes, prices, window)
        around = prices + worth[window - sizes]
        room = np.minimum(demand[live] / rounds, (demand - covered)[live])
        for k in np.argsort(-around, kind="stable").tolist():
            if around[k] < (1 - SLACK) * worth[window]:
                break
            if room[k] <= 0:
                continue
            held = _filled(window - int(sizes[k]), sizes, taken)
            held[k] += 1
            times = min(room[j] / n for j, n in held.items())
            if times <= 0 or any(n > demand[live[j]] for j, n in held.items()):
                continue
            for j, n in held.items():
                room[j] -= times * n
                covered[live[j]] += times * n
            filling = tuple(sorted(((int(sizes[j]), n) for j, n in held.items()), reverse=True))
            used[filling] = used.get(filling, 0.0) + times
    return used


def best_fit(histogram: Mapping[int, int], window: int) -> dict[Filling, int]:
    """Best fit of falling lengths, on counts: windows filled alike are kept as one with a count."""
    bins: dict[int, Counter] = {}  # room -> filling -> count
    rooms: list[int] = []

    def put(room: int, filling: Filling, count: int) -> None:
        if room not in bins:
            bins[room] = Counter()
            insort(rooms, room)
        bins[room][filling] += count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                filling, count = bins[room].popitem()
                if not bins[room]:
                    del bins[room], rooms[at]
            else:
                room, filling, count = window, (), left  # as many new windows as could be needed
            each = min(room // length, left)
            full = min(count, left // each)
            put(room - each * length, (*filling, (length, each)), full)
            left -= full * each
            if filling and count > full:
                put(room, filling, count - full)
    return {filling: count for held in bins.values() for filling, count in held.items()}


def plan(histogram: Mapping[int, int], window: int = WINDOW) -> dict[Filling, int]:
    """Whole fillings that hold every length exactly as often as the histogram.

    The program's fractions, fullest fillings first, are rounded down and to what is still there;
    the rest is packed by best fit.
    """
    left = {k: n for k, n in histogram.items() if n > 0}
    if not left:
        return {}
    out: Counter = Counter()
    used = fractions(left, window)
    for filling in sorted(used, key=lambda f: (-sum(a * b for a, b in f), f)):
        times = min(int(used[filling] + 1e-6), *(left[length] // n for length, n in filling))
        if times:
            out[filling] += times
            for length, n in filling:
                left[length] -= n * times
    out.update(best_fit({k: n for k, n in left.items() if n}, window))
    return dict(out)


def slots(fillings: Mapping[Filling, int]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan as places: of a length, ranks ``first`` to ``last`` go round ``ways`` windows from number
    ``base`` on, the n-th round to place ``inner`` + n * length of them."""
    out, base, given = [], 0, Counter()
    for filling, ways in sorted(fillings.items(), reverse=True):
        inner = 0
        for length, n in filling:
            out.append((length, given[length], given[length] + n * ways - 1, ways, base, inner))
            given[length] += n * ways
            inner += n * length
        base += ways
    return out


def pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, window: int, end: int) -> DataFrame:
    """Pieces of all documents, with the task that cut them and their place there among those of their length."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = opened(ByteBPE, tokenizer)
        part, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        last = np.array([end], "<u4")
        for batch in batches:
            rows = []
            for doc, text in zip(batch["i"], batch["t"], strict=True):
                ids = np.concatenate([encoder.ids(text or ""), last]).astype("<u4", copy=False)
                cuts = [0, *range(len(ids) % window or window, len(ids) + 1, window)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    crc = zlib.crc32(ids[a:b].tobytes())
                    rows.append((None if pd.isna(doc) else int(doc), k, a, b - a, crc, part, int(seen[b - a])))
                    seen[b - a] += 1
            frame = pd.DataFrame(rows, columns=[x.split()[0] for x in PIECES.split(", ")])
            yield frame.astype({"doc_id": "Int64"})

    return docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).mapInPandas(run, PIECES)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end: int = END_OF_TEXT,
) -> DataFrame:
    """One row per piece: document, number and start of the piece, length, checksum, sequence and place in it.

    ``tokenizer`` is the path of a byte-level BPE file on every executor. A document's tokens are
    its ids and then ``end``. Only a document of more than ``window`` tokens is cut: all its pieces
    but the first have ``window`` tokens. A null text is an empty one: its only token is ``end``.
    Null ids and repeated rows are packed row by row. No rows give no rows. Other columns are
    ignored. Sequence numbers run from 0 without gaps.

    Broadcast are the plan's places alone: at most the fillings found (bounded by rounds times
    distinct lengths) times the lengths in one, whatever the number of documents.
    """
    spark = docs.sparkSession
    cut = stage(pieces(docs, tokenizer, id_col, text_col, window, end), "pieces")
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # one row per task and length
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = F.broadcast(spark.createDataFrame(slots(plan(histogram, window)), SLOTS))
    ranked = cut.join(offsets, ["length", "part"]).withColumn("rank", F.col("place") + F.col("earlier"))
    slot, at = places.withColumnRenamed("length", "of_length"), F.col("rank") - F.col("first")
    here = (F.col("length") == F.col("of_length")) & F.col("rank").between(F.col("first"), F.col("last"))
    turn = F.floor(at / F.col("ways"))
    return ranked.join(slot, here).select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("bigint").alias("length"),
        "ids_crc32",
        (F.col("base") + at % F.col("ways")).alias("sequence_id"),
        (F.col("inner") + turn * F.col("length")).cast("bigint").alias("offset"),
    )
