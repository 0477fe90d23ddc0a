"""Benchmark decontamination: test items found in texts within an error budget of edits.

An item with budget k is cut into k + 1 pieces; wherever it occurs with k edits at most, one piece
occurs unchanged. All pieces are looked for at once (Aho-Corasick); the places around hits are
verified with Myers' bit-parallel edit distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lendlens.llm.common import ready

#: Edits allowed for each character of an item.
ERROR_RATE = 0.08
#: Items are searched in blocks of about this many characters; each block reads the texts once.
BLOCK_CHARS = 4_000_000
_OTHER = re.compile(r"[\W_]+")


def normalised(text: str | None) -> str:
    """Lower case, every run of characters other than letters and digits one space, none at the ends."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


def least_distance(pattern: str, text: str) -> tuple[int, int]:
    """Edit distance of the pattern to the nearest substring of the text, and where the first such ends."""
    m = len(pattern)
    full, high = (1 << m) - 1, m - 1
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    up, down, score = full, 0, m
    best, where = m, 0
    for at, c in enumerate(text, 1):
        x = masks.get(c, 0) | down
        diagonal = ((up + (x & up)) ^ up) | x
        minus = up & diagonal
        plus = (down | ~(up | diagonal)) & full
        score += (plus >> high & 1) - (minus >> high & 1)
        x = plus << 1 & full
        down = x & diagonal
        up = ((minus << 1) | ~(x | diagonal)) & full
        if score < best:
            best, where = score, at
    return best, where


@dataclass
class Items:
    ids: list[int]
    texts: list[str]
    budgets: list[int]

    def automaton(self):
        import ahocorasick

        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (text, budget) in enumerate(zip(self.texts, self.budgets, strict=True)):
            cuts = [len(text) * k // (budget + 1) for k in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(text[a:b], []).append((n, a))
        found = ahocorasick.Automaton()
        for piece, places in pieces.items():
            found.add_word(piece, (len(piece), places))
        found.make_automaton()
        return found

    def search(self, automaton, text: str) -> list[tuple[int, int]]:
        """(item, distance) of the items that the normalised text holds within their budgets."""
        places: dict[int, set[int]] = {}
        for end, (size, found) in automaton.iter(text):
            for item, offset in found:
                places.setdefault(item, set()).add(end + 1 - size - offset)
        out = []
        for item, starts in places.items():
            pattern, budget = self.texts[item], self.budgets[item]
            best = budget + 1
            low = high = None
            for start in [*sorted(starts), None]:  # windows that overlap are verified as one
                if low is not None and (start is None or start - budget > high):
                    best = min(best, least_distance(pattern, text[max(0, low) : high])[0])
                    low = None
                if start is not None:
                    low = start - budget if low is None else low
                    high = start + len(pattern) + budget
            if best <= budget:
                out.append((item, best))
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str, rate: float) -> Iterator[Items]:
    """The items with a text, in blocks of bounded size; the driver holds one block at a time."""
    rows = items.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).where(
        "i is not null and t is not null"
    )
    size = rows.agg(F.coalesce(F.sum(F.char_length("t")), F.lit(0)).alias("n")).first().n
    count = max(1, -(-size // BLOCK_CHARS))
    for k in range(count):
        part = rows if count == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == k)
        got = [(r.i, normalised(r.t)) for r in part.distinct().orderBy("i", "t").collect()]
        got = [(i, t) for i, t in got if t]
        if got:
            yield Items([i for i, _ in got], [t for _, t in got], [int(len(t) * rate) for _, t in got])


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = ERROR_RATE,
) -> DataFrame:
    """``doc_id, item_id, distance`` for each text and item that it holds within ``rate`` edits a character.

    Both sides are normalised first. Texts and items that are null or have no letter or digit match
    nothing, nor does an item whose id is null; a null document id is kept as null. Repeated
    documents give repeated rows, an item id with several texts its least distance. An empty table
    on either side gives no rows. Each text is gone through whole, in one piece; nothing is shuffled.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    out = None
    for block in _blocks(items, item_id, item_text, rate):

        def run(batches: Iterator[pd.DataFrame], block: Items = block) -> Iterator[pd.DataFrame]:
            automaton = block.automaton()
            for batch in batches:
                found = []
                for owner, text in zip(batch["i"].astype("Int64"), batch["t"], strict=True):
                    least: dict[int, int] = {}
                    for item, distance in block.search(automaton, normalised(text)):
                        key = block.ids[item]
                        least[key] = min(distance, least.get(key, distance))
                    found += [(owner, key, d) for key, d in least.items()]
                frame = pd.DataFrame(found, columns=["doc_id", "item_id", "distance"])
                yield frame.astype({"doc_id": "Int64", "item_id": np.int64, "distance": np.int64})

        part = rows.mapInPandas(run, "doc_id bigint, item_id bigint, distance bigint")
        out = part if out is None else out.union(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, distance bigint")
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold an item; columns unchanged. Rows with a null id stay."""
    found = leaks(docs, items, id_col, text_col).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(found, id_col, "left_anti").select(*docs.columns)
