"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Every task tokenizes its own documents, cuts off whole windows and balances what is left in blocks
of bounded size, so nothing is shuffled and a lost task is simply run again.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lendlens.llm.bpe import WordBPE, opened
from lendlens.llm.common import ready

WINDOW = 2048
#: A remainder is cut into pieces of this many tokens at most before it is balanced.
PIECE = 2048
#: Pieces balanced together; bounds a task's memory and the cost of the differencing.
BLOCK = 2048
END_OF_TEXT = 1

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: indices of ``sizes`` in at most ``ways`` lists of near-equal sums.

    A partial partition holds the sums of its non-empty subsets, largest first; once it has
    ``ways`` of them, relative to its smallest. The two partitions with the greatest spread merge,
    the largest subsets of one with the smallest of the other. Ties go to the older partition.
    """
    if not sizes:
        return []
    n = len(sizes)
    pairs: list[tuple[np.ndarray, np.ndarray, int]] = []  # joined subsets and the first node made of them
    nodes = n
    heap = [(-size, i, np.array([size], np.int64), np.array([i], np.int64)) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        over = max(0, len(a) + len(b) - ways)  # so many subsets of each meet
        la, lb = len(a) - over, len(b) - over
        sums = np.concatenate([a[:la], a[la:] + b[lb:][::-1], b[:lb]])
        joined = np.arange(nodes, nodes + over)
        if over:
            pairs.append((left[la:], right[lb:][::-1], nodes))
            nodes += over
        held = np.concatenate([left[:la], joined, right[:lb]])
        order = np.argsort(-sums, kind="stable")
        sums, held = sums[order], held[order]
        least = sums[-1] if len(sums) == ways else 0
        heapq.heappush(heap, (-int(sums[0] - least), made, sums - least, held))
        made += 1
    home = np.full(nodes, -1, np.int64)
    home[heap[0][3]] = np.arange(len(heap[0][3]))
    for a, b, first in reversed(pairs):
        home[a] = home[b] = home[first : first + len(a)]
    out: list[list[int]] = [[] for _ in heap[0][3]]
    for i, k in enumerate(home[:n].tolist()):
        out[k].append(i)
    return out


def windows_of(sizes: list[int], window: int) -> list[list[int]]:
    """Near-equal windows; their count rises, by what the fullest has too much, while any is over ``window``."""
    total = sum(sizes)
    ways = max(1, -(-total // window))
    while True:
        parts = differencing(sizes, ways)
        over = max(sum(sizes[i] for i in p) for p in parts) - window
        if over <= 0:
            return parts
        mean = total / ways
        ways = max(ways + 1, int(np.ceil(total / max(window - over - (window - mean), window / 2))))


class _Packer:
    """Cuts, balances and places pieces ``(document, start, ids, document's tokens)``."""

    def __init__(self, window: int, piece: int, block: int, partition: int):
        self.window, self.piece, self.block = window, piece, block
        self.next_sequence = partition << 40
        self.waiting: list[tuple] = []
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            length = len(ids) // 4
            self.rows.append((doc, start, length, zlib.crc32(ids), total, self.next_sequence, offset))
            offset += length
        self.next_sequence += 1

    def add(self, doc, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while total - at >= self.window:
            self._emit([(doc, at, ids[4 * at : 4 * (at + self.window)], total)])
            at += self.window
        rest = total - at
        parts = -(-rest // self.piece)
        cuts = [at + rest * k // parts for k in range(parts)] + [total]
        self.waiting += [(doc, a, ids[4 * a : 4 * b], total) for a, b in zip(cuts, cuts[1:], strict=False)]
        if len(self.waiting) >= self.block:
            self.flush()

    def flush(self) -> None:
        """Balance what waits; then cut up the windows that the free room of the others can hold."""
        held, self.waiting = self.waiting, []
        if not held:
            return
        sizes = [len(x[2]) // 4 for x in held]
        parts = sorted(windows_of(sizes, self.window), key=lambda p: -sum(sizes[i] for i in p))
        keep = -(-sum(sizes) // self.window)
        spare = [held[i] for p in parts[keep:] for i in p]
        for p in parts[:keep]:
            pieces = [held[i] for i in p]
            room = self.window - sum(sizes[i] for i in p)
            while room and spare:
                doc, start, ids, total = spare.pop()
                pieces.append((doc, start, ids[: 4 * room], total))
                if len(ids) > 4 * room:
                    spare.append((doc, start + room, ids[4 * room :], total))
                room -= min(room, len(ids) // 4)
            self._emit(pieces)

    def taken(self) -> pd.DataFrame:
        rows, self.rows = self.rows, []
        frame = pd.DataFrame(rows, columns=[x.split()[0] for x in SCHEMA.split(", ")])
        return frame.astype({c: "int64" for c in frame.columns if c != "doc_id"}).astype({"doc_id": "Int64"})


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    piece: int = PIECE,
    block: int = BLOCK,
    end: int = END_OF_TEXT,
) -> DataFrame:
    """One row per piece: document, place in it, checksum, and place in a sequence of ``window`` tokens at most.

    ``tokenizer`` is the path of a tokenizer file on every executor. A document's tokens are its
    ids and then ``end``. Whole windows are cut from its front; the remainder, in pieces of
    ``piece`` at most, is balanced with the other remainders of the task, ``block`` at a time, and
    spare windows are cut up to fill the others, so a block has less than one window of padding. A
    null text is an empty one: its only token is ``end``. Null ids and repeated rows are packed row
    by row. No rows give no rows. Other columns are ignored.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = opened(WordBPE, tokenizer)
        packer = _Packer(window, piece, block, TaskContext.get().partitionId())
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            for doc, text in zip(batch["i"], batch["t"], strict=True):
                packer.add(None if pd.isna(doc) else int(doc), encoder.ids(text or "").tobytes() + last)
            if packer.rows:
                yield packer.taken()
        packer.flush()
        if packer.rows:
            yield packer.taken()

    return docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).mapInPandas(run, SCHEMA)
