"""Alignment of two tokenizers' tokens, once per distinct text.

Rows are shuffled by their full text, so every distinct text is tokenized and aligned once, however
many documents hold it; pairs of ids that end together are counted with that multiplicity, and the
measures are joined back to the documents. Tokens are compared as the bytes they stand for.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendlens.llm.bpe import ByteBPE, opened
from lendlens.llm.common import grouped, ready
from lendlens.sources.session import stage

#: A text held by more than a PARTS-th of the documents is dealt to that many tasks in the join back.
PARTS = 256
BLANK = "▁"

ALIGNED = "key binary, copies bigint, n_a bigint, n_b bigint, links array<bigint>, groups_sha256 string"
MEASURED = (
    "key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
    " n_best bigint, count_sum bigint, groups_sha256 string"
)
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class PieceModel:
    """Ids of a SentencePiece file, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._of(i) for i in range(self.model.get_piece_size())]

    def _of(self, ident: int) -> bytes:
        piece = self.model.id_to_piece(ident)
        if self.model.is_byte(ident):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(BLANK, " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _decimals(n: int, mark: str) -> np.ndarray:
    """``mark`` after each of the first ``n`` numbers."""
    return np.array([f"{i}{mark}" for i in range(n)], object)


@dataclass
class Alignment:
    """Tokens of both sides, and which of them end where one of the other side ends."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray  # positions among a of the tokens that end a group, in order
    b_ends: np.ndarray  # the same among b


class Aligner:
    def __init__(self, byte_file: str, piece_file: str):
        self.a, self.b = opened(ByteBPE, byte_file), opened(PieceModel, piece_file)
        self.a_sizes = np.zeros(max(self.a.ranks.values()) + 1, np.int64)
        self.a_sizes[list(self.a.ranks.values())] = [len(t) for t in self.a.ranks]
        self.b_sizes = np.array([len(t) for t in self.b.bytes], np.int64)
        n = len(self.a_sizes), len(self.b_sizes)
        self.texts = [_decimals(n[0], ","), _decimals(n[0], "|"), _decimals(n[1], ","), _decimals(n[1], ";")]

    def align(self, text: str, b_ids: list[int]) -> Alignment | None:
        """None if a side's bytes are not those of the text after one blank."""
        whole = f" {text}"
        a = np.asarray(self.a.ids(whole, special=False), np.int64)
        raw = whole.encode()
        if b"".join(map(self.b.bytes.__getitem__, b_ids)) != raw:
            return None
        b = np.array(b_ids, np.int64)
        a_at, b_at = self.a_sizes[a].cumsum(), self.b_sizes[b].cumsum()
        if a_at[-1] != len(raw):  # A's tokens are cut out of the bytes, so their sum tells
            return None
        near = np.searchsorted(b_at, a_at)
        a_ends = np.flatnonzero(b_at[near] == a_at)
        return Alignment(a, b, a_ends, near[a_ends])

    def groups(self, found: Alignment) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: decimal ids of all groups in order."""
        a, b, a_ends, b_ends = found.a, found.b, found.a_ends, found.b_ends
        # a token comes after its side's earlier ones and the other side's earlier groups
        a_sizes, b_sizes = np.diff(a_ends, prepend=-1), np.diff(b_ends, prepend=-1)
        at_a = np.arange(len(a)) + np.repeat(np.concatenate([[0], b_ends[:-1] + 1]), a_sizes)
        at_b = np.arange(len(b)) + np.repeat(a_ends + 1, b_sizes)
        both = np.empty(len(a) + len(b), object)
        inner_a, last_a, inner_b, last_b = self.texts
        both[at_a], both[at_b] = inner_a[a], inner_b[b]
        both[at_a[a_ends]], both[at_b[b_ends]] = last_a[a[a_ends]], last_b[b[b_ends]]
        return "".join(both.tolist())[:-1].encode()


@functools.lru_cache(maxsize=1)
def _aligner(byte_file: str, piece_file: str) -> Aligner:
    return Aligner(byte_file, piece_file)


def _align_texts(texts: DataFrame, byte_file: str, piece_file: str, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_file, piece_file)
        for batch in batches:
            n_a, n_b, links, digests = [], [], [], []
            for _, texts in grouped(batch["t"].to_pylist()):  # ids of a few texts at once
                for text, ids in zip(texts, aligner.b.ids(texts), strict=True):
                    found = aligner.align(text, ids)
                    n_a.append(len(found.a) if found else 0)
                    n_b.append(len(found.b) if found else 0)
                    pairs = found.a[found.a_ends] * width + found.b[found.b_ends] if found else np.zeros(0, np.int64)
                    links.append(pairs)
                    digests.append(hashlib.sha256(aligner.groups(found)).hexdigest() if found else "")
            starts = np.cumsum([0] + [len(x) for x in links])
            arrays = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *links])))
            columns = [batch["key"], batch["copies"], n_a, n_b, arrays, digests]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names)

    names = [x.split()[0] for x in ALIGNED.split(", ")]
    return texts.mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """Per linked id pair: links in all documents, and whether its B id has no pair with more.

    A pair's tokens end together, so one's bytes end with the other's: there are at most two pairs
    per byte of the two vocabularies (a million here), however many texts there are.
    """
    counts = (
        aligned.select(F.explode("links").alias("pair"), "copies").groupBy("pair").agg(F.sum("copies").alias("links"))
    )
    most = F.max("links").over(Window.partitionBy(F.col("pair") % width))
    return counts.select("pair", "links", (F.col("links") == most).alias("best"))


def _measure(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds up counts and best pairs of every text's links."""
    # one row per pair of the vocabularies at most, see pair_counts
    table = counts.orderBy("pair").toArrow()
    sent = aligned.sparkSession.sparkContext.broadcast(
        tuple(table[c].to_numpy() for c in ("pair", "links", "best"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, links, best = sent.value
        for batch in batches:
            held = batch["links"]
            flat, sizes = held.flatten().to_numpy(zero_copy_only=False), np.asarray(held.value_lengths())
            at = np.searchsorted(pairs, flat)
            ends = sizes.cumsum()

            def per_text(values, ends=ends, sizes=sizes):
                sums = np.concatenate([[0], values.cumsum(dtype=np.int64)])
                return pa.array(sums[ends] - sums[ends - sizes])

            n = pa.array(sizes.astype(np.int64))
            columns = [batch[c] for c in ("key", "copies", "n_a", "n_b")]
            columns += [n, n, per_text(best[at]), per_text(links[at]), batch["groups_sha256"]]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [x.split()[0] for x in MEASURED.split(", ")]
    return aligned.mapInArrow(run, MEASURED)


def _key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def align(
    docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: tokens of both sides, groups, links and their corpus-wide counts.

    ``byte_file`` is a byte-level BPE file (side A), ``piece_file`` a SentencePiece file (side B),
    both on every executor. A text is encoded after one blank, special tokens' strings as plain
    text. Byte offsets where tokens of both sides end cut them into groups; the two tokens that end
    there are a link, so there is one per group. A null or empty text, or one that a side does not
    give back byte by byte, has zeros and an empty digest. Null ids and repeated rows each get their
    row. No rows give no rows. Other columns are ignored.

    Texts that many documents hold are dealt to several tasks in the join back.
    """
    ready(docs.sparkSession)
    width = PieceModel(piece_file).model.get_piece_size()
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("t"))
    texts = rows.where("t is not null and t != ''").groupBy("t").agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.select("t", _key(F.col("t")).alias("key"), "copies")
    aligned = stage(_align_texts(texts, byte_file, piece_file, width), "aligned")
    measured = stage(_measure(aligned, pair_counts(aligned, width)), "measured")
    total = aligned.agg(F.sum("copies")).first()[0] or 1
    ways = F.ceil(F.col("copies") * PARTS / F.lit(total)).cast("int")
    # fewer than PARTS texts have that many copies, so this table is small at any size of the corpus
    hot = F.broadcast(measured.select("key", ways.alias("ways")).where("ways > 1"))
    salt = F.pmod(F.monotonically_increasing_id(), F.coalesce("ways", F.lit(1))).cast("int").alias("salt")
    dealt = rows.select("doc_id", _key(F.col("t")).alias("key")).join(hot, "key", "left").select("doc_id", "key", salt)
    copies = F.explode(F.sequence(F.lit(0), ways - 1)).alias("salt")
    found = measured.select("key", copies, *NUMBERS, "groups_sha256")
    return dealt.join(found, ["key", "salt"], "left").select(
        "doc_id",
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in NUMBERS),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
