"""Near-duplicate groups by MinHash banding, signature and set verification, and connected components.

Nodes are the distinct shingle sets; copies share one. A bucket of a band never emits its pairs:
its members are first compared with the bucket's least node. Buckets whose other members then still
lie in several components are gone through in blocks, inside tasks, which return links only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lendlens.llm.common import CHUNK, mix, ready
from lendlens.llm.components import components
from lendlens.operators.joins import dealt_join
from lendlens.sources.session import stage

WORDS = 5
PERCENT = 75
#: Bands and minima a band: a pair of similarity 0.75 shares none with probability (1 - 0.75^4)^32 = 5e-6.
BANDS, ROWS = 32, 4
#: A signature agreement below this drops a pair before the exact test; at similarity 0.75 one in ten million pairs.
AGREEMENT = 0.55
#: Members of a bucket compared at once within a task.
BLOCK = 256

_BASE = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_DRAW = np.random.Generator(np.random.Philox(key=2024))
#: Multiply-add hash functions on 64-bit numbers; their upper 32 bits are a universal family.
_MULTIPLY = _DRAW.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _DRAW.integers(0, 2**63, BANDS * ROWS, np.uint64)


def _word_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    inside = ~_BLANK[raw]
    step = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _BASE))
    own = raw[inside]
    place = np.arange(len(own)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = (_LOWER[own] + np.uint64(1)) * powers[place]
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mix(sums + lengths.astype(np.uint64) * _FOLD)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of five words (of all its words, if fewer).

    Words are maximal runs without the ASCII blanks; A-Z in lower case.
    """
    data = (text or "").encode("utf-8", "replace")
    parts, at = [], 0
    while at < len(data):  # long texts in stretches that end behind a word
        end = at + CHUNK
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        parts.append(_word_hashes(data[at:end]))
        at = end
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    width = min(WORDS, len(words))
    if not width:
        return words
    count = len(words) - width + 1
    folded = words[:count]
    for k in range(1, width):
        folded = folded * _FOLD + words[k : count + k]
    return np.unique(mix(folded + np.uint64(width)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set that isn't empty."""
    least = np.full(len(_MULTIPLY), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 512):
        values = hashes[at : at + 512, None] * _MULTIPLY + _ADD
        np.minimum(least, values.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def band_keys(least: np.ndarray) -> np.ndarray:
    """A hash of the whole minima of each band of a signature."""
    rows = least.astype(np.uint64).reshape(BANDS, ROWS)
    keys = np.zeros(BANDS, np.uint64)
    for k in range(ROWS):
        keys = mix(keys * _FOLD + rows[:, k] + np.uint64(1))
    return keys


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, s1, s2, sig``: size, fingerprint and signature of each row's set (sig null if empty)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, one, two, sigs = [], [], [], []
            for text in batch["t"]:
                found = shingles(text)
                digest = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), "<i8")
                sizes.append(len(found))
                one.append(digest[0])
                two.append(digest[1])
                sigs.append(signature(found).tobytes() if len(found) else None)
            yield pd.DataFrame(
                {"doc_id": batch["i"].astype("Int64"), "n_shingles": np.array(sizes, np.int64)}
                | {"s1": np.array(one, np.int64), "s2": np.array(two, np.int64), "sig": pd.Series(sigs, dtype=object)}
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, sig binary")


def _agreeing(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose signatures agree in enough places."""
    least = int(AGREEMENT * len(_MULTIPLY))

    @F.pandas_udf("boolean")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        left = np.frombuffer(b"".join(x), "<u4").reshape(len(x), -1)
        right = np.frombuffer(b"".join(y), "<u4").reshape(len(y), -1)
        return pd.Series((left == right).sum(axis=1) >= least)

    a = sets.select(F.col("node").alias("a"), F.col("sig").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("sig").alias("sb"))
    return pairs.join(a, "a").join(b, "b").where(agree("sa", "sb")).select("a", "b")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``i, t`` of the documents in ``nodes`` (column ``i``): every text of an id, each once."""
    return stage(docs.join(nodes.distinct(), "i", "left_semi").distinct(), "minhash-texts")


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of ids whose whole shingle sets reach the similarity."""

    @F.pandas_udf("boolean")
    def similar(x: pd.Series, y: pd.Series) -> pd.Series:
        out, last, held = [], None, np.zeros(0, np.uint64)
        for one, other in zip(x, y, strict=True):
            if other is not last and other != last:
                last, held = other, shingles(other)
            mine = shingles(one)
            common = _common(mine, held)
            out.append(100 * common >= PERCENT * (len(held) + len(mine) - common) and common > 0)
        return pd.Series(out, dtype=bool)

    a = texts.select(F.col("i").alias("a"), F.col("t").alias("ta"))
    b = texts.select(F.col("i").alias("b"), F.col("t").alias("tb"))
    return pairs.join(a, "a").join(b, "b").where(similar("ta", "tb")).select("a", "b").distinct()


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if not len(x) or not len(y):
        return 0
    return int((y[np.searchsorted(y, x).clip(max=len(y) - 1)] == x).sum())


def _compact(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, small, keys, whole``: the lowest byte of each minimum, a 64-bit hash of each band's whole minima, and the
    whole set, sorted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            small, keys, whole = [], [], []
            for text in batch["t"]:
                found = shingles(text)
                least = signature(found)
                small.append(least.astype(np.uint8).tobytes())
                keys.append(band_keys(least).tobytes())
                whole.append(found.tobytes())
            yield pd.DataFrame({"node": batch["i"], "small": small, "keys": keys, "whole": whole})

    chosen = texts.join(nodes.select(F.col("node").alias("i")).distinct(), "i", "left_semi")
    return stage(chosen.mapInPandas(run, "node bigint, small binary, keys binary, whole binary"), "minhash-compact")


class _Forest:
    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.above.get(x, x)) != x:
            self.above[x] = self.above.get(up, up)
            x = up
        return x

    def join(self, x: int, y: int) -> None:
        self.above[self.root(x)] = self.root(y)


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """Links between the components of one group of bucket members, just enough of them to join what can be joined.

    Signatures drop most pairs; the others are compared on their whole sets before their components
    count as joined. Each pair is looked at in the first band only whose whole minima it shares.
    """
    group = group.sort_values(["visitor", "node"], kind="stable")
    small = np.frombuffer(b"".join(group["small"]), np.uint8).reshape(len(group), -1)
    keys = np.frombuffer(b"".join(group["keys"]), np.uint64).reshape(len(group), -1)
    part, node, visitor = (group[c].to_numpy() for c in ("component", "node", "visitor"))
    band, main = int(group["band"].iloc[0]), group["main"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group["whole"]]
    size = np.array([len(x) for x in sets])
    own = int((~visitor).sum())
    within = bool(group["first"].iloc[0])
    least = int(AGREEMENT * small.shape[1])
    forest, out = _Forest(), []
    for k in range(len(group)):
        others = slice(k + 1 if k < own else 0, own)
        if k < own and not within:
            continue
        equal = small[others] == small[k]
        near = (equal.sum(axis=1) >= least) & (part[others] != part[k])
        near &= 100 * np.minimum(size[others], size[k]) >= PERCENT * np.maximum(size[others], size[k])
        if k >= own:  # of two visitors to each other's blocks one pair is enough
            near &= main[others] | (node[others] > node[k])
        if band:
            near &= ~(keys[others, :band] == keys[k, :band]).any(axis=1)
        for j in np.flatnonzero(near) + others.start:
            x, y = int(part[k]), int(part[j])
            if forest.root(x) == forest.root(y):
                continue
            common = _common(sets[k], sets[j])
            if 100 * common >= PERCENT * (size[k] + size[j] - common):
                forest.join(x, y)
                out.append((max(node[k], node[j]), min(node[k], node[j])))
    return pd.DataFrame(np.array(out, np.int64).reshape(-1, 2), columns=["a", "b"])


def _across(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that link components of bucket members ``key, band, node, component``.

    In each bucket the members of its largest component need no comparison with each other. All
    members are dealt in blocks of ``BLOCK``; members of the other components, in stretches, visit
    every block. So a group is bounded, and rows are made for members only, never for pairs.
    """
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("x"), F.sum("n").alias("all"))
    blocks = F.ceil(F.col("all") / F.lit(float(BLOCK))).cast("int").alias("blocks")
    stretches = F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("x.n")) / F.lit(4.0 * BLOCK)).cast("int"))
    named = (F.col("x.component").alias("largest"), blocks, stretches.alias("stretches"), "all")
    sizes = stage(sizes.select("key", *named), "minhash-sizes")
    placed = dealt_join(members, sizes, "key", "all", "node").drop("all")
    placed = placed.withColumn("main", F.col("component") == F.col("largest"))
    place = lambda seed, n: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    placed = placed.withColumn("block", place(1, "blocks")).withColumn("stretch", place(2, "stretches"))
    kept = ("key", "band", "node", "component", "main")
    own = placed.select(
        *kept, F.lit(False).alias("visitor"), "block", F.explode(F.expr("sequence(0, stretches - 1)")).alias("stretch")
    )
    visits = placed.where("not main and blocks > 1").select(
        *kept, F.lit(True).alias("visitor"), "block", "stretch", F.explode(F.expr("sequence(0, blocks - 1)")).alias("at")
    )
    visits = visits.where("at != block").select(*kept, "visitor", F.col("at").alias("block"), "stretch")
    dealt = own.union(visits).withColumn("first", F.col("stretch") == 0)
    dealt = dealt.join(_compact(texts, members), "node")
    return dealt.groupBy("key", "block", "stretch").applyInPandas(_compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Documents are linked where 100 * shared shingles >= 75 * all shingles; ``component_id`` is the
    smallest id reachable, ``kept`` whether that is the row's own. A null or blank text has no
    shingles and is linked with nothing. A row with a null id takes part in no link and is kept,
    its component null. Repeated rows give repeated rows; rows that share an id but not a text
    are one document, linked with whatever one of its texts is linked with. Buckets that hold a large
    share of all rows are dealt to several tasks. An empty table gives no rows; other columns
    are ignored.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    found = stage(features(rows, "i", "t"), "minhash-features")
    some = found.where("n_shingles > 0 and doc_id is not null")
    sets = stage(
        some.groupBy("s1", "s2").agg(F.min("doc_id").alias("node"), F.min("sig").alias("sig")), "minhash-sets"
    )
    width = 4 * ROWS
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", 1 + k * width, width)) for k in range(BANDS)])
    entries = sets.select("node", F.posexplode(bands).alias("band", "key"))
    buckets = entries.groupBy("key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1")
    buckets = stage(buckets, "minhash-counts")
    shared = stage(dealt_join(entries, buckets, "key", "c", "node").where("node != least"), "minhash-buckets")
    stars = shared.select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    pairs = stage(_agreeing(stars, sets), "minhash-pairs")
    crowded = shared.where("c > 2").select("key", "band", "node")
    nodes = pairs.select(F.col("a").alias("i")).union(pairs.select("b")).union(crowded.select("node"))
    texts = _texts(rows, nodes)
    first = stage(_linked(pairs, texts), "minhash-links")
    groups = stage(components(first), "minhash-groups")
    placed = crowded.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stage(placed.select("key", "band", "node", "component"), "minhash-placed")
    ends = (F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("held"))
    split = stage(placed.groupBy("key").agg(*ends).where("lo < hi").select("key", "held"), "minhash-split")
    rest = stage(dealt_join(placed, split, "key", "held", "node").drop("held"), "minhash-rest")
    second = stage(_across(rest, texts), "minhash-more-links")
    if not second.isEmpty():
        groups = components(first.union(second))
    named = sets.select("s1", "s2", "node").join(groups, "node", "left")
    named = named.select("s1", "s2", F.coalesce("component", "node").alias("c"))
    out = found.select("doc_id", "n_shingles", "s1", "s2").join(named, ["s1", "s2"], "left")
    part = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("c")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", part.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, columns unchanged; a repeated id stays once.

    Rows with a null id are all kept.
    """
    found = stage(near_duplicates(docs, id_col, text_col), "minhash-result")
    dropped = found.where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    left = docs.join(dropped, id_col, "left_anti")
    kept = found.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias(id_col))
    repeated = kept.agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_col)
    if repeated.isEmpty():
        return left
    once = left.join(repeated, id_col, "left_semi").dropDuplicates([id_col])
    return left.join(repeated, id_col, "left_anti").unionByName(once)
