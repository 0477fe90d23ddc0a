"""Merkle manifest of a table: leaf hashes, one tree per group, one tree over the groups' roots.

Trees are built level by level with windows over runs of ``ARITY`` nodes: lag columns masked by a
node's slot are its left siblings, lead columns masked by the run's length its right ones, and the
row in slot 0 hashes the parent. A level is one shuffle by run, and a run is never more than
``ARITY`` rows, however large a group is. Texts are hashed where they are read and never shuffled.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendlens.llm.common import remainder
from lendlens.sources.session import stage

ARITY = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of a range of the sorted leaves, and the least worth a task of its own.
RANGE_ROWS, LEAST_ROWS = 250_000, 10_000


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return digest(F.concat(*(_field(c) for c in columns)))


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def numbered(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Written copy of ``df`` with ``idx``, the place in its group from 0 on, and ``n``, the group's rows.

    Rows are sorted in ranges over all groups, so a hot group fills many ranges. A row's place in
    its range comes from the sort; the rows of its group in earlier ranges are added from a table
    of one row per range and group. Rows that tie in ``order`` must be interchangeable.
    """
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    ranges = max(1, -(-rows // RANGE_ROWS), min(cores, rows // LEAST_ROWS))
    # ties are split by the row number, so that equal rows don't meet in one range
    tied = df.withColumn("tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in (group, *order, "tie")]
    placed = tied.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    split = stage(placed.drop("tie").withColumn("part", F.shiftright("at", 33)), "sorted")
    parts = split.groupBy(group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("earlier")
    offsets = parts.select(
        F.col(group).alias("of"), F.col("part").alias("in"), "first", earlier, F.sum("rows").over(whole).alias("n")
    )
    joined = split.join(offsets, F.col(group).eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    place = (F.col("at") - F.col("first") + F.col("earlier")).alias("idx")
    return joined.select(*df.columns, place, F.col("n").cast("bigint").alias("n"))


def _level(nodes: DataFrame) -> DataFrame:
    """``nodes`` (group, idx, n, hash) with their run, and the digests to their left and right in it."""
    run = F.floor(F.col("idx") / ARITY).cast("bigint")
    window = Window.partitionBy("group", "run").orderBy("idx")
    slot = F.col("idx") % ARITY
    length = F.least(F.lit(ARITY).cast("bigint"), F.col("n") - F.col("run") * ARITY)
    left = [F.when(slot >= k, F.lag("hash", k).over(window)).otherwise("") for k in range(ARITY - 1, 0, -1)]
    right = [F.when(slot + k < length, F.lead("hash", k).over(window)).otherwise("") for k in range(1, ARITY)]
    return nodes.withColumn("run", run).withColumns({"left": F.concat(*left), "right": F.concat(*right)})


def tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Roots and paths of one tree per group.

    ``nodes``: group, idx, n, hash, and other columns that are kept; a written table. Roots are
    (group, root); paths are ``nodes`` with ``path``, the array of (left, right) siblings from the
    node's own level up to the root's children. A group of one node is its own root with an empty path.
    """
    bare, levels, roots = nodes.select("group", "idx", "n", "hash"), [], []
    most = bare.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(bare.where("n = 1").select("group", F.col("hash").alias("root")))
        if most <= 1:
            break
        level = _level(bare.where("n > 1"))
        levels.append(level)
        above = level.where(F.col("idx") % ARITY == 0).select(
            "group",
            F.col("run").alias("idx"),
            F.ceil(F.col("n") / ARITY).cast("bigint").alias("n"),
            digest(F.concat("hash", "right")).alias("hash"),
        )
        bare, most = stage(above, "level"), -(-most // ARITY)
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    sides = F.struct("left", "right")
    none = F.array().cast("array<struct<left:string,right:string>>")
    upper = None
    for level in reversed(levels[1:]):
        own = level.select("group", "idx", "run", F.array(sides).alias("own"))
        upper = stage(_extended(own, upper).select("group", "idx", "path"), "paths")
    extra = [c for c in nodes.columns if c not in ("group", "idx", "n", "hash")]
    alone = nodes.where("n = 1").select("group", "idx", "hash", *extra, none.alias("path"))
    if not levels:
        return found, alone
    lowest = _level(nodes.where("n > 1")).select("group", "idx", "hash", *extra, "run", F.array(sides).alias("own"))
    return found, alone.unionByName(_extended(lowest, upper).drop("own", "run"))


def _extended(own: DataFrame, upper: DataFrame | None) -> DataFrame:
    """``path``: a node's own siblings, then its parent's path (none under a root)."""
    if upper is None:
        return own.withColumn("path", F.col("own"))
    above = upper.select(F.col("group").alias("of"), F.col("idx").alias("parent"), F.col("path").alias("rest"))
    met = F.col("group").eqNullSafe(F.col("of")) & (F.col("run") == F.col("parent"))
    joined = own.join(above, met, "left").drop("of", "parent")
    rest = F.coalesce("rest", F.array().cast("array<struct<left:string,right:string>>"))
    return joined.withColumn("path", F.concat("own", rest)).drop("rest")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, side: digest(F.concat(side["left"], node, side["right"])))


def siblings(path: Column) -> Column:
    """All digests of a path in order, as one text."""
    return F.array_join(F.transform(path, lambda side: F.concat(side["left"], side["right"])), "")


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = LEAF_COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    text_col: str = "text",
    tampered: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its leaf, its group's root, the whole root, and a proof that is checked.

    Leaves hash ``columns`` in order; per ``group_col`` they ascend by ``id_col`` (null first, ties
    by digest, so repeated rows are interchangeable), and groups' roots ascend by group (null
    first). Runs of ``ARITY`` nodes have one parent; a lone node is its tree's root. ``proof_sha256``
    hashes all siblings from the leaf's level to the root (an empty text where there are none). Where
    ``tampered`` holds (by default nowhere), A-Z of ``text_col`` count as altered to small letters
    when the proof is checked; ``verified`` tells whether leaf and proof still give the root. Texts
    of any length are hashed whole. No rows give no rows. Other columns are ignored.
    """
    wrong = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    changed = F.when(F.col(text_col).rlike("[A-Z]"), lowered(F.col(text_col))).otherwise(F.col(text_col))
    altered = leaf([changed if c == text_col else F.col(c) for c in columns])
    key = F.col(id_col).cast("bigint").alias("id")
    given = leaf([F.col(c) for c in columns]).alias("hash")
    leaves = docs.select(key, F.col(group_col).cast("string").alias("group"), given, F.when(wrong, altered).alias("altered"))
    leaves = stage(leaves, "leaves")
    nodes = stage(numbered(leaves, "group", ["id", "hash"]), "nodes")
    roots, low = tree(nodes)
    roots = stage(roots.select(F.lit(0).alias("all"), F.col("group").alias("name"), F.col("root").alias("hash")), "roots")
    tops = numbered(roots, "all", ["name"]).withColumnRenamed("all", "group")
    top, high = tree(stage(tops, "tops"))
    high = high.select("name", F.col("hash").alias("subroot"), F.col("path").alias("rest"), F.col("group").alias("all"))
    high = stage(high.join(top.withColumnRenamed("group", "all"), "all").drop("all"), "high")
    joined = low.join(high, F.col("group").eqNullSafe(F.col("name")))
    proved = joined.withColumn("path", F.concat("path", "rest"))
    shown = proved.select(
        F.col("id").alias("doc_id"),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        digest(siblings(F.col("path"))).alias("proof_sha256"),
        folded(F.coalesce("altered", "hash"), F.col("path")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def one_in_three(id_col: str = "doc_id") -> Column:
    return remainder(id_col, 3) == 0


#: crc32's table and loop over the digits of an id, for engines without that function.
_CRC_SQL = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c
    FROM range(256) AS r(i))
),
crc AS (
  SELECT id, xor(list_reduce(list_transform(string_split(id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL), crc_table
)"""


def _field_sql(column: str) -> str:
    return f"coalesce(octet_length(encode(({column})::VARCHAR)) || ':' || {column}, '-')"


def _leaf_sql(text: str = "text") -> str:
    return f"sha256({' || '.join(_field_sql(text if c == 'text' else c) for c in LEAF_COLUMNS)})"


MANIFEST_SQL = f"""
WITH RECURSIVE {_CRC_SQL},
leaves AS (
  SELECT doc_id, lang, {_leaf_sql()} AS leaf,
    CASE WHEN crc % 3 = 0 THEN {_leaf_sql(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")}
      ELSE {_leaf_sql()} END AS shown,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {_leaf_sql()}) - 1 AS i
  FROM documents LEFT JOIN crc ON doc_id = id
),
level(lang, k, h) AS (
  SELECT lang, 0, list(leaf ORDER BY i) FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, k + 1, list_transform(range(0, len(h), {ARITY}),
    lambda a: sha256(array_to_string(h[a + 1 : a + {ARITY}], ''))) FROM level WHERE len(h) > 1
),
subroots AS (
  SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j FROM level WHERE len(h) = 1
),
top(k, h) AS (
  SELECT 0, list(subroot ORDER BY j) FROM subroots
  UNION ALL
  SELECT k + 1, list_transform(range(0, len(h), {ARITY}),
    lambda a: sha256(array_to_string(h[a + 1 : a + {ARITY}], ''))) FROM top WHERE len(h) > 1
),
climb(doc_id, lang, leaf, i, k, node, proof) AS (
  SELECT doc_id, lang, leaf, i, 0, shown, '' FROM leaves
  UNION ALL
  SELECT doc_id, c.lang, leaf, i // {ARITY}, c.k + 1,
    sha256(array_to_string(h[i // {ARITY} * {ARITY} + 1 : i], '') || node
      || array_to_string(h[i + 2 : i // {ARITY} * {ARITY} + {ARITY}], '')),
    proof || array_to_string(h[i // {ARITY} * {ARITY} + 1 : i], '')
      || array_to_string(h[i + 2 : i // {ARITY} * {ARITY} + {ARITY}], '')
  FROM climb c JOIN level l ON c.lang IS NOT DISTINCT FROM l.lang AND c.k = l.k WHERE len(h) > 1
),
climbed AS (
  SELECT doc_id, leaf, subroot, j AS i, node, proof
  FROM climb c JOIN level l ON c.lang IS NOT DISTINCT FROM l.lang AND c.k = l.k
  JOIN subroots s ON c.lang IS NOT DISTINCT FROM s.lang WHERE len(h) = 1
),
finish(doc_id, leaf, subroot, i, k, node, proof) AS (
  SELECT doc_id, leaf, subroot, i, 0, node, proof FROM climbed
  UNION ALL
  SELECT doc_id, leaf, subroot, i // {ARITY}, f.k + 1,
    sha256(array_to_string(h[i // {ARITY} * {ARITY} + 1 : i], '') || node
      || array_to_string(h[i + 2 : i // {ARITY} * {ARITY} + {ARITY}], '')),
    proof || array_to_string(h[i // {ARITY} * {ARITY} + 1 : i], '')
      || array_to_string(h[i + 2 : i // {ARITY} * {ARITY} + {ARITY}], '')
  FROM finish f JOIN top t ON f.k = t.k WHERE len(h) > 1
)
SELECT doc_id, leaf, subroot, h[1] AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = h[1] AS verified
FROM finish f JOIN top t ON f.k = t.k WHERE len(h) = 1
"""
