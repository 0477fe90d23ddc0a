"""Chat formatting: logged snapshots of growing conversations collapse to the longest, which is rendered.

DataFrame functions only. The identity of a conversation's first n turns is a rolling pair of
hashes: each turn is hashed with its position and joined to the turns before by exclusive or.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

OPENING, CLOSING = "<|im_start|>", "<|im_end|>"
SEEDS = (1, 2)


def _prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, n, role, text, p1, p2, last``: every turn with its position from 1 and the hashes up to it.

    Turns are in the order of turn, then role and text; nulls come first.
    """
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text").where(
        "conv_id is not null"
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("n", F.row_number().over(order))
    empty = [F.col(c).isNull() for c in ("role", "text")]
    value = [F.coalesce(c, F.lit("")) for c in ("role", "text")]
    told = lambda seed: F.xxhash64(F.lit(seed), "n", *empty, *value)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for k, seed in enumerate(SEEDS, 1):
        rows = rows.withColumn(f"p{k}", F.bit_xor(told(seed)).over(upto))
    return rows.withColumn("last", F.lead("n").over(order).isNull())


def maximal(turns: DataFrame) -> DataFrame:
    """``conv_id`` of the conversations that prefix no other; of equal ones the least id."""
    rows = _prefixes(turns).select("conv_id", "n", "p1", "p2", "last")
    whole = rows.where("last").groupBy("n", "p1", "p2").agg(F.min("conv_id").alias("conv_id"))
    inner = rows.where("not last").select("n", "p1", "p2").distinct()
    return whole.join(inner, ["n", "p1", "p2"], "left_anti").select("conv_id")


def _shown(role: Column, text: Column) -> Column:
    """One turn as text; marks inside a turn are broken by a blank, so that they can't end it."""
    safe = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(OPENING), safe(role), F.lit("\n"), safe(text), F.lit(CLOSING), F.lit("\n"))


def render(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, text`` of every maximal conversation.

    A conversation is dropped if its turns (role and text, in order) are the first turns of a longer
    one, or all turns of one with a smaller id. Turns without a conversation id are left out. A null
    role or text is shown as empty, but is not the same as an empty one. Repeated turns count as
    further turns, extra columns are ignored, no rows give no rows. Rows of one conversation come
    together in one task only to be joined into its text, which is the result.
    """
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text")
    rows = rows.join(maximal(turns), "conv_id", "left_semi")
    told = F.struct("turn", "role", "text", _shown(F.col("role"), F.col("text")).alias("x"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(told)).alias("all"))
    text = F.array_join(F.transform("all", lambda t: t["x"]), "")
    return held.select("conv_id", F.size("all").alias("n_turns"), text.alias("text"))


#: The same in DuckDB SQL, on the texts themselves instead of hashes.
RENDER_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), s AS (
  SELECT conv_id, n,
         list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY n) AS p,
         count(*) OVER (PARTITION BY conv_id) AS size
  FROM t
), f AS (
  SELECT min(conv_id) AS conv_id, p FROM s WHERE n = size GROUP BY p
), k AS (
  SELECT conv_id FROM f WHERE p NOT IN (SELECT p FROM s WHERE n < size)
)
SELECT t.conv_id, CAST(count(*) AS INT) AS n_turns,
       string_agg('<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10)
                  || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY n) AS text
FROM t JOIN k USING (conv_id) GROUP BY t.conv_id
"""
