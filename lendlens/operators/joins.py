"""Joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key with more than a PARTS-th of all rows is dealt to several tasks, so there are fewer than PARTS such keys.
PARTS = 256


def dealt_join(
    rows: DataFrame,
    facts: DataFrame,
    key: str,
    size: str,
    by: str | Column,
    how: str = "inner",
    own_key: str | None = None,
) -> DataFrame:
    """``rows`` with the columns of ``facts`` (one row per key, ``size``: the key's rows; a written table).

    The rows of a hot key are dealt by the hash of ``by`` to several tasks, each with a copy of the
    key's facts. Hot keys, fewer than ``PARTS``, enter the plan as literals. Null keys match each
    other. ``how`` is inner or left; ``own_key`` names the key in ``rows`` if it differs.
    """
    mine = F.col(own_key or key)
    total = facts.agg(F.sum(size)).first()[0] or 1
    share = F.greatest(F.lit(1), F.ceil(F.col(size) * PARTS / F.lit(total))).cast("int")
    plain = facts.withColumnRenamed(key, "__key").withColumn("__ways", share)
    hot = plain.where("__ways > 1").select("__key", "__ways").collect()  # fewer than PARTS
    ways = F
    for value, n in sorted(hot, key=str):
        ways = ways.when(mine.eqNullSafe(F.lit(value)), F.lit(n))
    salt = F.pmod(F.xxhash64(by), ways.otherwise(F.lit(1))).cast("int") if hot else F.lit(0)
    dealt = rows.withColumn("__salt", salt)
    copies = plain.select("*", F.explode(F.sequence(F.lit(0), F.col("__ways") - 1)).alias("__copy"))
    same = mine.eqNullSafe(F.col("__key")) & (F.col("__salt") == F.col("__copy"))
    return dealt.join(copies, same, how).drop("__salt", "__copy", "__key", "__ways")
