"""Top-k filters, reproducible samples and splits.

Row positions are never computed: a split is a comparison with a cut-off found
by distributed selection, so the rows themselves do not move.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendlens.functions.columns import hash_order
from lendlens.operators.joins import dealt_join
from lendlens.operators.quantiles import select_ranks
from lendlens.sources.session import stage

HASH_SPACE = 2**32
#: Width of the slice of a hash above so many remaining bits.
HASH_BITS = {21: 11, 10: 11, 0: 10}


def high_risk(
    df: DataFrame,
    score: str = "PD",
    threshold: float = 0.6,
    first_n: int | None = None,
    top_k: int | None = None,
    order: str | None = None,
    key: str = "SK_ID_CURR",
) -> DataFrame:
    """Rows scoring above ``threshold``, optionally among the first n keys, the k riskiest kept."""
    source = df if first_n is None else df.orderBy(key).limit(first_n)
    risky = source.where(F.col(score) > threshold)
    return risky if top_k is None else risky.orderBy(F.desc(order or score), key).limit(top_k)


def _first_conditions(
    df: DataFrame,
    wanted: Mapping[str, tuple[Column, Callable[[int], int]]],
    key: str,
) -> dict[str, Column]:
    """Per name, the condition that holds for the first k rows by (value, key).

    ``wanted`` maps a name to a value column (null outside its population) and
    to k as a function of the population size. First the k-th value is
    selected; only if its ties are not admitted as a whole, the last admitted
    key among them is selected too.
    """
    picked = select_ranks(df, {n: (v, lambda size, k=k: [k(size) - 1]) for n, (v, k) in wanted.items()})
    sizes = {n: wanted[n][1](picked[n][0]) for n in wanted}
    cuts = {n: picked[n][1][0] for n in wanted}
    live = [n for n in wanted if cuts[n] is not None]
    counts = {}
    if live:
        around = [F.struct(F.count_if(wanted[n][0] < F.lit(cuts[n])), F.count_if(wanted[n][0] == F.lit(cuts[n]))) for n in live]
        counts = dict(zip(live, df.agg(*around).first()))
    split = {n: sizes[n] - counts[n][0] for n in live if sizes[n] - counts[n][0] < counts[n][1]}
    ties = {n: (F.when(wanted[n][0] == F.lit(cuts[n]), F.col(key)), lambda _, r=r: [r - 1]) for n, r in split.items()}
    last_keys = select_ranks(df, ties) if ties else {}

    conditions = {}
    for n, (value, _) in wanted.items():
        if cuts[n] is None:  # nobody, or more rows asked for than there are
            inside = F.lit(False) if sizes[n] <= 0 else value.isNotNull()
        elif n in split:
            inside = (value < F.lit(cuts[n])) | ((value == F.lit(cuts[n])) & (F.col(key) <= F.lit(last_keys[n][1][0])))
        else:
            inside = value <= F.lit(cuts[n])
        conditions[n] = F.coalesce(inside, F.lit(False))
    return conditions


def hash_sample(df: DataFrame, n: int, key: str = "SK_ID_CURR") -> DataFrame:
    """The n rows with the smallest key hashes (all rows when fewer); keys are unique."""
    return df.where(_first_conditions(df, {"sample": (hash_order(key), lambda _: n)}, key)["sample"])


def train_test_split(df: DataFrame, test_share: float = 0.2, key: str = "SK_ID_CURR") -> DataFrame:
    """Adds ``split``; a row's side depends on its own key only."""
    cut = int(test_share * HASH_SPACE)
    return df.withColumn("split", F.when(hash_order(key) < cut, "test").otherwise("train"))


def stratified_split(df: DataFrame, stratum: str, test_share: float = 0.2, key: str = "SK_ID_CURR") -> DataFrame:
    """Adds ``split`` with floor(share * size) test rows in every stratum: those with the smallest (hash, key).

    Any number of strata, null among them. Per stratum, rows are counted by slices of the hash, which
    give the slice that the last test row is in; the slice is then divided in the same way until the
    hash itself is found, and rows that share it are told apart by their key (keys are unique). One
    row per stratum is joined back; a stratum with a large share of the rows is dealt to several tasks.
    """
    rows = stage(df.select(F.col(stratum).alias("stratum"), hash_order(key).alias("hash"), F.col(key).alias("key")), "strata")
    want = F.floor(F.lit(test_share) * F.col("size")).cast("bigint")
    sizes = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("size"))
    # found: the leading bits of the last test row's hash; rest: its place among rows with these bits
    state = stage(sizes.select("stratum", "size", F.lit(0).cast("bigint").alias("found"), want.alias("rest")), "cuts")
    for left in (21, 10, 0):  # slices of 11, 11 and 10 bits
        width = HASH_BITS[left]
        live = dealt_join(rows.select("stratum", "hash"), state.where("rest > 0"), "stratum", "size", "hash")
        inside = live.where(F.shiftright("hash", left + width) == F.col("found"))
        counts = inside.groupBy("stratum", F.shiftright("hash", left).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("stratum").orderBy("slice")  # at most 2048 rows per stratum
        ended = counts.withColumn("upto", F.sum("n").over(order)).withColumnRenamed("stratum", "of")
        same = F.col("stratum").eqNullSafe(F.col("of"))
        reached = (F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("n") < F.col("rest"))
        cut = state.join(ended, same & reached, "left")
        place = F.coalesce(F.col("rest") - (F.col("upto") - F.col("n")), F.lit(0))
        state = stage(cut.select("stratum", "size", F.coalesce("slice", F.lit(-1)).alias("found"), place.alias("rest")), "cuts")
    # rows at the last hash itself: a few whose keys share it
    at_cut = dealt_join(rows, state.where("rest > 0"), "stratum", "size", "hash").where("hash = found")
    ranked = at_cut.withColumn("place", F.row_number().over(Window.partitionBy("stratum", "hash").orderBy("key")))
    last = ranked.where("place = rest").select(F.col("stratum").alias("of"), F.col("key").alias("last_key"))
    cuts = stage(state.join(last, F.col("stratum").eqNullSafe(F.col("of")), "left").drop("of", "rest"), "cuts")
    facts = cuts.select(F.col("stratum").alias("__stratum"), F.col("size").alias("__size"), F.col("found").alias("__cut"), F.col("last_key").alias("__last"))
    named = df.withColumn("__stratum", F.col(stratum))
    joined = dealt_join(named, facts, "__stratum", "__size", key, "left")
    hashed = hash_order(key)
    test = (hashed < F.col("__cut")) | ((hashed == F.col("__cut")) & (F.col(key) <= F.col("__last")))
    return joined.withColumn("split", F.when(test, "test").otherwise("train")).select(*df.columns, "split")


def top_bottom(df: DataFrame, score: str, key: str = "SK_ID_CURR") -> DataFrame:
    """Adds ``tail``: 'top' for the first 20% of rows by score (ties by key), 'bottom' for those after 80%, else null.

    Counts are truncated, as in ``int(0.2 * n)`` and ``int(0.8 * n)``.
    """
    value = -F.col(score)
    wanted = {"top": (value, lambda n: int(n * 0.2)), "most": (value, lambda n: int(n * 0.8))}
    first = _first_conditions(df, wanted, key)
    tail = F.when(first["top"], "top").when(~first["most"] & F.col(score).isNotNull(), "bottom")
    return df.withColumn("tail", tail)
