"""Session defaults for local runs, and the shared staging area.

On a cluster the caller brings its own session; nothing here overrides it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark; ``extra`` settings use __ for dots."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lendlens")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it (clusters may ship it otherwise)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lendlens-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    Operators that need several passes (quantile selection, range splits, model
    iterations) stage their narrow input first, so the joins behind it run once
    and a lost executor costs a re-read, not a recomputation. Parquet keeps
    column pruning and pushdown for the passes that follow.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, label: str = "bucketed") -> DataFrame:
    """Like ``stage``, with rows of equal ``keys`` in one bucket: group-bys and joins on exactly these
    columns (and, for joins, tables with as many buckets) then need no shuffle.

    The files lie in the shared folder; the table's name is known to this session's catalog only
    as long as that catalog keeps it.
    """
    spark = df.sparkSession
    name = f"lendlens_{label}_{uuid.uuid4().hex}"
    spread = df.repartition(buckets, *keys)  # one file a bucket
    writer = spread.write.mode("errorifexists").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", fresh_path(spark, label)).saveAsTable(name)
    return spark.table(name)
