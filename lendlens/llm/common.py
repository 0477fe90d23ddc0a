"""Small helpers that several text operators share."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Code points handled at once inside a task, so that long texts don't multiply into large arrays.
CHUNK = 1 << 18
#: Bytes that Spark hands to a Python worker at once, unless the session's own configuration says otherwise.
BATCH_KEY, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, and get texts in small batches."""
    if not spark.sparkContext.getConf().contains(BATCH_KEY):
        spark.conf.set(BATCH_KEY, BATCH)
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)
    return spark


def remainder(doc_id: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    ident = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(ident.cast("string").cast("binary")) % divisor


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def grouped(texts: Iterable[str], most: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts in lists of about ``most`` code points, with the index of each list's first."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= most:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held
