"""Corpus pipeline: documents in, packed training sequences out; every stage is written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lendlens.llm import decontaminate, minhash, packing, span_dedup, toxicity
from lendlens.llm.common import remainder, table
from lendlens.sources.session import stage

#: Rows for learning toxicity are those whose remainder is not this one, as in query op6.
HELD_OUT = (4, 2)


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score under the threshold; learnt from the labelled ones among ``docs``."""
    divisor, left = HELD_OUT
    labels = table(spark, folder, "labels").where(remainder("doc_id", divisor) != left)
    model = toxicity.fit(toxicity.labelled(docs, labels))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return minhash.keep_one(docs)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without the sentences of spans that occur before."""
    return span_dedup.cut_repeats(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, folder, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the remaining texts, placed in sequences."""
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_spans", cut_repeated_spans),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: Scores, signatures and token ids can't be written in SQL; the tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order, each but the last written as Parquet and read again for the next."""
    docs = table(spark, folder, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
