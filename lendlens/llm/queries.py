"""Registered queries of the text operators, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendlens.llm import (
    alignment,
    chat,
    config_packing,
    decontaminate,
    html_text,
    language_id,
    merkle,
    minhash,
    neighbours,
    packing,
    span_dedup,
    token_counts,
    toxicity,
)
from lendlens.llm.common import remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, folder, "documents"), str(path))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    profiles = language_id.learn(docs.where(remainder("doc_id", 3) != 1))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return language_id.predict(docs, profiles).select("doc_id", held_out, "lang_pred", "score")


def op3_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(table(spark, folder, "pages"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(toxicity.labelled(docs, labels.where(remainder("doc_id", 4) != 2)))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", predicted)


def op7_span_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found, name = span_dedup.dedup_spans(table(spark, folder, "documents"))
    return found.select("doc_id", f"{name}.n_sentences", f"{name}.n_removed", f"{name}.text")


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.render(table(spark, folder, "conversations"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, folder, "documents"), str(path))


def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = (str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, folder, "documents"), *files)


def op12_config_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return config_packing.pack(table(spark, folder, "documents"), str(path))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"), tampered=merkle.one_in_three())


def queries() -> dict[str, Query]:
    found = (
        op1_token_counts,
        op2_language_id,
        op3_html,
        op4_decontamination,
        op5_neighbours,
        op6_toxicity,
        op7_span_dedup,
        op8_chat,
        op9_packing,
        op10_minhash,
        op11_alignment,
        op12_config_packing,
        op13_merkle,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op8_chat": chat.RENDER_SQL, "op13_merkle": merkle.MANIFEST_SQL}
