"""The corpus pipeline against plain versions of its stages, on the smallest data and on odd tables."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
from test_text_operators import _plain_components
from tokenizers import Tokenizer

import corpus_pipeline
from lendlens.llm import decontaminate, queries, span_dedup
from lendlens.llm.common import table

SMALL = "/root/testdata/sf0.001"
WORDS = str(public_tokenizers.path("word_bpe_49k.json"))


def _without_repeats(docs: dict[int, str]) -> dict[int, str]:
    """Sentences of spans that an earlier document or place holds go."""
    split = {d: span_dedup.sentences(t) for d, t in docs.items()}
    first: dict[str, tuple[int, int]] = {}
    for d in sorted(split):
        for start, _, span in span_dedup.spans(split[d]):
            first.setdefault(span, (d, start))
    out = {}
    for d, parts in split.items():
        gone = set()
        for start, end, span in span_dedup.spans(parts):
            if first[span] != (d, start):
                gone |= set(range(start, end + 1))
        out[d] = "".join(p for k, p in enumerate(parts) if k not in gone).rstrip() if gone else docs[d]
    return out


def _holds(text: str, items: list[str]) -> bool:
    """Every item against the whole text."""
    plain = decontaminate.normalised(text)
    return any(decontaminate.least_distance(i, plain)[0] <= int(len(i) * decontaminate.ERROR_RATE) for i in items)


def test_run_is_the_plain_pipeline(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    clean = {r.doc_id for r in queries.op6_toxicity(spark, SMALL).collect() if r.predicted == 0}
    texts = {d: t for d, t in zip(docs.doc_id.tolist(), docs.text, strict=True) if d in clean}
    groups = _plain_components(list(texts), list(texts.values()))
    texts = _without_repeats({d: t for d, t in texts.items() if groups[d] == d})
    items = [decontaminate.normalised(t) for t in pd.read_parquet(f"{SMALL}/benchmark.parquet").text]
    texts = {d: t for d, t in texts.items() if not _holds(t, [i for i in items if i])}
    assert 0 < len(texts) < len(docs)

    got = corpus_pipeline.run(spark, SMALL).toPandas()
    library = Tokenizer.from_file(WORDS)
    pieces = {d: p.sort_values("start") for d, p in got.groupby("doc_id")}
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in pieces[d].itertuples():
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert got.groupby("sequence_id").length.sum().max() <= 2048


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SMALL, "documents").cache()
    items = table(spark, SMALL, "benchmark")
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, docs, SMALL).cache()
        assert after.columns == docs.columns and 0 < after.count() <= docs.count(), name
        docs = after
    assert decontaminate.leaks(docs, items).count() == 0
    assert docs.select("doc_id").distinct().count() == docs.count()


def test_stages_of_odd_tables(spark):
    """Nulls in any column, empty and blank texts, repeated rows, a column of an operator's own name; no rows."""
    docs = table(spark, SMALL, "documents").limit(30)
    kinds = {c: k for c, k in docs.dtypes}
    rows = [(None, "a text without an id"), (9_001, None), (9_002, ""), (9_003, " \n"), (9_004, "twice"), (9_004, "twice")]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    for c in docs.columns[2:]:
        extra = extra.selectExpr("*", f"cast(null as {kinds[c]}) as {c}")
    odd = docs.unionByName(extra).selectExpr("*", "1 as score", "'k' as kept", "2 as i").cache()
    for table_ in (odd, odd.where("false")):
        now = table_
        for name, step in corpus_pipeline.STAGES[:-1]:
            if table_ is not odd and name == "toxicity":
                continue  # nothing to learn from
            now = step(spark, now, SMALL).cache()
            assert now.columns == odd.columns, name
        pieces = corpus_pipeline.STAGES[-1][1](spark, now, SMALL)
        ids = Counter(r.doc_id for r in now.select("doc_id").collect())
        assert set(ids) == {r.doc_id for r in pieces.select("doc_id").distinct().collect()}
        if table_ is odd:
            assert ids[None] == 1 and ids[9_001] == ids[9_002] == ids[9_004] == 1
