"""Whole queries against searches that try everything, and odd tables of operators tested elsewhere on plain ones."""

from __future__ import annotations

import pandas as pd
import pytest
from test_text_operators import ODD

from lendlens.llm import chat, decontaminate, language_id, neighbours, queries, span_dedup

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    clash = "1 as score, 2 as component_id, 3 as item_id, 4 as i, 5 as t, 6 as e, 7 as v, 8 as turn, 'r' as role, 9 as n"
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string").selectExpr("*", *clash.split(", "))


def test_leak_query_is_the_search_of_every_item_in_every_text(spark):
    docs, items = (pd.read_parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "benchmark"))
    want = set()
    for i, item in zip(items.item_id.tolist(), map(decontaminate.normalised, items.text), strict=True):
        for d, text in zip(docs.doc_id.tolist(), docs.text, strict=True):
            distance, _ = decontaminate.least_distance(item, decontaminate.normalised(text))
            if distance <= int(len(item) * decontaminate.ERROR_RATE):
                want.add((d, i, distance))
    assert {tuple(r) for r in queries.op4_decontamination(spark, SMALL).collect()} == want and want


def test_leaks_of_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "five six ab cd ab cd ab cd ab"), (2, "one two three four five six")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(odd, items).collect()}
    assert got == {(3, 2)}
    left = decontaminate.drop_leaks(odd, items)
    assert left.columns == odd.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 4, 5]
    long = spark.createDataFrame([(9, "word " * 200_000 + "one two three four five six")], "doc_id long, text string")
    assert [(r.item_id, r.distance) for r in decontaminate.leaks(long, items).collect()] == [(2, 0)]


def test_spans_of_odd_rows(odd):
    found, name = span_dedup.dedup_spans(odd)
    rows = found.select("doc_id", "text", f"{name}.*").toDF("doc_id", "old", "text", "n_sentences", "n_removed").collect()
    assert len(rows) == len(ODD)
    whole = {r.doc_id: r for r in rows}
    assert whole[1].text is None and whole[2].text == "" and whole[3].n_removed == 0
    # the long text repeats its own sentence: only the first run of it stays
    assert whole[4].n_sentences == 30_000 and 0 < len(whole[4].text) < 400
    assert span_dedup.cut_repeats(odd).columns == odd.columns
    assert span_dedup.cut_repeats(odd.where("false")).count() == 0


def test_chat_of_odd_rows(spark):
    long = [(1, n, "user", f"turn {n}", "x") for n in range(3_000)]
    twice = [(2, 0, "user", "a", "y"), (2, 0, "user", "a", "y"), (3, 0, "user", "a", "y")]
    frame = spark.createDataFrame(long + twice, "conv_id long, turn long, role string, text string, n string")
    got = {r.conv_id: r.n_turns for r in chat.render(frame).collect()}
    assert got == {1: 3_000, 2: 2}
    assert chat.render(frame.where("false")).count() == 0


def test_neighbours_of_no_rows_and_clashing_columns(spark):
    kind = "vec_id long, embedding array<double>, q int, v int, e string, score string, t int, h int"
    rows = [(i, [float(i % 7), 1.0, float(i % 3)], 1, 2, "e", "s", 3, 4) for i in range(45)]
    frame = spark.createDataFrame(rows, kind)
    got = neighbours.nearest(frame).toPandas()
    assert set(got.query_id) == {0, 20, 40} and (got.groupby("query_id").size() == 20).all()
    assert neighbours.nearest(frame.where("false")).count() == 0


def test_languages_of_all_documents(spark):
    """Held out or not, texts of some length get their language."""
    docs = queries.table(spark, SMALL, "documents")
    profiles = language_id.learn(docs.where(queries.remainder("doc_id", 3) != 1))
    found = {r.doc_id: r for r in language_id.predict(docs, profiles).collect()}
    texts = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    right = sum(found[d].lang_pred == lang for d, (text, lang) in texts.items() if lang and text and len(text) > 40)
    told = sum(1 for text, lang in texts.values() if lang and text and len(text) > 40)
    assert right >= 0.97 * told and all(0 <= r.score <= 1 for r in found.values())
