"""Text operators against brute force, and on odd tables: nulls, empty and long texts, ties, repeats, no rows."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lendlens.llm import (
    chat,
    components,
    decontaminate,
    html_text,
    language_id,
    minhash,
    neighbours,
    packing,
    queries,
    span_dedup,
    token_counts,
    toxicity,
)

SMALL = "/root/testdata/sf0.001"
BPE, PIECES = str(public_tokenizers.path("word_bpe_49k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))
#: Null id, null text, empty text, a repeated row, one very long text, a text of blanks.
ODD = [
    (None, "no id here", "en"),
    (1, None, None),
    (2, "", "en"),
    (3, "one two three four five six", "en"),
    (3, "one two three four five six", "en"),
    (4, "ab cd. " * 30_000, None),
    (5, " \n\t ", "de"),
]


@pytest.fixture(scope="module")
def odd(spark):
    # columns of the operators' own making must not clash with a table's
    clash = "1 as score, 2 as component_id, 3 as kept, 4 as i, 5 as t, 6 as offset"
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string").selectExpr("*", *clash.split(", "))


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SMALL}/documents.parquet")


# --- token counts ------------------------------------------------------------


def _plain_count(text: str, pieces: dict[str, float]) -> int:
    if not text:
        return 0
    s, longest = "▁" + text.replace(" ", "▁"), max(map(len, pieces))
    unknown = min(pieces.values()) - token_counts.UNKNOWN_PENALTY
    best: list = [(0.0, 0)] + [None] * len(s)
    for i in range(len(s)):
        score, n = best[i]
        for j in range(i + 1, min(len(s), i + longest) + 1):
            if s[i:j] in pieces and (best[j] is None or score + pieces[s[i:j]] > best[j][0]):
                best[j] = (score + pieces[s[i:j]], n + 1)
        if s[i] not in pieces and (best[i + 1] is None or score + unknown > best[i + 1][0]):
            best[i + 1] = (score + unknown, n + len(s[i].encode()))
    return best[-1][1]


def test_token_counts_follow_the_plain_search(spark, docs):
    pieces = token_counts.unigram_pieces(PIECES)
    got = queries.op1_token_counts(spark, SMALL).toPandas().set_index("doc_id").n_tokens
    for doc, text in zip(docs.doc_id[:40], docs.text[:40], strict=True):
        assert got[doc] == _plain_count(text, pieces)
    draw = np.random.default_rng(3)
    parts = ["a", "the", " ", "  ", "é", "\n", "漢", "tion", "▁", ".", ","]
    texts = ["".join(draw.choice(parts, draw.integers(0, 30))) for _ in range(500)]
    assert token_counts.Counter(pieces).count(texts) == [_plain_count(t, pieces) for t in texts]


def test_token_count_ties_go_to_the_earlier_start():
    # "abc": a+bc and ab+c have the same score; ab+c's last piece starts later, so a+bc stays
    pieces = {"▁": 0.0, "a": -1.0, "ab": -1.0, "bc": -1.0, "c": -1.0, "abc": -2.0}
    assert token_counts.Counter(pieces).count(["abc"]) == [2]
    assert token_counts.Counter(pieces, byte_fallback=False).count(["zz", ""]) == [2, 0]


def test_token_counts_of_odd_rows(odd, none):
    rows = {(r.doc_id, r.n_tokens > 0) for r in token_counts.token_counts(odd, PIECES).collect()}
    assert {(1, False), (2, False), (None, True), (4, True)} <= rows
    assert token_counts.token_counts(odd, PIECES).count() == len(ODD)
    assert token_counts.token_counts(none, PIECES).count() == 0


# --- language and toxicity ---------------------------------------------------


def test_languages_of_held_out_documents(spark, docs):
    got = queries.op2_language_id(spark, "/root/testdata/sf0.01").toPandas()
    truth = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").set_index("doc_id").lang
    held = got[got.held_out]
    assert set(held.doc_id) == {i for i in truth.index if zlib.crc32(str(i).encode()) % 3 == 1}
    assert (held.lang_pred == held.doc_id.map(truth)).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_of_odd_rows(odd, none):
    profiles = language_id.learn(odd.where("lang is not null"))
    got = [(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(odd, profiles).collect()]
    assert [x for x in got if x[0] in (1, 2, 5)] == [(i, "und", 0.0) for i in (1, 2, 5)]
    assert len(got) == len(ODD)
    unlearned = language_id.learn(none)
    assert {r.lang_pred for r in language_id.predict(odd, unlearned).collect()} == {"und"}
    assert language_id.predict(none, profiles).count() == 0


def test_trigram_vector_is_the_bound_and_rotated_letters():
    a, b, blank = language_id.letter_vectors(np.array([ord("a"), ord("b"), 32]), 64).astype(int)
    got = language_id.text_vectors(["AB!"], 64)[0]
    want = np.roll(blank, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * blank
    assert (got == want).all()


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op6_toxicity(spark, folder).toPandas().merge(pd.read_parquet(f"{folder}/labels.parquet"))
    held = got[got.held_out]
    toxic = held.toxic == 1
    assert held[toxic].predicted.mean() > 0.6 and held[~toxic].predicted.mean() < 0.02


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(2, 0), (3, 1), (3, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.labelled(odd, labels))
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.keep_clean(odd, model).columns == odd.columns
    empty = toxicity.fit(toxicity.labelled(none, labels))
    assert {r.score for r in toxicity.score(odd, empty).collect()} == {0.0} or max(
        r.score for r in toxicity.score(odd, empty).collect()
    ) < 1e-9
    assert toxicity.score(none, model).count() == 0


# --- main text ---------------------------------------------------------------


def test_main_text_of_marked_and_unmarked_pages():
    page = (
        "<head><title>t</title></head><header>Site</header><nav><a href=x>N</a></nav><div class='cookie-notice'>c</div>"
        "<main><article><h1>T &amp; x</h1><p>One <b>two</b><br>three<p>Four &eacute;<ul><li>a<li>b</ul>"
        "<aside>no</aside><form>f</form><script>var a='<p>';</script><div class=comments><p>bad</div></article></main>"
    )
    assert html_text.extract(page, set()) == "T & x\nOne two three\nFour é\na\nb"
    assert html_text.extract("<div id=content><p>A b</p><p>c</div><div class=sidebar>x</div>", set()) == "A b\nc"
    assert html_text.extract("<p>words <a>of</a> a text<p><a>only a link</a>", set()) == "words of a text"
    assert html_text.extract(None, set()) == html_text.extract("", set()) == ""


@pytest.mark.parametrize(
    "page",
    [
        '<body class="single no-sidebar"><p>One two</p></body>',
        '<body class="sidebar"><p>One two</p></body>',
        '<main class="content has-sidebar"><p>One two</p></main>',
        '<article class="post comment-open"><p>One two</p></article>',
        '<div id="page" class="with-nav"><p>One two</p></div><div class="ad">x</div>',
        '<div class="main-nav"><a href=x>N</a></div><p>One two</p>',
        '<form><div class="widget"><p>One two</p></div><script>x</script></form>',
    ],
)
def test_names_silence_no_whole_page(page):
    assert html_text.extract(page, set()) == "One two"


def test_fixed_texts_come_from_classes_of_whole_hosts(spark):
    page = "<div><p>Share this</p><p>text {0} of its own</p></div><div><p>All rights</p></div>"
    rows = [(n, f"http://h.example/{n}", page.format(n)) for n in range(12)]
    rows += [(50, "http://other.example/", page.format(50)), (51, None, page.format(51)), (52, "http://h.example/", None)]
    rows += [rows[0]]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and text[3] == "text 3 of its own" and text[52] == ""
    assert text[50].startswith("Share this\n") and text[51].endswith("All rights")
    assert all(r.n_chars == len(r.text) for r in got)


def test_template_of_a_host_without_marks(spark):
    """No article, no names: menu, notice, heading of the comments and a box in half of the slots go only
    because of the template; one page is of another kind, and one lacks the notice."""
    body = (
        "<div><div>Home and news of the site</div><div>Weather for all regions</div></div>{notice}"
        "<div><p>Paragraph {n} tells of {n} own matters.</p><p>Another one, with more on matter {n}.</p>{more}</div>"
        "<div><div>Terms apply to all of this</div><div>Imprint of the house</div></div>"
    )
    notice, more = "<div>We use small files to know you</div>", "<p>Third paragraph number {n}.</p>"
    rows = []
    for n in range(14):
        page = body.format(n=n, notice="" if n == 5 else notice, more=more.format(n=n) if n % 2 else "")
        rows.append((n, f"http://plain.example/{n}", page))
    rows.append((99, "http://plain.example/gone", "<h1>Not found here</h1>"))
    text = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(14):
        want = [f"Paragraph {n} tells of {n} own matters.", f"Another one, with more on matter {n}."]
        assert text[n].split("\n") == want + ([f"Third paragraph number {n}."] if n % 2 else []), n
    assert text[99] == "Not found here"


def test_classes_in_changing_order_or_slots_are_no_template(spark):
    """The same two sentences on all pages, but swapped or in another slot: they are content."""
    rows = []
    for n in range(12):
        parts = ["<p>First common sentence.</p>", "<p>Second common sentence.</p>", f"<p>own {n}</p>"]
        first, second = (parts[0], parts[1]) if n % 2 else (parts[1], parts[0])
        rows.append((n, f"http://h.example/{n}", f"<div><h2>Top</h2>{first}{parts[2]}{second}<h3>End</h3></div>"))
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in got:
        assert "First common sentence." in r.text and "Second common sentence." in r.text
        assert "Top" not in r.text and "End" not in r.text and f"own {r.page_id}" in r.text


@pytest.mark.parametrize("name", ["comment-list", "user-comments", "newsletter-signup", "cookie-bar", "related-posts", "ad-300"])
def test_silent_parts_inside_the_article(name):
    assert html_text.extract(f"<article><p>Keep</p><div class='{name}'><p>go</p></div></article>", set()) == "Keep"


def test_teasers_beside_the_article():
    page = f"<article><p>{'long text ' * 30}</p></article><article><p>Read this too</p></article>"
    assert html_text.extract(page, set()) == ("long text " * 30).strip()


@pytest.mark.parametrize("unit", ["<div>", "<b>", "<a ", "<p>", "</i>", "<b></i>", "<!", "<table><tr><td>", "<li><b>", "<a '", "x<", "<hr><b>"])
def test_a_megabyte_of_odd_markup_ends_soon(unit):
    import time
    import tracemalloc

    source = unit * (1_000_000 // len(unit)) + "the end"
    tracemalloc.start()
    started = time.process_time()
    html_text.extract(source, set())
    assert time.process_time() - started < 60
    assert tracemalloc.get_traced_memory()[1] < 400e6
    tracemalloc.stop()


def test_main_text_of_odd_tables(spark):
    kind = "page_id long, url string, html string, host string, text string, fixed int, token int"
    rows = [(None, "http://a.b/", "<p>x</p>", "h", "t", 1, 2), (1, "", "", None, None, None, None), (1, "", "", None, None, None, None)]
    frame = spark.createDataFrame(rows, kind)
    assert sorted(r.text for r in html_text.main_text(frame).collect()) == ["", "", "x"]
    assert html_text.main_text(frame.where("false")).count() == 0


def test_html_query_keeps_articles_whole(spark):
    pages = pd.read_parquet(f"{SMALL}/pages.parquet").set_index("page_id").html
    for r in queries.op3_html(spark, SMALL).collect():
        inside = re.search(r"(?s)<article>(.*)</article>", pages[r.page_id])[1]
        parts = re.split(r"</?(?:p|h1)>", inside)
        plain = [" ".join(html_text.entities.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in parts]
        assert r.text.split() == " ".join(plain).split()


# --- decontamination ---------------------------------------------------------


def _plain_distance(pattern: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return min(row)


def test_bit_parallel_distance_is_the_plain_one():
    draw = np.random.default_rng(1)
    for _ in range(200):
        pattern, text = ("".join(draw.choice(list("abc"), draw.integers(1, n))) for n in (90, 60))
        assert decontaminate.least_distance(pattern, text)[0] == min(len(pattern), _plain_distance(pattern, text))


def test_leaks_are_all_and_only_the_near_occurrences(spark):
    item = "The quick brown fox jumps over the lazy dog, and runs away from the angry bear."
    near = item.replace("quick", "quack").replace("lazy", "lzy")
    rows = [(1, f"x {near} y"), (2, "The quick brown fox"), (3, item.upper()), (3, item.upper()), (4, None), (None, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, "?!"), (None, item)], "item_id long, text string")
    got = sorted(decontaminate.leaks(docs, items).collect(), key=lambda r: (r.doc_id or 0, r.distance))
    assert [tuple(r) for r in got] == [(None, 7, 0), (1, 7, 2), (3, 7, 0), (3, 7, 0)]
    assert decontaminate.leaks(docs.where("false"), items).count() == 0
    assert decontaminate.leaks(docs, items.where("false")).count() == 0
    assert sorted(r.doc_id or 0 for r in decontaminate.drop_leaks(docs, items).collect()) == [0, 2, 4]


def test_leak_query_finds_every_whole_item(spark, docs):
    items = [decontaminate.normalised(t) for t in pd.read_parquet(f"{SMALL}/benchmark.parquet").text]
    want = {d for d, t in zip(docs.doc_id, docs.text, strict=True) if any(i in decontaminate.normalised(t) for i in items)}
    got = {r.doc_id for r in queries.op4_decontamination(spark, SMALL).collect()}
    assert want <= got and len(got - want) <= 2


# --- neighbours --------------------------------------------------------------


def test_neighbours_recall_and_exact_scores(spark):
    got = queries.op5_neighbours(spark, SMALL).toPandas()
    rows = pd.read_parquet(f"{SMALL}/embeddings.parquet")
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    hits, asked = 0, ids[ids % 20 == 0]
    for q in asked:
        score = x @ x[ids == q][0]
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, len(mine) + 1)) and mine.score.is_monotonic_decreasing
        hits += len(set(mine.vec_id) & set(ids[order]))
        assert np.allclose(mine.score, [score[ids == v][0] for v in mine.vec_id], atol=1e-12)
    assert hits / (20 * len(asked)) >= 0.9


def test_neighbours_of_copies_and_unusable_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [(20, [1.0, 2.0]), (100, [0.0, 0.0]), (120, None), (140, [1.0, None])]
    rows += [(160, [float("nan"), 1.0]), (180, []), (None, [1.0, 2.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert set(got.query_id) == {0, 20, 40}
    assert list(got[got.query_id == 20].sort_values("rank").vec_id) == [i for i in range(21) if i != 20]
    assert (got.score == 5.0).all()


def _recall(got: pd.DataFrame, x: np.ndarray, every: int = 20) -> float:
    ids, hits, asked = np.arange(len(x)), 0, range(0, len(x), every)
    for q in asked:
        order = [k for k in np.lexsort((ids, -(x @ x[q]))) if k != q][:20]
        hits += len(set(order) & set(got[got.query_id == q].vec_id))
    return hits / (20 * len(asked))


@pytest.mark.parametrize("lengths", ["one", "few", "spread"])
def test_neighbours_of_unequal_lengths(spark, lengths):
    x = np.stack(pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet").embedding).astype(float)
    draw = np.random.default_rng(3)
    size = np.ones(len(x))
    if lengths == "spread":
        size = np.exp(0.5 * draw.standard_normal(len(x)))
    else:
        size[7 : 8 if lengths == "one" else 47] = 5.0
    x *= size[:, None]
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame).toPandas()
    assert (got.groupby("query_id").size() == 20).all() and got.query_id.nunique() == len(x) // 20
    assert _recall(got, x) >= 0.9


def test_neighbours_that_share_no_bucket(spark):
    x = np.eye(60) * np.array([1e-200, 1.0, 1e150])[np.arange(60) % 3][:, None]
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, index=neighbours.Index(1, 40, 0.01, 1)).toPandas()
    assert (got.groupby("query_id").size() == 20).all() and set(got.query_id) == {0, 20, 40}
    many = np.random.default_rng(5).standard_normal((600, 8))
    many /= np.linalg.norm(many, axis=1)[:, None]
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(many.tolist())], "vec_id long, embedding array<double>")
    assert _recall(neighbours.nearest(frame, index=neighbours.Index(1, 40, 0.01, 1)).toPandas(), many) == 1.0


def test_fitted_index_grows_more_selective_with_near_neighbours(spark):
    """Random directions need the widest search; tight clusters are found by the most selective set."""
    draw = np.random.default_rng(6)
    loose = draw.standard_normal((1500, 32))
    tight = np.repeat(draw.standard_normal((60, 32)), 25, axis=0) + 0.01 * draw.standard_normal((1500, 32))
    for x, at in ((loose, len(neighbours.LADDER) - 2), (tight, 0)):
        frame = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "v long, e array<double>")
        index = neighbours.fitted_index(frame, frame.where("v % 20 = 0"), 20)
        if at:
            assert neighbours.LADDER.index(index) >= at
        else:
            queries, others = (pd.DataFrame({"q": [None] * 40, "v": range(40), "e": list(x[s])}) for s in (slice(0, 40), slice(700, 740)))
            others["q"] = pd.Series([None] * 40, dtype=object)
            assert neighbours._share_met(index, queries, others) < 0.7
    assert neighbours.fitted_index(frame.where("false"), frame.where("false"), 20) == neighbours.LADDER[-1]


def test_probes_come_in_order_of_their_cost():
    rest = np.array([0.2, 0.7, 0.5])
    cost = [sum(rest[i] ** 2 if s < 0 else (1 - rest[i]) ** 2 for i, s in p) for p in neighbours.perturbations(rest, 27)]
    assert cost == sorted(cost) and len(cost) == 27


# --- spans -------------------------------------------------------------------


def test_sentences_make_up_the_text(docs):
    for text in [*docs.text, "", " \n", "\n\nA. b\n", "x.y z... q? ", "."]:
        assert "".join(span_dedup.sentences(text)) == text


def test_repeated_passages_go_but_for_the_first(spark):
    passage = "Alpha beta gamma delta epsilon zeta eta theta. " * 3 + "Iota kappa lambda mu nu xi omicron pi rho sigma. " * 3
    rows = [(1, "Own start here. " + passage + "Own end."), (2, passage + "Other end."), (3, "Short. Short. Short."), (4, None)]
    rows += [(None, passage), (2, passage + "Other end."), (5, "")]
    found, name = span_dedup.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    got = found.select("doc_id", "text", f"{name}.n_removed", F.col(f"{name}.text").alias("left")).collect()
    left = {r.doc_id: r.left for r in got}
    assert len(got) == len(rows)
    assert left[2] == "Other end." and left[3] == "Short. Short. Short." and left[4] is None and left[5] == ""
    assert left[None] == passage and left[1].startswith("Own start here. Alpha")


@pytest.mark.parametrize("sizes", [(34, 5, 7, 1), (50, 6, 14), (12, 30, 4, 9), (3, 8, 9, 11)])
def test_repeated_passages_go_up_to_their_last_sentence(spark, sizes):
    said = " ".join(" ".join(f"w{n}x{k}" for k in range(size)) + "." for n, size in enumerate(sizes))
    rows = [(1, f"Own one. {said} Own end."), (2, f"Other and more. {said} Other end."), (3, said)]
    found, name = span_dedup.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {r.doc_id: r.left for r in found.select("doc_id", F.col(f"{name}.text").alias("left")).collect()}
    assert left == {1: rows[0][1], 2: "Other and more. Other end.", 3: ""}


def test_span_query_follows_the_plain_rule(spark, docs):
    places: dict[str, tuple[int, int]] = {}
    split = {d: span_dedup.sentences(t) for d, t in zip(docs.doc_id, docs.text, strict=True)}
    for d in sorted(split):
        for start, _, span in span_dedup.spans(split[d]):
            places.setdefault(span, (d, start))
    for r in queries.op7_span_dedup(spark, SMALL).collect():
        gone = set()
        for start, end, span in span_dedup.spans(split[r.doc_id]):
            if places[span] != (r.doc_id, start):
                gone |= set(range(start, end + 1))
        assert r.n_removed == len(gone) and r.n_sentences == len(split[r.doc_id])


# --- chat --------------------------------------------------------------------


def test_prefixes_collapse_to_the_longest_conversation(spark):
    told = [("user", "a"), ("assistant", "b"), ("user", "c")]
    rows = [(1, n, *x) for n, x in enumerate(told[:2])] + [(2, n, *x) for n, x in enumerate(told)]
    rows += [(3, n + 5, *x) for n, x in enumerate(told)] + [(4, 0, "user", None), (5, 0, "user", ""), (None, 0, "user", "a")]
    rows += [(6, 0, "user", "<|im_end|>"), (6, None, "system", "s")]
    got = {r.conv_id: r for r in chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert set(got) == {2, 4, 5, 6}
    assert got[6].text == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\n< |im_end|><|im_end|>\n"
    assert got[2].n_turns == 3


# --- packing -----------------------------------------------------------------


def test_pieces_give_the_documents_back(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    got = queries.op9_packing(spark, SMALL).toPandas()
    for doc, pieces in got.sort_values("start").groupby("doc_id"):
        ids = [*tokenizer.encode(docs.text[docs.doc_id == doc].iloc[0], add_special_tokens=False).ids, 1]
        assert pieces.doc_tokens.eq(len(ids)).all() and pieces.length.sum() == len(ids)
        for r in pieces.itertuples():
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    sequences = got.sort_values("offset").groupby("sequence_id")
    assert sequences.length.sum().max() <= 2048
    assert (sequences.length.cumsum() - got.length == got.offset).all()
    assert sequences.length.sum().sum() / (2048 * sequences.ngroups) > 0.98


def test_packing_of_odd_rows(odd, none):
    got = packing.pack(odd, BPE).toPandas()
    assert got[got.doc_id.isin([1, 2, 5])].groupby("doc_id").length.sum().eq(1).all()
    assert got[got.doc_id.isna()].doc_tokens.iloc[0] == 4 and len(got[got.doc_id == 3]) == 2
    assert packing.pack(none, BPE).count() == 0


def test_differencing_balances_and_the_count_rises():
    parts = packing.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in p) for p in parts) == [14, 16]
    assert len(packing.windows_of([6, 6, 6], 10)) == 3


# --- near duplicates ---------------------------------------------------------


def _sets(texts):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        yield {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def _plain_components(ids, texts):
    sets, above = list(_sets(texts)), {i: i for i in ids}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = root(ids[a]), root(ids[b])
                above[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_near_duplicate_query_follows_the_plain_rule(spark, docs):
    got = queries.op10_minhash(spark, SMALL).toPandas().set_index("doc_id")
    want = _plain_components(docs.doc_id.tolist(), docs.text.tolist())
    assert got.component_id.to_dict() == want
    assert got.n_shingles.to_dict() == dict(zip(docs.doc_id, map(len, _sets(docs.text)), strict=True))
    assert (got.kept == (got.index == got.component_id)).all()


def test_crowded_buckets_lose_no_link(spark):
    """A hot group whose least member is near to few: links must be found between the others."""
    draw = np.random.default_rng(4)
    words = [f"w{k}" for k in range(120)]
    texts = []
    for n in range(60):
        own = list(words)
        for k in draw.choice(120, 1 + n % 4, replace=False):
            own[k] = f"x{n}y{k}"
        texts.append(" ".join(own))
    ids = list(range(60))
    frame = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    got = minhash.near_duplicates(frame).toPandas().set_index("doc_id").component_id.to_dict()
    assert got == _plain_components(ids, texts)


def test_pairs_equal_in_low_bytes_only_are_compared_later(spark):
    """The low bytes of an earlier band agree, its whole minima don't: the pair meets in a later band only."""
    draw, words = np.random.default_rng(8), [f"w{k}" for k in range(120)]
    first = minhash.signature(minhash.shingles(" ".join(words))).reshape(minhash.BANDS, minhash.ROWS)
    while True:
        other = list(words)
        for k in draw.choice(120, 3, replace=False):
            other[k] = f"x{draw.integers(1 << 40)}"
        second = minhash.signature(minhash.shingles(" ".join(other))).reshape(first.shape)
        same, low = first == second, first.astype(np.uint8) == second.astype(np.uint8)
        bands = np.flatnonzero(same.all(axis=1))
        if len(bands) and low[: bands[0]].all(axis=1).any():
            break
    texts = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "i long, t string")
    rows = [(7, int(bands[0]), node, node) for node in (1, 2)]
    members = spark.createDataFrame(rows, "key long, band int, node long, component long")
    assert [tuple(r) for r in minhash._across(members, texts).collect()] == [(2, 1)]


def test_texts_under_one_id_lose_no_link(spark):
    """Two texts share id 1; what is near to either of them is linked with it."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " more"), (4, "something else that is alone here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(frame).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_hot_buckets_are_dealt_to_several_tasks(spark):
    """Most sets lie in the same buckets; dealing them out changes no component."""
    words = [f"w{k}" for k in range(90)]
    texts = [" ".join([*words[: k % 7 + 80], f"x{k}"]) for k in range(300)] + [f"alone {k} with its own few words" for k in range(30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = minhash.near_duplicates(frame).toPandas().set_index("doc_id").component_id.to_dict()
    assert got == _plain_components(list(range(len(texts))), texts)


def test_near_duplicates_of_odd_rows(odd, none):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert {(None, 1, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 2, 3, True), (5, 0, 5, True)} <= got
    assert minhash.near_duplicates(none).count() == 0
    once = minhash.keep_one(odd)
    assert once.columns == odd.columns and once.count() == len(ODD) - 1


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 20)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {k: 1 for k in range(1, 21)} | {k: 100 for k in range(100, 130)}
