"""Removal of repeated passages by sliding spans of consecutive sentences.

A span starts at every sentence and takes in the next ones until it has enough words; another ends
at every sentence and takes in those before it. So every sentence of a passage whose whole
sentences have enough words lies in a span inside the passage. Spans are compared over the whole
corpus by hash; in every place but the first (least id, then position) the sentences of a repeated
span go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from lendlens.llm.common import ready
from lendlens.sources.session import stage

#: Words that a span has at least; it goes no further than the sentence that reaches them.
SPAN_WORDS = 30
#: A span with more than this part of all repeated places is joined in several parts, each of about that size.
PARTS = 1024

#: A sentence ends behind a full stop, exclamation or question mark before white space, or at a line's end.
_SENTENCE = re.compile(r"[^\n]*?(?:[.!?]+(?=\s)[^\S\n]*|\n\s*|\Z)", re.S)


def sentences(text: str) -> list[str]:
    """Stretches that make up the text, each with the white space behind it."""
    out: list[str] = []
    for m in _SENTENCE.finditer(text):
        part = m.group()
        if not part:
            continue
        if out and not part.strip():  # white space belongs to the sentence before it
            out[-1] += part
        else:
            out.append(part)
    return out


def spans(parts: list[str], words: int = SPAN_WORDS) -> Iterator[tuple[int, int, str]]:
    """First sentence, last sentence and text (words, single spaces, lower case) of every span, by position.

    The shortest run backwards from a sentence is left out where the shortest run forwards from its
    first sentence is the same; that depends on the run's own text only, so it holds in all places.
    """
    split = [p.lower().split() for p in parts]
    sizes = [len(x) for x in split]
    texts = [" ".join(x) for x in split]
    ends: dict[int, int] = {}
    end, held = 0, 0
    for start in range(len(parts)):
        while held < words and end < len(parts):
            held += sizes[end]
            end += 1
        if held < words:
            break
        if sizes[start]:
            ends[start] = end - 1
        held -= sizes[start]
    found = list(ends.items())
    start, held = 0, 0
    for end, size in enumerate(sizes):
        held += size
        while held - sizes[start] >= words:
            held -= sizes[start]
            start += 1
        if size and held >= words and ends[start] != end:
            found.append((start, end))
    for start, end in sorted(found):
        yield start, end, " ".join(texts[start : end + 1])


def _span_rows(rows: DataFrame, words: int) -> DataFrame:
    """``h1, h2, i, s``: 96-bit hash, document and place of every span, its first sentence in the upper 32 bits of the
    place and its last in the lower."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests, owners, starts = [], [], []
            for owner, text in zip(batch["i"].tolist(), batch["t"], strict=True):
                for start, end, span in spans(sentences(text), words):
                    digests.append(xxhash.xxh3_128_digest(span))
                    owners.append(owner)
                    starts.append(start << 32 | end)
            table = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pd.DataFrame(
                {"h1": table[:, 0], "h2": table[:, 1].astype(np.int32)}
                | {"i": np.array(owners, np.int64), "s": np.array(starts, np.int64)}
            )

    return rows.where("i is not null and t is not null").mapInPandas(run, "h1 bigint, h2 int, i bigint, s bigint")


def _without():
    @F.pandas_udf("text string, n_sentences int, n_removed int")
    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        out = []
        for text, mine in zip(texts, places, strict=True):
            parts = sentences(text) if text is not None else []
            if mine is None or not len(mine):
                out.append((text, len(parts), 0))
                continue
            gone = np.zeros(len(parts), bool)
            for place in mine.tolist():
                gone[place >> 32 : (place & 0xFFFFFFFF) + 1] = True
            left = "".join(p for p, g in zip(parts, gone, strict=True) if not g).rstrip()
            out.append((left, len(parts), int(gone.sum())))
        return pd.DataFrame(out, columns=["text", "n_sentences", "n_removed"]).astype({"text": object})

    return cut


def dedup_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SPAN_WORDS
) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and that column's name: a struct of ``text`` (what stays),
    ``n_sentences`` and ``n_removed``.

    Texts with fewer than ``words`` words have no span. A null text stays null; rows with a null
    id are left as they are and not compared. Rows that repeat an id and text count as the same
    place, so none of them is cut because of the other. Sentences without a word belong to no
    span's edges. Hot spans are reduced before the shuffle, and dealt to many tasks in the join back.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    found = _span_rows(rows, words)
    place = F.struct("i", "s")
    first = stage(
        found.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"))
        .where("first != last")
        .select("h1", "h2", "first", "n"),
        "span-first",
    )
    places = first.agg(F.sum("n").alias("n")).first().n or 1
    first = first.withColumn("ways", F.ceil(F.col("n") * PARTS / F.lit(places)).cast("int")).drop("n")
    # fewer than PARTS spans can have that many places, so this table is small at any size of the corpus
    hot = F.broadcast(first.where("ways > 1").select("h1", "h2", "ways"))
    salt = F.pmod(F.xxhash64("i", "s"), F.coalesce("ways", F.lit(1))).cast("int").alias("salt")
    dealt = found.join(hot, ["h1", "h2"], "left").select("h1", "h2", "i", "s", salt)
    copies = F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("salt")
    again = dealt.join(first.select("h1", "h2", "first", copies), ["h1", "h2", "salt"]).where(place != F.col("first"))
    starts = again.groupBy("i").agg(F.collect_set("s").alias("s"))
    name, key, part = (f"{x}_{'_'.join(docs.columns)}" for x in ("kept", "key", "part"))  # clash with no column
    starts = starts.select(F.col("i").alias(key), F.col("s").alias(part))
    joined = docs.join(starts, docs[id_col].cast("bigint") == starts[key], "left")
    return joined.withColumn(name, _without()(F.col(text_col), F.col(part))).drop(key, part), name


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SPAN_WORDS) -> DataFrame:
    """``docs`` with the repeated spans cut from the texts; columns unchanged, ``n_chars`` (if there) counted anew."""
    found, name = dedup_spans(docs, id_col, text_col, words)
    left = F.col(f"{name}.text")
    changed = {text_col: left}
    if "n_chars" in docs.columns:
        size = F.when(F.col(f"{name}.n_removed") > 0, F.char_length(left)).otherwise(F.col("n_chars"))
        changed["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return found.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])
