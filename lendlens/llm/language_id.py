"""Language identification with hyperdimensional letter n-gram profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. The vector of a trigram is
the element-wise product of its letters' vectors, each rotated by its place; a text's vector is the
sum over its trigrams, a language's the sum over its texts' unit vectors. The nearest by cosine wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lendlens.llm.common import CHUNK, code_points, grouped, ready

DIMENSIONS = 512
ORDER = 3
UNKNOWN = "und"
_SPACE = 32
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point: is it a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """Rows of +1 and -1, the same for a code point wherever it is drawn."""
    rows = [np.random.Generator(np.random.Philox(key=int(c))).integers(0, 2, dimensions, np.int8) for c in points]
    return np.array(rows, np.int8).reshape(-1, dimensions) * np.int8(2) - np.int8(1)


def text_vectors(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """One bundled vector per text; zero where a text has no letter. Letters are taken in lower case,
    every run of other characters, and either end of the text, as one space."""
    out = np.zeros((len(texts), dimensions), np.float32)
    for start, part in grouped(texts):
        if len(part) == 1 and len(part[0]) > CHUNK:
            for at in range(0, len(part[0]), CHUNK):
                # two characters of the stretch before, for the trigrams across the cut
                out[start] += _bundles([part[0][max(0, at - ORDER + 1) : at + CHUNK]], dimensions)[0]
        else:
            out[start : start + len(part)] = _bundles(part, dimensions)
    return out


def _bundles(texts: list[str], dimensions: int) -> np.ndarray:
    padded = [f" {t.lower()} " for t in texts]
    points = code_points("".join(padded))
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in padded])
    points = np.where(_letters()[points], points, np.uint32(_SPACE))
    blank = points == _SPACE
    keep = ~blank
    keep[1:] |= ~blank[:-1] | (owner[1:] != owner[:-1])  # the first of each run of blanks
    keep[0] = True
    points, owner = points[keep], owner[keep]
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen)
    place = np.zeros(0x110000, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    a, size = place[points], len(alphabet)
    if len(a) < ORDER:
        return np.zeros((len(texts), dimensions), np.float32)
    # a trigram of blanks only can't be: they were collapsed; one letter gives " x "
    keys = (a[:-2] * size + a[1:-1]) * size + a[2:]
    whole = owner[:-2] == owner[2:]
    keys, owner = keys[whole], owner[:-2][whole]
    if size**ORDER <= 1 << 22:
        used = np.zeros(size**ORDER, bool)
        used[keys] = True
        distinct = np.flatnonzero(used)
        rank = np.zeros(size**ORDER, np.int64)
        rank[distinct] = np.arange(len(distinct))
        at = rank[keys]
    else:
        distinct, at = np.unique(keys, return_inverse=True)
    first, second, third = distinct // size**2, distinct // size % size, distinct % size
    letters = letter_vectors(alphabet, dimensions)
    rolled = [np.roll(letters, ORDER - 1 - k, axis=1) for k in range(ORDER)]
    out = np.zeros((len(texts), dimensions), np.float32)
    for low in range(0, len(distinct), 16384):  # bounds the dense count matrix
        part = slice(low, low + 16384)
        grams = (rolled[0][first[part]] * rolled[1][second[part]] * rolled[2][third[part]]).astype(np.float32)
        mine = (at >= low) & (at < low + 16384) if len(distinct) > 16384 else slice(None)
        width = len(grams)
        counts = np.bincount(owner[mine] * width + (at[mine] - low), minlength=len(texts) * width)
        out += counts.reshape(len(texts), width).astype(np.float32) @ grams
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return np.divide(vectors, length, out=np.zeros(vectors.shape), where=length > 0)


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # one unit row per language


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> Profiles:
    """Prototypes of all rows with a text and a language.

    Tasks add up their own rows; the driver gets one vector per language, however many rows there are.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for start, texts in grouped(batch["t"].tolist()):
                units = _unit(text_vectors(texts, dimensions))
                langs = batch["l"].to_numpy()[start : start + len(texts)]
                for lang in pd.unique(langs):
                    sums[lang] = sums.get(lang, 0) + units[langs == lang].sum(axis=0)
        for lang, v in sums.items():
            yield pd.DataFrame({"l": lang, "p": np.arange(dimensions), "x": v})

    rows = docs.select(F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where("t is not null and l is not null")
    parts = rows.mapInPandas(run, "l string, p int, x double")
    sums = parts.groupBy("l", "p").agg(F.sum("x").alias("x")).collect()
    languages = sorted({r.l for r in sums})
    table = np.zeros((len(languages), dimensions))
    for r in sums:
        table[languages.index(r.l), r.p] = r.x
    return Profiles(languages, _unit(table))


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from the text alone.

    The score is the cosine with the language's prototype, 0 at least; ties go to the language that
    sorts first. A text that is null or has no letter, or any text if no language was learned, gets
    ``und`` and 0. Null ids and repeated rows are answered row by row; other columns are ignored.
    """
    ready(docs.sparkSession)
    languages, prototypes = profiles.languages, profiles.prototypes
    dimensions = prototypes.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names: list[str] = []
            scores: list[float] = []
            for _, texts in grouped(["" if t is None else t for t in batch["t"]]):
                vectors = text_vectors(texts, dimensions)
                some = (vectors != 0).any(axis=1)
                if languages:
                    cosine = _unit(vectors) @ prototypes.T
                    best = cosine.argmax(axis=1)
                    top = cosine[np.arange(len(texts)), best].clip(0, 1)
                    names += [languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
                    scores += np.where(some, top, 0.0).tolist()
                else:
                    names += [UNKNOWN] * len(texts)
                    scores += [0.0] * len(texts)
            yield pd.DataFrame({"doc_id": batch["i"].astype("Int64"), "lang_pred": names, "score": scores})

    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "doc_id bigint, lang_pred string, score double")
