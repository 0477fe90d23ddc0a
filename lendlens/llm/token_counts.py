"""Token counts of texts under a unigram vocabulary, without building the tokens.

Aho-Corasick lists the vocabulary pieces that end at each character; dynamic programming keeps the
best score and the number of pieces of it. Texts fall apart where no piece can cross, so each
distinct stretch between two such places is solved once and its count remembered.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lendlens.llm.common import grouped, ready

#: The character that stands for a space inside pieces.
MARK = "▁"
STRETCH = re.compile(f"{MARK}+[^{MARK}]*")
#: An unknown character costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Counts a worker remembers of stretches, and of words (about 130 bytes each); beyond it starts anew.
REMEMBERED = 500_000


class Counter:
    """Number of tokens of the best segmentation.

    ``pieces`` maps a piece to its score. Rules, as unigram tokenizers have them: spaces become
    ``MARK`` and one is put in front of a text that isn't empty; where no piece covers a single
    character, an unknown piece of that character competes at the worst score less the penalty;
    of equal scores at one place the segmentation whose last piece starts first wins, a piece
    before the unknown one. An unknown character counts as its UTF-8 bytes with ``byte_fallback``;
    without it a run of unknown characters counts as one token.
    """

    def __init__(self, pieces: dict[str, float], byte_fallback: bool = True, remembered: int = REMEMBERED):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), float(score)))
        if pieces:
            self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.fallback = byte_fallback
        # no piece has MARK behind another character: a text can be cut before each run of MARKs
        self.cut = all(MARK not in p.lstrip(MARK) for p in pieces) and byte_fallback
        # nor a full stop or comma behind a letter: a word can be cut before those at its end
        self.stops = not any(re.search(r"[^\W\d_][.,]", p) for p in pieces)
        self.most = remembered
        self.known: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def _solve(self, s: str) -> int:
        n = len(s)
        if self.single.issuperset(s):
            score = [0.0] + [-math.inf] * n
            count = [0] * (n + 1)
            for end, (length, own) in self.automaton.iter(s):  # ends ascending, the longest piece of an end first
                total = score[end + 1 - length] + own
                if total > score[end + 1]:
                    score[end + 1] = total
                    count[end + 1] = count[end + 1 - length] + 1
            return count[n]
        score = [0.0] * (n + 1)
        count = [0] * (n + 1)
        open_run = [False] * (n + 1)
        ends: dict[int, list] = {}
        if self.single or len(self.automaton):
            for end, found in self.automaton.iter(s):
                ends.setdefault(end + 1, []).append(found)
        for end in range(1, n + 1):
            best = None
            for length, own in ends.get(end, ()):  # longest first
                total = score[end - length] + own
                if best is None or total > best:
                    best, number = total, count[end - length] + 1
            run = False
            char = s[end - 1]
            if char not in self.single:
                total = score[end - 1] + self.unknown
                if best is None or total > best:
                    best, run = total, True
                    if self.fallback:
                        number = count[end - 1] + len(char.encode("utf-8", "replace"))
                    else:
                        number = count[end - 1] + (not open_run[end - 1])
            score[end], count[end], open_run[end] = best, number, run
        return count[n]

    def count(self, texts: list[str]) -> list[int]:
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        if not self.cut:
            return [self._solve(s) for s in marked]
        runs = [self._stretches(s) for s in marked]
        used = set().union(*runs)
        missing = used.difference(self.known)
        if len(self.known) + len(missing) > self.most:
            self.known, missing = {}, used
        if len(self.words) > self.most:
            self.words = {}
        for x in missing:
            word = x.rstrip(".,") if self.stops else x
            stops = x[len(word) :]
            if stops and not word[-1:].isalpha():
                word, stops = x, ""
            if word not in self.words:
                self.words[word] = self._solve(word if word[0] == MARK else MARK + word)
            self.known[x] = self.words[word] + (self._solve(stops) if stops else 0)
        known = self.known.__getitem__
        return [sum(map(known, r)) for r in runs]

    @staticmethod
    def _stretches(s: str) -> list[str]:
        """Each run of MARKs with what follows it; a single MARK before a word is left out."""
        if MARK * 2 not in s and not s.endswith(MARK):
            return s.split(MARK)[1:]
        found = STRETCH.findall(s)
        return [x[1:] if x[1] != MARK else x for x in found if len(x) > 1] + [x for x in found if len(x) == 1]


def unigram_pieces(model_file: str) -> dict[str, float]:
    """Ordinary pieces and scores of a SentencePiece model file (no control, unknown or byte pieces)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


_COUNTERS: dict[str, Counter] = {}


def counter(model_file: str) -> Counter:
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = Counter(unigram_pieces(model_file))
    return _COUNTERS[model_file]


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` for every row.

    ``model_file`` is the path of a SentencePiece file on every executor; its pieces and scores are
    taken as a unigram vocabulary with byte fallback. Null and empty texts have 0 tokens, a null id
    stays null, repeated rows give repeated rows, an empty table gives none; other columns are
    ignored. No shuffle.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use = counter(model_file)
        for batch in batches:
            counts: list[int] = []
            for _, texts in grouped(["" if t is None else t for t in batch["t"]]):
                counts += use.count(texts)
            yield pd.DataFrame({"doc_id": batch["i"].astype("Int64"), "n_tokens": pd.Series(counts, dtype="int64")})

    return docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).mapInPandas(
        run, "doc_id bigint, n_tokens bigint"
    )
