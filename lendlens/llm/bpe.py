"""Fast ids of two kinds of BPE tokenizer files, equal to those of the tokenizer library.

A file's vocabulary is handed to a rank-based encoder, which needs no merge list: a pair's rank is
the id of the joined token. Texts outside the ground where both were compared (see the tests) go to
the tokenizer library itself, so the ids are the same for every text.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata

import numpy as np
import public_tokenizers
import tiktoken

#: The rank encoder's split recurses once per blank; texts with longer runs go to the library.
BLANK_RUN = re.compile(r"\s{2000}")


def byte_letters() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others as letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def token_bytes(vocabulary: dict[str, int], skip: set[int], word_end: str = "") -> dict[bytes, int]:
    """Token ids by the bytes that they stand for; ``word_end``, if any, as a byte 0."""
    byte_of = byte_letters()
    out: dict[bytes, int] = {}
    for token, ident in vocabulary.items():
        if ident in skip:
            continue
        ended = bool(word_end) and token.endswith(word_end)
        letters = token[: -len(word_end)] if ended else token
        out[bytes(byte_of[x] for x in letters) + b"\0" * ended] = ident
    return out


class _File:
    def __init__(self, path: str, word_end: str = ""):
        self.path = path
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        self.special = {x["content"]: x["id"] for x in known["added_tokens"]}
        self.ranks = token_bytes(known["model"]["vocab"], set(self.special.values()), word_end)

    @functools.cached_property
    def library(self):
        """The tokenizer library's own encoder, loaded when a text needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _by_library(self, text: str, special: bool) -> np.ndarray:
        self.library.encode_special_tokens = not special
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


class ByteBPE(_File):
    """Ids of byte-level BPE; ``special``: strings of special tokens in a text become their ids."""

    def __init__(self, path: str):
        super().__init__(path)
        pattern = public_tokenizers.PATTERN
        self.encoder = tiktoken.Encoding("byte", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens=self.special)

    def ids(self, text: str, special: bool = True) -> np.ndarray:
        if len(text) >= 2000 and BLANK_RUN.search(text):
            return self._by_library(text, special)
        found = {x for x in self.special if x in text} if special else set()
        return self.encoder.encode_to_numpy(text, allowed_special=found, disallowed_special=())


#: Texts of code points under NEAR are split here; their small letters are all under SMALL.
NEAR, SMALL = 0x200, 0x300
_BLANK = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0"


def _class_of(kind: str) -> str:
    """Characters under SMALL of a Unicode category, as ranges of a pattern's class."""
    points = [c for c in range(SMALL) if unicodedata.category(chr(c))[0] == kind]
    starts = [c for c in points if c - 1 not in points]
    ends = [c for c in points if c + 1 not in points]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends, strict=True))


class WordBPE(_File):
    """Ids of lower-casing BPE with word ends that drops white space.

    Words, single digits and runs of other marks are cut out here and each gets a byte 0, which
    stands for the word end in the vocabulary; a text with such a byte, a special token's string or
    a code point from NEAR on is left to the library.
    """

    def __init__(self, path: str):
        super().__init__(path, "</w>")
        self.encoder = tiktoken.Encoding("word", pat_str="[^\\x00]+\\x00", mergeable_ranks=self.ranks, special_tokens={})
        letters, digits = _class_of("L"), _class_of("N")
        self.words = re.compile(f"'(?:[stmd]|re|ve|ll)|[{letters}]+|[{digits}]|[^{_BLANK}{letters}{digits}]+")
        self.far = re.compile(f"[^\\x01-\\u{NEAR - 1:04x}]")

    def ids(self, text: str, special: bool = True) -> np.ndarray:
        odd = "\0" in text or not text.isascii() and self.far.search(text)
        if odd or any(x in text for x in self.special):
            return self._by_library(text, special)
        words = self.words.findall(text.lower())
        if not words:
            return np.zeros(0, "<u4")
        return self.encoder.encode_to_numpy("\0".join(words) + "\0")


_OPEN: dict[tuple, _File] = {}


def opened(kind: type, path: str) -> _File:
    """One encoder per worker, kind and file."""
    if (kind, path) not in _OPEN:
        _OPEN[kind, path] = kind(path)
    return _OPEN[kind, path]
