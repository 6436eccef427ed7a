"""Tokenizing through a memory of pieces, each encoded once by the real tokenizer.

A text is cut only where its tokenizer can never join across, so the ids of the
pieces one after the other are the ids of the whole text.  Most pieces are words
that were seen before; only new ones go through the library, many per call.  The
memory belongs to a Python worker; when it is full, pieces that were not met again are
forgotten, which costs time but changes no result.

Added tokens of a tokenizer file, such as ``<|endoftext|>``, are taken out of a text
first, as the library does, and stand for their ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Callable

import numpy as np
import regex

from aerostrata.llm.staging import ragged, slices

PIECES_KEPT = 500_000
CHARACTERS_AT_ONCE = 500_000

# The split of byte-level BPE, and the letter that stands for each byte.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_SHOWN_AS_THEMSELVES = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _SHOWN_AS_THEMSELVES]
BYTE_LETTERS = "".join(chr(256 + _OTHERS.index(b)) if b in _OTHERS else chr(b) for b in range(256))
_JOINED_LETTERS = BYTE_LETTERS[:255] + " "

Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]

_BEFORE_BLANK = re.compile(r"(?<=\S)(?=[ \n])")


def cut_byte_level(text: str) -> list[str]:
    """Pieces for tokenizers whose words take the blank before them.

    A blank or line end after a character that is not white space always starts a
    new match of the split pattern, and what follows does not depend on what was
    before.  Where white space stands alone, a line end is a match by itself.
    """
    lone = not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text)
    # other white space and the separator below are not printable
    if not lone or not text.replace("\n", "").isprintable():
        return _BEFORE_BLANK.split(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def cut_at_blanks(text: str) -> list[str]:
    """Pieces for tokenizers that drop white space between words."""
    return text.replace("\n", " ").split(" ")


def cut_around(tokens: list[str], cut: Callable[[str], list[str]]) -> Callable[[str], list[str]]:
    """``cut`` for what lies between the added tokens, which are pieces themselves."""
    if not tokens:
        return cut
    # of tokens that start at one place the longest counts
    longest_first = sorted(tokens, key=len, reverse=True)
    parts_of = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split

    def around(text: str) -> list[str]:
        for token in tokens:
            if token in text:
                break
        else:
            return cut(text)
        pieces: list[str] = []
        for i, part in enumerate(parts_of(text)):
            if i % 2:
                pieces.append(part)
            elif part:
                pieces += cut(part)
        return pieces

    return around


class _Numbers(dict):
    """Numbers for strings in order of appearance; ``new`` holds those to be encoded."""

    def __init__(self):
        super().__init__({"": 0})
        self.new: list[str] = []

    def __missing__(self, text: str) -> int:
        number = self[text] = len(self)
        self.new.append(text)
        return number


class Remembered:
    """Ids of strings that were encoded before.

    ``encode`` gives for a list of strings all their ids and the number of each.  When
    ``kept`` strings are exceeded, those that were not met again since the last time are
    forgotten, so frequent ones stay and strings met once make room.
    """

    def __init__(self, encode: Encoder, kept: int):
        self._encode, self._kept = encode, kept
        self._known = _Numbers()
        self.starts = np.zeros(1024, np.int64)
        self.counts = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self._met = np.zeros(1024, bool)
        self._used = 0

    def __len__(self) -> int:
        return len(self._known)

    def _learn(self, strings: list[str]) -> None:
        ids, counts = self._encode(strings)
        last = len(self._known)
        first = last - len(strings)
        self.starts, self.counts = _room(self.starts, last), _room(self.counts, last)
        self._met = _room(self._met, last)
        self.ids = _room(self.ids, self._used + len(ids))
        self.counts[first:last] = counts
        self.starts[first:last] = self._used + np.cumsum(counts) - counts
        self.ids[self._used : self._used + len(ids)] = ids
        self._used += len(ids)

    def _forget(self) -> None:
        met = np.flatnonzero(self._met[1 : len(self._known)])[: self._kept // 2] + 1
        strings = list(self._known)
        self._known = _Numbers()
        self._known.update(zip((strings[i] for i in met.tolist()), range(1, len(met) + 1), strict=True))
        keep = np.concatenate([[0], met])
        counts = self.counts[keep]
        ids = ragged(self.ids, self.starts[keep], counts)
        self.counts, self.ids, self._used = counts, ids, len(ids)
        self.starts = np.cumsum(counts) - counts
        self._met = np.zeros(len(keep), bool)

    def codes(self, strings: list[str]) -> np.ndarray:
        """A number for each string, with which ``starts`` and ``counts`` are read until the next call."""
        if len(self._known) > self._kept:
            self._forget()
        known, before = self._known, len(self._known)
        codes = np.fromiter(map(known.__getitem__, strings), np.int64, len(strings))
        if known.new:
            new, known.new = known.new, []
            self._learn(new)
        self._met[codes] = True
        self._met[before:] = False
        return codes


class PieceMemory:
    """Ids of whole texts from ids of their pieces, which ``encode`` gives."""

    def __init__(self, cut: Callable[[str], list[str]], encode: Encoder, kept: int = PIECES_KEPT):
        self.cut, self.known = cut, Remembered(encode, kept)

    def _group(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pieces: list[str] = []
        ends = [0]
        for text in texts:
            if text:
                pieces += self.cut(text)
            ends.append(len(pieces))
        codes = self.known.codes(pieces)
        counts = self.known.counts[codes]
        sums = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(counts, out=sums[1:])
        at = np.array(ends)
        return codes, counts, sums[at[1:]] - sums[at[:-1]]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and the number of each; a null text is empty."""
        codes, per_piece, per_text = self._group(texts)
        return ragged(self.known.ids, self.known.starts[codes], per_piece), per_text

    def count(self, texts: list[str | None]) -> np.ndarray:
        """The number of ids of each text."""
        return self._group(texts)[2]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


def text_groups(texts: list[str | None]):
    """Ranges of texts that are encoded together."""
    return slices([len(t or "") for t in texts], CHARACTERS_AT_ONCE)


@functools.lru_cache(maxsize=2)
def tokenizer_memory(path: str) -> PieceMemory:
    """The memory of this worker for a tokenizer file of the tokenizers library."""
    keeps_blanks = len(_steps(path)) == 1
    cut = cut_byte_level if keeps_blanks else cut_at_blanks
    return PieceMemory(cut_around(list(_added(path)), cut), LibraryEncoder(path, keeps_blanks))


class LibraryEncoder:
    """Ids of many short pieces by the tokenizers library.

    The split into words is the one the tokenizer file names, the model of the
    library encodes each different word once.  A piece that is an added token has its id.
    """

    def __init__(self, path: str, keeps_blanks: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.model = tokenizer.normalizer, tokenizer.model
        self.keeps_blanks = keeps_blanks
        pattern = BYTE_LEVEL_PATTERN if keeps_blanks else _steps(path)[0]["pattern"]["Regex"]
        self.words_of = regex.compile(pattern).findall
        self.known = Remembered(self._encode_words, PIECES_KEPT)
        self.added = _added(path)

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self._encode_pieces(pieces)
        if self.added.keys().isdisjoint(pieces):
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i, piece in enumerate(pieces):
            if piece in self.added:
                parts[i], counts[i] = np.array([self.added[piece]], np.uint32), 1
        return np.concatenate(parts), counts

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.normalizer is not None:
            pieces = [p.lower() if p.isascii() else self.normalizer.normalize_str(p) for p in pieces]
        words: list[str] = []
        ends = [0]
        words_of, keeps_blanks = self.words_of, self.keeps_blanks
        for piece in pieces:
            # letters after at most one kept blank are a single word
            if (piece[1:] if keeps_blanks and piece[0] == " " else piece).isalpha():
                words.append(piece)
            else:
                words += words_of(piece)
            ends.append(len(words))
        codes = self.known.codes(words)
        counts = self.known.counts[codes]
        sums = np.concatenate([[0], np.cumsum(counts)])[ends]
        return ragged(self.known.ids, self.known.starts[codes], counts), np.diff(sums)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the byte 255 occurs in no encoded text
        joined = b"\xff".join([word.encode() for word in words]).decode("latin-1")
        ids: list[int] = []
        counts: list[int] = []
        tokenize = self.model.tokenize
        # tokens of a word are let go before those of the next are made
        for word in joined.translate(_JOINED_LETTERS).split(" "):
            found = tokenize(word)
            counts.append(len(found))
            for token in found:
                ids.append(token.id)
        return np.array(ids, np.uint32), np.array(counts, np.int64)


@functools.lru_cache(maxsize=4)
def _steps(path: str) -> list[dict]:
    """The pre-tokenizer's steps; kinds for which no safe cut is known are refused."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec["pre_tokenizer"] or {}
    steps = before.get("pretokenizers", [before])
    last = steps[-1]
    if last.get("type") == "ByteLevel" and not last["add_prefix_space"]:
        if len(steps) == 1 and last.get("use_regex", True) and spec["normalizer"] is None:
            return steps
        first = steps[0]
        if len(steps) == 2 and first.get("type") == "Split" and first["invert"]:
            kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
            if first["behavior"] == "Removed" and kinds == ["NFC", "Replace", "Lowercase"]:
                if r"\s" in first["pattern"]["Regex"] and " " not in first["pattern"]["Regex"]:
                    return steps
    raise ValueError(f"no safe cut is known for the tokenizer in {path}")


@functools.lru_cache(maxsize=4)
def _added(path: str) -> dict[str, int]:
    """Ids of the added tokens; kinds that are not matched as they are written are refused."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens") or []
    if any(t[kind] for t in tokens for kind in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens of a kind that is not known in {path}")
    return {t["content"]: t["id"] for t in tokens}


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()
