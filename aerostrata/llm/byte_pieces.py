"""Byte-level BPE with a sentencepiece model made directly from ranks.

The vocabulary is a list of byte strings by rank.  Bytes are shown as letters, one per
byte, and each entry becomes a piece with its rank as id and the negative rank as
score, so merging the best-scored pair is merging the pair of lowest rank.
The model has no normalization and no white-space rules; texts are split by the pattern
first and every match is encoded on its own, a match that is an entry itself at once.
Decoding maps ids back to their byte strings.

Defined cases: a null text is empty; document ids may be null or repeat, every row keeps its own;
repeated rows stay; a text of any length is cut by the pattern first, so only a single match is ever encoded
at once; ties between equal merges go to the leftmost, as ranks are all different; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import base64
import functools
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.staging import binary_column, map_arrow, ragged, slices
from aerostrata.llm.word_memory import BYTE_LETTERS, PieceMemory, cut_byte_level, text_groups

_NORMAL, _UNKNOWN, _BPE = 1, 2, 2
#: Words kept beside the pieces; a list of ids is far larger than its text.
WORDS_KEPT = 100_000


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer message: bytes, whole number or float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def shown(data: bytes) -> str:
    return data.decode("latin-1").translate(BYTE_LETTERS)


def read_ranks(path: str) -> list[bytes]:
    """Byte strings by rank from a rank file (base64 and rank per line)."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    entries = {int(rank): base64.b64decode(data) for data, rank in pairs}
    if sorted(entries) != list(range(len(entries))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [entries[rank] for rank in range(len(entries))]


def serialized_model(vocabulary: list[bytes]) -> bytes:
    """A sentencepiece BPE model; its unknown piece comes last and is never needed."""
    pieces = [
        _field(1, shown(data).encode()) + _field(2, float(-rank)) + _field(3, _NORMAL)
        for rank, data in enumerate(vocabulary)
    ]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, _UNKNOWN))
    trainer = _field(3, _BPE) + _field(4, len(pieces)) + _field(40, len(vocabulary))
    trainer += b"".join(_field(number, (1 << 64) - 1) for number in (41, 42, 43))  # no control pieces
    normalizer = _field(1, b"identity") + b"".join(_field(number, 0) for number in (3, 4, 5))
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteEncoder:
    """Ids of pieces of text: split by the pattern, each match by the model."""

    def __init__(self, vocabulary: list[bytes], pattern: str):
        import regex
        import sentencepiece

        if {bytes([b]) for b in range(256)} - set(vocabulary):
            raise ValueError("every single byte must be in the vocabulary")
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialized_model(vocabulary))
        self.matches = regex.compile(pattern).findall
        self.entries = {shown(data): [rank] for rank, data in enumerate(vocabulary)}
        self.known: dict[str, list[int]] = {}

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        known = self.known
        split = [self.matches(piece) for piece in pieces]
        new = list({word for words in split for word in words}.difference(known))
        letters = [shown(word.encode()) for word in new]
        for word, text in zip(new, letters, strict=True):
            if text in self.entries:
                known[word] = self.entries[text]
        merged = [(word, text) for word, text in zip(new, letters, strict=True) if word not in known]
        encoded = self.model.encode([text for _, text in merged], num_threads=1) if merged else []
        known.update(zip((word for word, _ in merged), encoded, strict=True))
        ids: list[int] = []
        counts = np.empty(len(pieces), np.int64)
        for i, words in enumerate(split):
            before = len(ids)
            for word in words:
                ids += known[word]
            counts[i] = len(ids) - before
        return np.array(ids, np.uint32), counts


@functools.lru_cache(maxsize=2)
def _memory(path: str, pattern: str) -> PieceMemory:
    return PieceMemory(cut_byte_level, ByteEncoder(read_ranks(path), pattern), kept=400_000)


@functools.lru_cache(maxsize=2)
def _byte_strings(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vocabulary = read_ranks(path)
    sizes = np.array([len(data) for data in vocabulary])
    return np.frombuffer(b"".join(vocabulary), np.uint8), np.cumsum(sizes) - sizes, sizes


def encode(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian, 32 bits) of every text.

    ``pattern`` must start a new match at a blank or line end that follows a
    character other than white space.
    """

    def run(batches):
        memory = _memory(ranks, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in text_groups(texts):
                ids, counts = memory.encode(texts[i:j])
                columns = [batch.column(0)[i:j], pa.array(counts), binary_column(ids.astype("<u4"), counts * 4)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids"])

    chosen = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return map_arrow(chosen, run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the bytes that the ids stand for."""

    def run(batches):
        data, starts, sizes = _byte_strings(ranks)
        for whole in batches:
            for i, j in slices(whole.column(1).to_pylist(), 1_000_000):
                batch = whole.slice(i, j - i)
                counts = batch.column(1).to_numpy()
                ids = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u4")
                ends = np.concatenate([[0], np.cumsum(sizes[ids])])
                at = np.concatenate([[0], np.cumsum(counts)])
                decoded = ragged(data, starts[ids], sizes[ids])
                columns = [*batch.columns, binary_column(decoded, ends[at[1:]] - ends[at[:-1]])]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"])

    chosen = encoded.select("doc_id", "n_tokens", "ids")
    return map_arrow(chosen, run, "doc_id long, n_tokens long, ids binary, decoded binary")
