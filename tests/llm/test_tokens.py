"""Token counts, token files, byte pieces and packing against the libraries and brute force."""

from __future__ import annotations

import base64
import hashlib
import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerostrata.llm import byte_pieces, length_histogram, packing, token_files
from aerostrata.llm.staging import run_folder, stored
from aerostrata.llm.word_memory import LibraryEncoder, PieceMemory, cut_at_blanks, cut_byte_level, tokenizer_memory

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

ODD = [
    "", None, " a  b", "a\n\n b\t c\r\n", "x \n y", "  ", "\n", "don't 's  it's  x　y", "a\0b c",
    "!\x1c! ?\x1c ", "é ́x", "<|endoftext|> <|endoftext|>", "İstanbul ΣΑΣ", "日本語 テスト\n\n\n",
    "🎉 🎉🎉", "a   b", "word, word. word\nword", "x" * 5000, "tab\t\ttab \t x", "1 22  333 ½ ٣",
]
TEXTS = st.text(st.sampled_from("ab'sT .,\n\t é1!日́\x1c"), max_size=40)


@pytest.fixture(scope="module")
def libraries():
    return {path: Tokenizer.from_file(path) for path in (BYTES, WORDS)}


@pytest.fixture(scope="module")
def by_rank():
    lines = [line.split() for line in open(RANKS, "rb")]
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces_of(memory: PieceMemory, texts: list) -> list[list[int]]:
    ids, counts = memory.encode(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_piece_memory_equals_the_library(libraries, path):
    found = pieces_of(tokenizer_memory(path), ODD)
    assert found == [libraries[path].encode(t or "", add_special_tokens=False).ids for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_piece_memory_on_any_text(libraries, by_rank, texts):
    for path in (BYTES, WORDS):
        wanted = [libraries[path].encode(t, add_special_tokens=False).ids for t in texts]
        assert pieces_of(tokenizer_memory(path), texts) == wanted
    found = pieces_of(byte_pieces._memory(RANKS, public_tokenizers.PATTERN), texts)
    assert found == [by_rank.encode_ordinary(t) for t in texts]


def test_a_full_memory_changes_nothing(libraries):
    memory = PieceMemory(cut_byte_level, LibraryEncoder(BYTES, True), kept=5)
    texts = ["one two three four five six", "seven eight one two", "one nine ten eleven"] * 3
    wanted = [libraries[BYTES].encode(t, add_special_tokens=False).ids for t in texts]
    assert [pieces_of(memory, [t])[0] for t in texts] == wanted


def test_cuts_keep_every_character():
    for text in filter(None, ODD):
        assert "".join(cut_byte_level(text)).replace("\0", "") == text.replace("\0", "")
        assert "".join(cut_at_blanks(text)) == text.replace(" ", "").replace("\n", "")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=2, max_size=60), st.integers(6, 12))
def test_code_lengths(counts, longest):
    lengths = token_files.code_lengths(np.array(counts), longest).astype(int)
    assert lengths.max() <= longest
    assert sum(2.0 ** -length for length in lengths) == 1
    unlimited = token_files.code_lengths(np.array(counts), 60).astype(int)
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert (unlimited * counts).sum() == cost <= (lengths * counts).sum()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=700))
def test_bits_round_trip(ids):
    ids = np.array(ids)
    counts = np.bincount(ids)
    lengths = np.zeros(len(counts), np.uint8)
    lengths[counts > 0] = token_files.code_lengths(counts[counts > 0], 18)
    codes, bits = token_files.canonical_codes(lengths), lengths[ids].astype(np.int64)
    at = np.cumsum(bits) - bits
    payload = token_files.pack_bits(codes[ids], bits, at, int(bits.sum() + 7) // 8)
    table, longest = token_files.decoding_table(lengths)
    starts = at[:: token_files.MARK_EVERY]
    sizes = np.minimum(token_files.MARK_EVERY, len(ids) - np.arange(len(starts)) * token_files.MARK_EVERY)
    assert (token_files.unpack_ids(payload, starts, sizes, table, longest) == ids).all()


ROWS = [
    (5, "hello world"), (None, "no id"), (3, None), (5, "hello world"), (1, ""),
    (2, "x\n\n y  z" * 50), (7, "long word " * 3000), (-4, "odd 🎉"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "clash") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int, uid string").repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def test_token_file_round_trip(spark, docs, libraries):
    file = token_files.write(docs, run_folder(spark, "test"), BYTES, end_id=2)
    rows = token_files.read(spark, file).orderBy("start").collect()
    ids = lambda t: libraries[BYTES].encode(t or "", add_special_tokens=False).ids + [2]
    wanted = sorted(((i, ids(t)) for i, t in ROWS), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows] == wanted
    assert [r.start for r in rows] == [0, *np.cumsum([len(w) for _, w in wanted])[:-1].tolist()]
    assert [r.n_tokens for r in rows] == [len(w) for _, w in wanted]


def test_token_file_without_rows(spark, no_docs):
    file = token_files.write(no_docs, run_folder(spark, "test"), BYTES, end_id=2)
    assert token_files.read(spark, file).collect() == []


def test_small_blocks_and_many_ranges(spark, docs, monkeypatch):
    """Results do not depend on how a file is cut."""
    whole = token_files.read(spark, token_files.write(docs, run_folder(spark, "test"), BYTES, 2))
    monkeypatch.setattr(token_files, "PART_BYTES", 64)
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 16)
    cut = token_files.read(spark, token_files.write(docs, run_folder(spark, "test"), BYTES, 2))
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_byte_pieces(docs, by_rank):
    encoded = byte_pieces.encode(docs, RANKS, public_tokenizers.PATTERN)
    rows = byte_pieces.decode(encoded, RANKS).collect()
    found = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in rows)
    wanted = Counter()
    for i, t in ROWS:
        ids = by_rank.encode_ordinary(t or "")
        wanted[i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()] += 1
    assert found == wanted


def test_byte_pieces_without_rows(no_docs):
    assert byte_pieces.decode(byte_pieces.encode(no_docs, RANKS, public_tokenizers.PATTERN), RANKS).collect() == []


def test_histogram_answers(docs, no_docs, libraries):
    lengths = sorted(len(libraries[BYTES].encode(t or "", add_special_tokens=False).ids) for _, t in ROWS)
    counted = length_histogram.histogram(docs, BYTES)
    sums = length_histogram.suffix_sums(counted)
    for r in sums.collect():
        longer = [n for n in lengths if n > r.length]
        assert r.n_docs == lengths.count(r.length)
        assert (r.docs_longer, r.tokens_longer) == (len(longer), sum(longer))
        assert (r.docs_up_to, r.tokens_up_to) == (len(lengths) - len(longer), sum(lengths) - sum(longer))
        assert r.truncated_tokens == sum(min(n, r.length) for n in lengths)
    for limit in (0, 3, 100, 10**6):
        assert length_histogram.truncated_total(counted, limit).first()[0] == sum(min(n, limit) for n in lengths)
    for share in (0.1, 0.5, 0.9, 1.0):
        wanted = next(n for n in lengths if sum(m <= n for m in lengths) >= share * len(lengths))
        assert length_histogram.quantile(sums, share).first()[0] == wanted
    none = length_histogram.histogram(no_docs, BYTES)
    assert length_histogram.suffix_sums(none).collect() == []
    assert length_histogram.truncated_total(none, 5).first()[0] == 0


def laid_out(histogram: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int]]]:
    """Sequences of a plan; every rank of every length must have one place."""
    used, bins = Counter(), defaultdict(list)
    for length, low, high, first, per_bin, at in packing.plan(histogram, capacity):
        assert used[length] == low
        used[length] = high
        for rank in range(high - low):
            bins[first + rank // per_bin].append((at + rank % per_bin * length, length))
    assert +used == +Counter(histogram)
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(length > capacity // 3 for _, length in places) <= 2
    return bins


def test_plans_are_whole_and_tight():
    draw = random.Random(1)
    for capacity in (1, 2, 3, 5, 10, 64, 100):
        for _ in range(100):
            lengths = draw.sample(range(1, capacity + 1), draw.randint(0, min(capacity, 12)))
            laid_out({n: draw.choice([1, 2, 3, 7, 50]) for n in lengths}, capacity)
    even = {n: draw.randint(1, 200) for n in range(1, 2049)}
    total = sum(n * k for n, k in even.items())
    assert len(laid_out(even, 2048)) < 1.01 * total / 2048


def test_plan_is_bounded_by_the_capacity():
    small = packing.plan({n: 1000 for n in range(1, 65)}, 64)
    large = packing.plan({n: 10**9 for n in range(1, 65)}, 64)
    assert len(large) <= len(small) + 64


def test_packing_documents(spark, docs, no_docs, libraries):
    cut, placed = packing.packed(docs, run_folder(spark, "test"), WORDS, 128, end_id=0)
    placed = stored(placed, run_folder(spark, "test"))
    wanted = Counter()
    for i, t in ROWS:
        ids = libraries[WORDS].encode(t or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 128)):
            wanted[i, n, at, np.array(ids[at : at + 128], "<u4").tobytes()] += 1
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in cut.collect()) == wanted
    by_sequence = defaultdict(list)
    for r in placed.collect():
        by_sequence[r.sequence_id].append((r.offset, r.length))
    whole = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(cut, placed).collect()}
    for sequence, places in by_sequence.items():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert whole[sequence] == end <= 128
    _, none = packing.packed(no_docs, run_folder(spark, "test"), WORDS, 128, end_id=0)
    assert none.collect() == []


def test_digests_are_those_of_the_ids(spark, docs, libraries):
    """The digest columns of the queries, recomputed in Python."""
    from pyspark.sql import functions as F

    row = byte_pieces.encode(docs, RANKS, public_tokenizers.PATTERN).select(
        "ids", F.crc32("ids").alias("crc"), F.sha2("ids", 256).alias("sha")
    ).first()
    assert row.crc == zlib.crc32(bytes(row.ids)) and row.sha == hashlib.sha256(bytes(row.ids)).hexdigest()


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_added_tokens_are_single_ids(path):
    """Texts with added tokens against the library as it is."""
    library = Tokenizer.from_file(path)
    draw = random.Random(4)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", " ", "\n", "a", "é", "İ", "word", "  ", "x\0"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", *("".join(draw.choices(parts, k=8)) for _ in range(300))]
    assert pieces_of(tokenizer_memory(path), texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert tokenizer_memory(path).count(texts).tolist() == [len(p) for p in pieces_of(tokenizer_memory(path), texts)]


def test_tokens_of_a_word_are_let_go_before_the_next_word():
    """The objects of all new words of a group, held at once, do not stay in a core's cache."""
    encoder = LibraryEncoder(BYTES, True)
    words = [" one", "two", " déjà", "日本", "7", " \n"] * 50
    ids, counts = encoder._encode_words(words)
    real, alive, most = encoder.model, set(), []

    class Token:
        def __init__(self, number):
            self.id = number
            alive.add(id(self))

        def __del__(self):
            alive.discard(id(self))

    class Model:
        def tokenize(self, word):
            most.append(len(alive))
            return [Token(token.id) for token in real.tokenize(word)]

    encoder.model = Model()
    again, counted = encoder._encode_words(words)
    assert again.tolist() == ids.tolist() and counted.tolist() == counts.tolist()
    assert len(most) == 300 and max(most) <= max(counts)
