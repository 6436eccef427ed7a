"""Packing into several context sizes against the library and by counting."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerostrata.llm import queries, tiered_packing
from aerostrata.llm.staging import run_folder
from tests.conftest import DATA, SMALL

WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_plan(histogram, tiers):
    """Every token of every rank stands in one place, and every sequence is full."""
    rows, spans = tiered_packing.plan(histogram, tiers)
    places, parts = defaultdict(list), defaultdict(list)
    for chunk, low, high, start, length, first, each, at in rows:
        for rank in range(low, high):
            sequence, offset = first + (rank - low) // each, at + (rank - low) % each * length
            places[sequence].append((offset, length))
            parts[chunk, rank].append((start, length))
    for (chunk, _), cuts in parts.items():
        end = 0
        for start, length in sorted(cuts):
            assert start == end
            end += length
        assert end == chunk
    assert len(parts) == sum(n for length, n in histogram.items() if length)
    assert sorted(places) == [s for _, first, n in spans for s in range(first, first + n)]
    for size, first, n in spans:
        for sequence in range(first, first + n):
            end = 0
            for offset, length in sorted(places[sequence]):
                assert offset == end
                end += length
            assert end == size
    return places, spans


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 64), st.integers(1, 20), max_size=25))
def test_plans_lose_nothing_and_fill_every_sequence(histogram):
    check_plan(histogram, (8, 16, 32, 64))


@pytest.mark.parametrize("histogram", [{}, {0: 3}, {1: 1}, {3000: 7}, {4096: 5}, {4095: 1, 1: 1}, {2049: 9}, {512: 8, 513: 8}])
def test_plans_of_few_lengths(histogram):
    check_plan(histogram, tiered_packing.TIERS)


def test_a_tier_takes_its_gaps_from_shorter_ones():
    places, spans = check_plan({60: 3, 4: 9, 30: 2, 2: 2}, (8, 16, 32, 64))
    assert spans[0] == (64, 0, 3) and all(sorted(places[s]) == [(0, 60), (60, 4)] for s in range(3))
    assert [sorted(places[s]) for s in (3, 4)] == [[(0, 30), (30, 2)]] * 2


def test_sizes_are_powers_of_two():
    with pytest.raises(ValueError, match="powers of two"):
        tiered_packing.plan({3: 1}, (8, 24))


def test_plans_do_not_grow_with_the_data():
    lengths = np.minimum(np.random.default_rng(0).lognormal(6, 1.2, 100_000).astype(int) + 1, 4096)
    some = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    rows, spans = tiered_packing.plan(some)
    more, _ = tiered_packing.plan({length: 1000 * n for length, n in some.items()})
    assert len(more) < 3 * len(rows) < tiered_packing.MOST_BROADCAST
    pieces = sum(r[2] - r[1] for r in rows)
    assert pieces <= len(lengths) + sum(n for _, _, n in spans)  # a cut per sequence at most


def check_pieces(rows, texts):
    """``texts`` are (id, text); rows of equal ids are compared as sets of documents."""
    library = Tokenizer.from_file(WORDS)
    tokens = defaultdict(list)
    for doc_id, text in texts:
        tokens[doc_id].append(np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length, r.context, r.step_group))
    assert set(pieces) == set(tokens)
    for doc_id, found in pieces.items():
        if len(tokens[doc_id]) == 1:
            (ids,), end = tokens[doc_id], 0
            for start, length, crc, total in sorted(found):
                assert start == end and total == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
                end += length
            assert end == len(ids)
        else:
            assert sum(p[1] for p in found) == sum(map(len, tokens[doc_id]))
    groups = defaultdict(list)
    for parts in sequences.values():
        end = 0
        for offset, length, context, _ in sorted(parts):
            assert offset == end
            end += length
        assert end == context and context & (context - 1) == 0
        assert len({p[2:] for p in parts}) == 1
        groups[parts[0][3]].append((context, sum(p[1] ** 2 for p in parts)))
    for members in groups.values():
        assert len({c for c, _ in members}) == 1 and sum(c for c, _ in members) <= tiered_packing.STEP_TOKENS
    return groups


@pytest.mark.parametrize("folder", [SMALL, DATA])
def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    groups = check_pieces(queries.op12_tiered_packing(spark, folder).collect(), docs)
    costs = defaultdict(list)
    for members in groups.values():
        costs[members[0][0]].append((len(members), sum(c for _, c in members)))
    for found in costs.values():
        full = [cost for n, cost in found if n == max(found)[0]]
        assert max(full) <= 1.5 * min(full)


def test_odd_documents(spark, tmp_path):
    texts = [(1, None), (2, ""), (3, "one"), (3, "one two"), (4, "word " * 30_000), (None, "no id"), (5, "one"), (6, "one")]
    rows = [(i, t, 1, "x") for i, t in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string, length int, sequence_id string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    check_pieces(queries.op12_tiered_packing(spark, str(tmp_path)).collect(), texts)


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    cut, placed, parted = tiered_packing.packed(none, run_folder(spark, "test"), WORDS, 2)
    assert cut.collect() == placed.collect() == tiered_packing.checksums(placed, parted).collect() == []


def test_ids_of_all_pieces(spark):
    """Pieces with their ids, joined in order, are the documents again."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    cut, placed, _ = tiered_packing.packed(docs, run_folder(spark, "test"), WORDS, 2)
    library, found = Tokenizer.from_file(WORDS), defaultdict(list)
    for r in tiered_packing.with_ids(cut, placed).collect():
        found[r.doc_id].append((r.start, bytes(r.ids)))
    for r in docs.collect():
        wanted = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert b"".join(ids for _, ids in sorted(found[r.doc_id])) == wanted
