"""Nearest neighbours against all inner products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerostrata.llm import neighbours
from aerostrata.llm.staging import run_folder, stored
from tests.conftest import DATA


def exact(ids, vectors, query, k):
    scores = vectors @ vectors[query]
    order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[query]][:k]
    return [(int(ids[j]), scores[j]) for j in order]


def found(spark, rows, k, dim, **more):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int, list string")
    out = neighbours.search(frame, F.col("vec_id") % 20 == 0, run_folder(spark, "test"), k, dim, **more)
    by_query = {}
    for r in out.orderBy("query_id", "rank").collect():
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return by_query


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id")
    rows = table.collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    out = neighbours.search(table, F.col("vec_id") % 20 == 0, run_folder(spark, "test"))
    by_query = {}
    for r in out.collect():
        by_query.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(by_query) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for query, scores in by_query.items():
        wanted = dict(exact(ids, vectors, int(np.flatnonzero(ids == query)[0]), 20))
        hits += len(wanted.keys() & scores.keys())
        assert len(scores) == 20
        assert all(abs(wanted[i] - scores[i]) < 1e-9 for i in wanted.keys() & scores.keys())
    assert hits / (20 * len(by_query)) >= 0.9


def test_clustered_vectors_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(12, 8)) * 3
    vectors = centres[draw.integers(0, 12, 400)] + draw.normal(size=(400, 8)) * 0.3
    rows = [(i, v.tolist(), 0, "") for i, v in enumerate(vectors)]
    out = found(spark, rows, 5, 8, lists=16, ratio=2.0)
    hits = 0
    for i in range(0, 400, 20):
        assert [rank for rank, _, _ in out[i]] == [1, 2, 3, 4, 5]
        hits += len({j for j, _ in exact(np.arange(400), vectors, i, 5)} & {j for _, j, _ in out[i]})
    assert hits >= 0.9 * 5 * 20


@pytest.mark.parametrize("n", [50_000, 200_000])
def test_clustered_vectors_read_few_lists(spark, n):
    """Recall beside the share of all pairs that were scored, copies included."""
    draw, dim, k = np.random.default_rng(n), 32, 20
    centres = draw.normal(size=(n // 250, dim))
    vectors = centres[draw.integers(0, len(centres), n)] + 0.6 * draw.normal(size=(n, dim))
    ids = np.arange(n)
    table = pa.table({"vec_id": ids, "embedding": pa.array(list(vectors), pa.list_(pa.float64()))})
    folder = run_folder(spark, "test")
    stored(spark.createDataFrame(table), f"{folder}/given")
    given = spark.read.parquet(f"{folder}/given")
    out = neighbours.search(given, F.col("vec_id") % 20 == 0, folder, k, dim)
    rows = out.where("query_id % 1000 = 0").collect()
    hits = 0
    for query in range(0, n, 1000):
        wanted = {i for i, _ in exact(ids, vectors, query, k)}
        hits += len(wanted & {r.vec_id for r in rows if r.query_id == query})
    assert hits / (k * len(range(0, n, 1000))) >= 0.9
    held = spark.read.parquet(f"{folder}/lists").groupBy("list").agg(F.count("*").alias("n"))
    probes = spark.read.parquet(f"{folder}/probes")
    scored = probes.join(held, "list").agg(F.sum("n")).first()[0]
    assert scored <= 0.15 * n * (n // 20)
    total, lists = held.agg(F.sum("n"), F.count("*")).first()
    assert n < total <= 1.4 * n and lists == neighbours.lists_for(n) == {50_000: 64, 200_000: 256}[n]


def test_pruning_follows_the_sample():
    """Wide reach without clusters, narrow with them; copies bounded; equal vectors leave no ratio of nothing."""
    draw = np.random.default_rng(1)
    loose = draw.normal(size=(4000, 16))
    tight = draw.normal(size=(40, 16))[draw.integers(0, 40, 4000)] + 0.1 * draw.normal(size=(4000, 16))
    reaches = {}
    for name, v in {"loose": loose, "tight": tight, "equal": np.repeat(loose[:64], 40, axis=0)}.items():
        fitted = neighbours.fit(v, np.sqrt((v**2).sum(axis=1)).max(), 64)
        reach = reaches[name] = neighbours.pruning(v, fitted, 20)
        assert np.isfinite(reach.ratio) and 1 <= reach.ratio and reach.boundary <= neighbours.WIDEST
        _, chosen = neighbours.homes(neighbours._distances(fitted.lifted(v), fitted.points), reach.boundary)
        assert chosen[:, 0].all()
        assert name == "equal" or 1 <= chosen.sum() / len(v) <= neighbours.COPIES + 0.01
    assert reaches["tight"].ratio < reaches["loose"].ratio


def test_odd_rows(spark):
    """Copies, ties, repeated rows and vectors that take no part."""
    base = [1.0, 2.0, 3.0]
    rows = [(i, base, 1, "a") for i in range(40, 0, -1)] + [(40, base, 1, "a")]
    rows += [
        (60, None, 1, ""), (80, [0.0, 0.0, 0.0], 1, ""), (100, [1.0, None, 2.0], 1, ""),
        (120, [1.0, float("nan"), 2.0], 1, ""), (140, [float("inf"), 1.0, 1.0], 1, ""),
        (None, base, 1, ""), (160, [1.0, 2.0], 1, ""), (180, [-1.0, 0.5, 0.0], 1, ""),
    ]
    out = found(spark, rows, 3, 3)
    assert set(out) == {20, 40, 180}
    assert out[20] == [(1, 1, 14.0), (2, 2, 14.0), (3, 3, 14.0)]
    assert out[180] == [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0)]


def test_fewer_candidates_than_asked_for(spark):
    out = found(spark, [(0, [1.0, 0.0], 1, ""), (1, [0.5, 0.5], 1, ""), (2, [-1.0, 0.0], 1, "")], 20, 2)
    assert out == {0: [(1, 1, 0.5), (2, 2, -1.0)]}


@pytest.mark.parametrize("rows", [[], [(20, None, 1, "")]])
def test_no_usable_rows(spark, rows):
    assert found(spark, rows, 5, 2) == {}


def test_parts_of_a_fit_are_even():
    points = np.random.default_rng(0).normal(size=(1000, 4))
    fitted = neighbours.fit(points, np.sqrt((points**2).sum(axis=1)).max(), 32)
    assert len(fitted.points) == 32
    reached, todo = {0}, [0]
    while todo:
        new = set(fitted.neighbours[todo.pop()].tolist()) - reached
        reached |= new
        todo += new
    assert len(reached) == 32
