"""Nearest neighbours against brute force, and defined cases."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from hitloom.llm import projections

SCHEMA = "vec_id long, embedding array<float>, score string"
SMALL = projections.SearchSettings(neighbours=5, block=100, leaf=16, sample=300)


def brute(rows, wanted, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for i, q in zip(ids, x):
        if wanted(i):
            score = (x * q).sum(axis=1)
            own = ids != i
            out[i] = ids[own][np.lexsort((ids[own], -score[own]))[:k]].tolist()
    return out


def search(spark, rows, settings=SMALL):
    table = spark.createDataFrame(rows, SCHEMA)
    found = projections.nearest(table, F.col("vec_id") % 20 == 0, settings).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("unit", [True, False])
def test_recall(spark, unit):
    pick = np.random.default_rng(5)
    centres = pick.standard_normal((6, 24))
    x = centres[pick.integers(0, 6, 600)] + 0.5 * pick.standard_normal((600, 24))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x
    rows = [(i, [float(v) for v in row], "s") for i, row in enumerate(x)]
    found, expected = search(spark, rows), brute(rows, lambda i: i % 20 == 0, 5)
    assert found.keys() == expected.keys() and all(len(v) == 5 for v in found.values())
    assert np.mean([len(set(found[q]) & set(expected[q])) / 5 for q in expected]) >= 0.9


def test_ties_bad_vectors_and_few_candidates(spark):
    bad = [(20, None, "s"), (40, [0.0, 0.0], "s"), (7, [float("nan"), 1.0], "s"), (8, [None, 1.0], "s"), (9, [1.0], "s"), (None, [1.0, 1.0], "s")]
    same = [(i, [1.0, 2.0], "s") for i in (60, 3, 1, 80, 2)]
    assert search(spark, [*bad, *same]) == {60: [1, 2, 3, 80], 80: [1, 2, 3, 60]}
    assert search(spark, bad[:2]) == {}


def test_chi_square_bound():
    assert abs(projections.chi_square_bound(8, 0.95) - 15.507) < 0.01


def test_cells_in_rounds_blocks_and_chunks(spark):
    pick = np.random.default_rng(8)
    x = pick.standard_normal((900, 12))
    x[300:600] = x[300]  # equal vectors fill blocks of one cell
    rows = [(i, [float(v) for v in row], "s") for i, row in enumerate(x)]
    settings = projections.SearchSettings(neighbours=5, block=50, chunk=7, leaf=16, sample=300, rounds=(2, 3))
    found, expected = search(spark, rows, settings), brute(rows, lambda i: i % 20 == 0, 5)
    assert found.keys() == expected.keys() and all(len(v) == 5 for v in found.values())
    assert np.mean([len(set(found[q]) & set(expected[q])) / 5 for q in expected]) >= 0.9


def test_each_dimension_is_searched_by_itself(spark):
    short = [(i, [1.0, float(i)], "s") for i in range(40)]
    long = [(i, [1.0, 0.0, float(i % 7)], "s") for i in range(100, 141)]
    found = search(spark, [*short, *long, (200, [1.0] * 9, "s")])
    expected = brute(short, lambda i: i % 20 == 0, 5) | brute(long, lambda i: i % 20 == 0, 5)
    assert found == expected


def test_different_queries_of_one_id(spark):
    rows = [(20, [2.0, 0.0], "s"), (20, [0.0, 2.0], "s"), (1, [3.0, 0.0], "s"), (2, [0.0, 4.0], "s")]
    assert search(spark, rows) == {20: [2, 1]}
    table = spark.createDataFrame(rows, SCHEMA)
    scores = projections.nearest(table, F.col("vec_id") % 20 == 0, SMALL).orderBy("rank").collect()
    assert [r["score"] for r in scores] == [8.0, 0.0]


def test_an_empty_table(spark):
    assert search(spark, []) == {}


def test_the_point_test_spares_verifications():
    pick = np.random.default_rng(4)
    centres = 3 * pick.standard_normal((20, 32))
    x = centres[pick.integers(0, 20, 2000)] + 0.3 * pick.standard_normal((2000, 32))
    settings = projections.SearchSettings(neighbours=10)
    space = projections.Space(32, float((x**2).sum(axis=1).max()), settings)
    ids, asked = np.arange(2000), np.arange(0, 2000, 40)
    q_ids, found, _, verified = projections.search_block(space, ids, x, asked, x[asked], np.full(50, -np.inf))
    hits = 0
    for i in asked:
        score = (x * x[i]).sum(axis=1)
        score[i] = -np.inf
        hits += len(set(np.argsort(-score)[:10]) & set(found[q_ids == i]))
    assert hits >= 0.9 * 500 and verified < 0.5 * 2000 * 50


def test_the_queries_of_a_step_are_searched_together(monkeypatch):
    """The number of merges depends on the leaves, not on the queries."""
    pick = np.random.default_rng(6)
    x = pick.standard_normal((1000, 16))
    settings = projections.SearchSettings(neighbours=10, leaf=64)
    space = projections.Space(16, float((x**2).sum(axis=1).max()), settings)
    merges, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: merges.append(1) or lexsort(keys))
    found = {}
    for n in (20, 200):
        merges.clear()
        asked = np.arange(n)
        q_ids, ids, scores, _ = projections.search_block(space, np.arange(1000), x, asked, x[asked], np.full(n, -np.inf))
        assert 0 < len(merges) <= 16 * 3  # leaves, parts of a leaf
        assert (scores == (x[ids] * x[q_ids]).sum(axis=1)).all() and (np.bincount(q_ids) == 10).all()
        found[n] = set(zip(q_ids[q_ids < 20].tolist(), ids[q_ids < 20].tolist()))
    assert found[20] == found[200]
