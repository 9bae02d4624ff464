"""Whitening against numpy, and the cases that have no whitening."""

import numpy as np
import pytest

from hitloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, `index` int, w string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], SCHEMA)


def by_numpy(vectors, components):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    variances, axes = np.linalg.eigh(centred.T @ centred / n)
    variances, axes = variances[::-1], axes[:, ::-1][:, :components]
    return ((n * x - total) ** 2).sum(axis=1), centred @ axes / np.sqrt(variances[:components]), variances / variances.sum()


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)


@pytest.mark.parametrize("dimensions, components", [(7, 4), (3, 8)])
def test_equals_numpy(spark, small_blocks, dimensions, components):
    pick = np.random.default_rng(5)
    vectors = (pick.normal(size=(90, dimensions)) * np.arange(1, dimensions + 1)).round(3).tolist()
    found = whitening.whiten(table(spark, enumerate(vectors)).repartition(5), components).toPandas()
    kept = min(dimensions, components)
    found = found.sort_values(["vec_id", "component"])
    deviation, whitened, explained = by_numpy(vectors, kept)
    own = found["whitened"].to_numpy().reshape(90, kept)
    signs = np.sign((own * whitened).sum(axis=0))
    assert np.abs(own * signs - whitened).max() < 1e-9
    assert found["deviation"].tolist() == np.repeat(deviation, kept).tolist()
    assert np.abs(found["explained"].to_numpy()[:kept] - explained[:kept]).max() < 1e-12
    assert (found["n"] == 90).all() and found["identity_error"].nunique() == 1 and found["identity_error"].max() < 1e-9
    assert found["component"].tolist() == list(range(1, kept + 1)) * 90


def test_unusable_vectors_are_dropped_and_rows_repeat(spark):
    good = [[1.0, 0.0], [0.0, 2.0], [3.0, 1.0]]
    vectors = list(enumerate(good)) + [(2, good[2]), (7, None), (8, []), (9, [1.0, None]), (10, [float("nan"), 1.0])]
    vectors += [(11, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    found = whitening.whiten(table(spark, vectors)).toPandas()
    assert sorted(found["vec_id"].fillna(-1)) == [-1, -1, 0, 0, 1, 1, 2, 2, 2, 2] and (found["n"] == 5).all()
    deviation, _, _ = by_numpy([*good, good[2], [1.0, 1.0]], 2)
    assert sorted(found["deviation"]) == sorted(np.repeat(deviation, 2))


def test_lengths_are_whitened_apart(spark):
    vectors = [(i, [float(i), float(i * i), 1.0][: 2 + i % 2]) for i in range(20)]
    found = whitening.whiten(table(spark, vectors)).toPandas()
    assert (found["n"] == 10).all() and found["vec_id"].nunique() == 20 and found["component"].max() == 2


@pytest.mark.parametrize("vectors", [[], [(1, [1.0, 2.0])], [(1, [3.0]), (2, [3.0])], [(1, None)]])
def test_nothing_to_whiten(spark, vectors):
    found = whitening.whiten(table(spark, vectors))
    assert found.count() == 0 and found.columns == [c.split(" ")[0] for c in whitening.WHITENED.split(", ")]
