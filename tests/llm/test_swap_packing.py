"""Packing: pieces are right, sequences are full, searching improves on best fit."""

import numpy as np
import public_tokenizers
import pytest

from hitloom.llm import swap_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_valid_and_no_worse_than_best_fit(seed):
    pick = np.random.default_rng(seed)
    sizes = pick.integers(1, 101, 300)
    bins = swap_packing.pack_sizes(sizes, 100)
    assert np.bincount(bins, weights=sizes).max() <= 100 and set(bins) == set(range(bins.max() + 1))
    assert bins.max() + 1 <= len(set(swap_packing.best_fit(sizes, 100)))


def test_swaps_empty_bins_that_best_fit_leaves():
    saved = 0
    for seed in range(60):
        sizes = np.random.default_rng(seed).integers(15, 60, 40)
        saved += len(set(swap_packing.best_fit(sizes, 100))) - swap_packing.pack_sizes(sizes, 100).max() - 1
    assert saved > 0
    start = np.array([0, 0, 1, 1, 2, 2])
    search = swap_packing.LocalSearch(np.array([60, 30, 50, 40, 10, 10]), start.copy(), 100, 100)
    before = (search.fill**2).sum()
    search.run()
    assert (search.fill**2).sum() > before


@pytest.mark.parametrize("group_size", [7, 10_000])
def test_all_pieces_once_and_gapless(spark, group_size):
    rows = [(i % 40, "word " * (i * 7 % 90), "x") for i in range(60)] + [(70, None, "x"), (71, "", "x"), (None, "a b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bin string")
    packed = swap_packing.pack(docs, PATH, 0, 32, group_size).toPandas().sort_values(["sequence_id", "offset"])
    by = packed.groupby("sequence_id")["length"]
    assert (by.cumsum() - packed["length"] == packed["offset"]).all() and by.sum().max() <= 32
    pieces = packed.sort_values(["row", "piece"]).groupby("row")
    assert len(pieces) == len(rows)
    for _, own in pieces:
        assert own["piece"].tolist() == list(range(len(own))) and (own["length"].iloc[1:] == 32).all()
        assert own["start"].tolist() == (own["length"].cumsum() - own["length"]).tolist()


def test_groups_larger_than_the_average_have_sequences_of_their_own(spark):
    docs = spark.createDataFrame([(i, "word " * 20) for i in range(60)], "doc_id long, text string")
    packed = swap_packing.pack(docs, PATH, 0, 32, group_size=3).toPandas()
    assert packed["length"].min() > 16 and packed["sequence_id"].nunique() == len(packed) == 60
    assert (packed["offset"] == 0).all()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert swap_packing.pack(docs, PATH, 0).count() == 0
