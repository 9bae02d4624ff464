"""The similarity join against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from hitloom.llm import metric_join
from hitloom.llm.metric_join import Similarity


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def brute(rows, like):
    sets = {d: shingles(t, like.words) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        shared = defaultdict(int)
        for s in sets[d]:
            for e in holders[s]:
                shared[e] += 1
            holders[s].append(d)
        for e, n in shared.items():
            if 100 * n >= like.percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def corpus(seed, n=250):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["the", "OF"] * 30
    base = [[pick.choice(words) for _ in range(pick.randrange(30, 160))] for _ in range(6)]
    for d in range(n):
        kind = pick.random()
        if kind < 0.08:
            yield d, pick.choice([None, "", " \t", "a", "a b", "A B", "a\xa0b"])
        elif kind < 0.85:
            own = list(pick.choice(base))
            for _ in range(pick.choice([0, 1, 1, 2, 3, 5])):
                own[pick.randrange(len(own))] = pick.choice(words)
            yield d, " ".join(own)
        else:
            yield d, " ".join(pick.choice(["the", "of", "x"]) for _ in range(pick.randrange(1, 60)))


def found(spark, rows, like):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, point string").repartition(3)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in metric_join.components(docs, like).collect()}


@pytest.mark.parametrize("like", [Similarity(3, 90), Similarity(5, 80)])
def test_equals_brute_force(spark, like):
    rows = list(corpus(like.words))
    assert found(spark, rows, like) == brute(rows, like)


def test_large_regions_in_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "REGION_POINTS", 8)
    monkeypatch.setattr(metric_join, "BLOCK_POINTS", 16)
    rows = list(corpus(9, 150))
    assert found(spark, rows, Similarity(3, 90)) == brute(rows, Similarity(3, 90))


@pytest.mark.parametrize("fine_bins", [64, 1024])
def test_regions_of_long_texts_that_only_share_phrases(spark, monkeypatch, fine_bins):
    """A region large by bytes, without a main component; with few bins it is not divided, only dealt out."""
    monkeypatch.setattr(metric_join, "REGION_BYTES", 60_000)
    monkeypatch.setattr(metric_join, "REGION_POINTS", 12)
    monkeypatch.setattr(metric_join, "BLOCK_POINTS", 16)
    monkeypatch.setattr(metric_join, "FINE_BINS", fine_bins)
    pick, rows = random.Random(4), []
    phrases = [" ".join(f"p{pick.randrange(400)}" for _ in range(40)) for _ in range(12)]
    for d in range(60):
        words = [f"w{pick.randrange(60_000)}" for _ in range(1800)]
        for _ in range(12):
            words[pick.randrange(len(words))] = pick.choice(phrases)
        rows.append((d, " ".join(words)))
    for d in range(60, 80):  # near copies of few of them
        words = rows[pick.randrange(4)][1].split(" ")
        words[pick.randrange(len(words))] = f"changed{d}"
        rows.append((d, " ".join(words)))
    assert found(spark, rows, Similarity(5, 80)) == brute(rows, Similarity(5, 80))


def test_one_of_each_repeated_rows_missing_ids_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(7, long, "a"), (3, long, "a"), (3, long, "a"), (None, long, "a"), (4, None, "b"), (5, None, "c"), (6, "other words", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = metric_join.one_of_each(docs, Similarity(5, 80))
    assert kept.columns == docs.columns and sorted((r["doc_id"], r["lang"]) for r in kept.collect()) == [(3, "a"), (4, "b"), (5, "c"), (6, "d")]
    assert metric_join.components(docs.where("false"), Similarity(5, 80)).count() == 0


def test_texts_are_shuffled_once(spark, monkeypatch):
    plans, keep = {}, metric_join.Workspace.keep

    def recorded(work, rows, name):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return keep(work, rows, name)

    monkeypatch.setattr(metric_join.Workspace, "keep", recorded)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = " ".join(f"w{i}" for i in range(60))
        rows = [(1, text), (1, text), (2, text + " end"), (3, "other words here"), (None, text + " end")]
        found = metric_join.components(spark.createDataFrame(rows, "doc_id long, text string"), Similarity(words=3, percent=90)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in found) == [(0, 1), (1, 1), (1, 1), (2, 1), (3, 3)]
    assert "hashpartitioning(doc_id" in plans["texts"] and "hashpartitioning(region" not in plans["texts"]


def test_counts_travel_in_as_few_bytes_as_they_need(spark):
    """A point's counts go to all its regions: 64 bytes for an ordinary text, not 256; large counts are kept."""
    counts = [np.full(64, 3), np.arange(64) * 5, np.arange(64) * 900, np.arange(64) * 70_000, np.zeros(64, int)]
    coded = [metric_join.packed(own) for own in counts]
    assert [len(own) for own in coded] == [64, 128, 128, 256, 64]
    assert (metric_join.unpacked(pa.chunked_array([pa.array(coded, pa.binary())]), 64) == np.array(counts)).all()
    docs = spark.createDataFrame([(1, " ".join(map(str, range(5000)))), (2, "a b c d"), (3, None)], "doc_id long, text string")
    found = metric_join.points(docs, Similarity(words=3, percent=90)).collect()
    assert {len(row["bins"]) for row in found} == {64}
