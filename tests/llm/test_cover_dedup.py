"""Repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from hitloom.llm import cover_dedup


def brute(rows, length):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(data[i : i + length])
        runs = np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone]) if data else b""
        out[doc_id] = (len(data), int(gone.sum()), int(runs), hashlib.sha256(kept).hexdigest())
    return out


def texts(seed):
    pick = random.Random(seed)
    words = ["of", "the", "thand", "éreau", "ion", "loweischaft", "x"]
    base = [" ".join(pick.choice(words) + str(pick.randrange(10)) for _ in range(120)) for _ in range(6)]
    for i in range(50):
        kind, one = pick.random(), pick.choice(base)
        at = pick.randrange(len(one))
        if kind < 0.15:
            yield pick.choice([None, "", "short"])
        elif kind < 0.3:
            yield one
        elif kind < 0.6:
            yield one[:at] + "#" + one[at:] + pick.choice(base)[at:]
        elif kind < 0.8:
            yield pick.choice(["ab", "z", "é", "Of "]) * pick.randrange(20, 300)
        else:
            yield " ".join(pick.choice(words) for _ in range(pick.randrange(200)))


@pytest.mark.parametrize("seed, length", [(1, 100), (2, 100), (3, 101)])
def test_equals_brute_force(spark, seed, length):
    rows = [(i * 3, text) for i, text in enumerate(texts(seed))]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, start string").repartition(4)
    found = {r[0]: tuple(r)[1:] for r in cover_dedup.deduplicate(docs, length).collect()}
    assert found == brute(rows, length)


def test_a_short_line_in_many_surroundings_is_not_sorted_at_once(spark, monkeypatch):
    sort = cover_dedup.sort_bucket

    def bounded(spans, *rest):
        assert len(spans) < 40
        return sort(spans, *rest)

    monkeypatch.setattr(cover_dedup, "SPANS_PER_SORT", 20)
    monkeypatch.setattr(cover_dedup, "sort_bucket", bounded)
    pick = random.Random(8)
    own = lambda: "".join(pick.choice("abcdefgh ") for _ in range(150))
    line, passage = own()[:53], own()[:110]
    rows = [(i, own() + line + own() + (passage + own() if i % 3 == 0 else "")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r[0]: tuple(r)[1:] for r in cover_dedup.deduplicate(docs).collect()}
    assert found == brute(rows, 100) and sum(r[1] > 0 for r in found.values()) == 66


def test_very_long_texts_are_cut_without_losing_a_string(spark, monkeypatch):
    monkeypatch.setattr(cover_dedup, "RUN_BYTES", 500)
    rows = [(i, text) for i, text in enumerate(texts(5))]
    parts = [p for row in rows for p in cover_dedup.text_runs(__import__("pyarrow").array([row[1]]), 100)]
    assert max(len(p[2]) for p in parts) <= 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {r[0]: tuple(r)[1:] for r in cover_dedup.deduplicate(docs).collect()} == brute(rows, 100)


def test_repeated_rows_missing_ids_and_empty_table(spark):
    long = "abc %d " * 30 % tuple(range(30))
    docs = spark.createDataFrame([(None, long), (4, long), (4, long), (4, "x")], "doc_id long, text string")
    found = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in cover_dedup.deduplicate(docs).collect())
    assert found == [(-1, len(long), 0), (4, 1, 0), (4, len(long), len(long)), (4, len(long), len(long))]
    assert cover_dedup.deduplicate(docs.where("false")).count() == 0


def test_difference_cover():
    for period in (7, 32, 57):
        cover = cover_dedup.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
