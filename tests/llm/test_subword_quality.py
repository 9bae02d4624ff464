"""Subword quality: held-out accuracy and defined cases."""

import random
import zlib

from hitloom.llm import subword_quality as sq

SETTINGS = sq.TrainingSettings(rows_per_label=150, epochs=4)


def corpus(n):
    pick = random.Random(4)
    words = ["".join(pick.choice("abcdefgh") for _ in range(pick.randrange(2, 9))) for _ in range(600)]
    docs, labels = [], []
    for i in range(n):
        text = [pick.choice(words) for _ in range(pick.randrange(20, 120))]
        good = pick.random() < 0.7
        if not good:
            text = [w + "%%%" for w in text] if i % 2 else [text[k // 9] for k in range(len(text))]
        docs.append((i, " ".join(text), "s"))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    docs, labels = corpus(500)
    docs += [(900, None, "s"), (901, "", "s"), (None, "a", "s"), (0, docs[0][1], "s"), (902, "good words " * 20_000, "s")]
    table = spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(3)
    marks = spark.createDataFrame([*labels, (903, None, 0)], "doc_id long, quality int, toxic int")
    rows = sq.quality_scores(table, marks, 0.3, SETTINGS).collect()
    assert len(rows) == len(docs)
    by = {r["doc_id"]: r for r in rows}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in by.items() if i is not None)
    held = [i for i, r in by.items() if r["held_out"] and i is not None and i < 500]
    assert sum(by[i]["predicted"] == labels[i][1] for i in held) / len(held) > 0.95
    assert 0 <= by[900]["score"] == by[901]["score"] <= 1
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in sq.quality_scores(docs, labels).collect()] == [0.5]
    assert sq.quality_scores(docs.where("false"), labels).count() == 0
