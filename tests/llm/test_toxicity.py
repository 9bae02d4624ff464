"""The classifier chain: held-out accuracy and defined cases."""

import random

import numpy as np

from hitloom.llm import toxicity

SETTINGS = toxicity.ChainSettings(rows_per_stratum=200, features_per_category=64, steps=100)


def corpus(n, seed=1):
    pick = random.Random(seed)
    words = [f"w{pick.randrange(5000)}" for _ in range(800)]
    docs, labels = [], []
    for i in range(n):
        text = [pick.choice(words) for _ in range(pick.randrange(5, 300))]
        toxic, low = pick.random() < 0.3, pick.random() < 0.3
        for mark, bad in ((toxic, "vile"), (low, "junk")):
            if mark:
                for _ in range(3):
                    text.insert(pick.randrange(len(text)), bad + pick.choice(["en", "ung", "heit", "er"]))
        docs.append((i, " ".join(text), "x"))
        labels.append((i, int(not low), int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    docs, labels = corpus(500)
    docs += [(900, None, "x"), (901, "", "x"), (902, "vileheit viler vileung " + "w " * 60_000, "x"), (None, "w1", "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string, feature string").repartition(4)
    marks = spark.createDataFrame([*labels[:300], (903, None, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(table.select("doc_id", "text"), marks, settings=SETTINGS)
    rows = toxicity.with_probabilities(table, chain).collect()
    p = {r["doc_id"]: (r["p_low_quality"], r["p_toxic"]) for r in rows}
    assert len(rows) == len(docs) and rows[0]["feature"] == "x"
    right = [(p[i][0] >= 0.5) == (q == 0) and (p[i][1] >= 0.5) == bool(t) for i, q, t in labels[300:]]
    assert np.mean(right) > 0.97
    assert p[900] == p[901] and p[900][1] < 0.5 < p[902][1] and None in p


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "vile"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.without_toxic(docs, labels).count() == 2
    assert toxicity.without_toxic(docs.where("false"), labels).count() == 0


def test_later_models_read_out_of_fold_probabilities():
    pick = np.random.default_rng(2)
    x = (pick.random((400, 6)) < 0.5).astype(float)
    y = np.column_stack([x[:, 0], x[:, 0] * (pick.random(400) < 0.9)])
    models = toxicity.fit_chain(x, y, SETTINGS)
    assert len(models[0]) == 7 and len(models[1]) == 8 and models[1][6] > 0


def test_columns_named_like_a_probability(spark):
    docs = spark.createDataFrame([(1, "a", "mine")], "doc_id long, text string, p_toxic string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.without_toxic(docs, labels).first()["p_toxic"] == "mine"
    chain = toxicity.train(docs.select("doc_id", "text"), labels)
    assert toxicity.with_probabilities(docs, chain).first()["p_toxic"] < 0.5
