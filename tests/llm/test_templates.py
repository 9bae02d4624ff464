"""Template windows: re-parameterised items are found, others are not."""

import random
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from hitloom.llm import templates

ITEM = (
    "A train leaves the central station at 9 and travels 120 km before it meets Anna near the old bridge "
    "and then goes on for 9 hours until the end"
)
ITEMS = [(1, ITEM), (2, "short item"), (3, None), (4, ""), (5, "7 8 9 7 8 9 7 8 9 7 8 9")]
FILLER = "and some other words that stand around here in every text "


def found(spark, texts, items=ITEMS, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, words string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = templates.contaminated(docs, benchmark, **options).collect()
    return sorted((r["doc_id"], r["item_id"]) for r in rows)


def test_copies_and_changed_values(spark):
    changed = ITEM.replace("9", "11").replace("120 km", "75 miles").replace("Anna", "Peter")
    texts = [FILLER + ITEM, FILLER + changed + "\n" + FILLER, FILLER * 3, None, "", "   ", FILLER + ITEM, ITEM.upper()]
    assert found(spark, texts) == [(0, 1), (1, 1), (6, 1), (7, 1)]


def plain_template(words):
    text = regex.sub(templates._NUMBERS, templates.NUMBER, " ".join(words))
    units = "|".join(templates.UNITS)
    text = regex.sub(rf"(?i)(?<={templates.NUMBER}|{templates.NUMBER} )(?:{units})(?![\p{{L}}\p{{N}}])", templates.UNIT, text)
    text = regex.sub(r"(?<=[\p{Ll},;] )\p{Lu}[\p{Ll}'-]+", templates.NAME, text)
    return [w.strip(templates._PUNCTUATION).lower() for w in text.split(" ")]


def brute(docs, items, window, min_share, min_run, min_consistency):
    """Every window of every item against every place of every text."""
    out = set()
    for doc_id, text in docs:
        for item_id, item in items:
            ours, theirs = text.split(), item.split()
            size = min(window, len(theirs))
            hits = defaultdict(list)
            for at in range(len(theirs) - size + 1):
                part = plain_template(theirs[at : at + size])
                for start in range(len(ours) - size + 1):
                    if plain_template(ours[start : start + size]) == part:
                        hits[start - at].append((at, start, part))
            if not hits:
                continue
            matched = {at for found in hits.values() for at, _, _ in found}
            run = judged = 0
            best = (0, 1.0)
            for found in hits.values():
                ats = {at for at, _, _ in found}
                for at in ats:
                    length = next(n for n in range(1, len(ats) + 2) if at + n not in ats)
                    run = max(run, min(length + window - 1, len(theirs)))
                values = defaultdict(Counter)
                for at, start, part in found:
                    for k, word in enumerate(part):
                        if set(word) & {templates.NUMBER, templates.UNIT, templates.NAME}:
                            values[theirs[at + k]][ours[start + k]] += 1
                judged = sum(sum(c.values()) for c in values.values())
                if judged:
                    best = max(best, (judged, sum(max(c.values()) for c in values.values()) / judged))
            share = len(matched) / max(1, len(theirs) - window + 1)
            if (share >= min_share or run >= min_run) and best[1] >= min_consistency:
                out.add((doc_id, item_id, len(matched), run, round(best[1], 9)))
    return out


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_equals_brute_force(spark, monkeypatch, broadcast):
    pick = random.Random(12)
    values = ["7", "12", "1,250", "Anna", "Peter", "km", "hours", "3kg"]
    words = [f"word{chr(97 + i)}" for i in range(12)] + ["the", "of,", "and"]
    draw = lambda n: [pick.choice(values if pick.random() < 0.3 else words) for _ in range(n)]
    items = [(i, draw(pick.choice([3, 8, 15, 40, 120]))) for i in range(12)]
    docs = []
    for i in range(60):
        item = pick.choice(items)[1]
        n = pick.randrange(3, len(item) + 1)
        at = pick.randrange(len(item) - n + 1)
        swap = {v: pick.choice(values[:3]) if v in values[:3] else v for v in values}
        docs.append((i, " ".join(draw(pick.randrange(12)) + [swap.get(w, w) for w in item[at : at + n]] + draw(pick.randrange(12)))))
    items = [(i, " ".join(item)) for i, item in items]
    monkeypatch.setattr(templates, "BROADCAST_WINDOWS", broadcast)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = templates.contaminated(table, spark.createDataFrame(items, "item_id long, text string"), min_consistency=0.7).collect()
    found = {(r["doc_id"], r["item_id"], r["matched"], r["run_words"], round(r["consistency"], 9)) for r in rows}
    assert found == brute(docs, items, 8, 0.25, 20, 0.7) and len(found) == len(rows) > 20


def test_a_long_run_counts_whatever_its_share(spark):
    item = " ".join(f"term{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400))
    texts = [" ".join(item.split()[a:b]) + " " + FILLER for a, b in ((100, 180), (50, 70), (50, 69))]
    assert found(spark, texts, [(1, item)]) == [(0, 1), (1, 1)]


def test_inconsistent_values_are_no_copy(spark):
    mixed = ITEM.replace("at 9", "at 4").replace("for 9", "for 5").replace("120 km", "7 km")
    assert found(spark, [mixed], min_consistency=0.9) == []
    assert found(spark, [mixed], min_consistency=0.0) == [(0, 1)]


def test_short_items_are_one_window_and_numbers_alone_can_be_anchors(spark):
    texts = ["this is a Short item, indeed", "1 2 3 1 2 3 1 2 3 1 2 3", "short and item"]
    assert found(spark, texts) == [(0, 2), (1, 5)]


@pytest.mark.parametrize("texts, items", [([], ITEMS), (["a b c"], [])])
def test_empty_tables(spark, texts, items):
    assert found(spark, texts, items) == []


def test_filter_keeps_all_other_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, FILLER + ITEM, "a", 0), (2, None, "b", 0), (3, "x", "c", 0), (3, "x", "c", 0)], "doc_id long, text string, lang string, __text int")
    kept = templates.decontaminated(docs, spark.createDataFrame(ITEMS[:1], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r["lang"] for r in kept.collect()) == ["b", "c", "c"]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    rows = templates.benchmark_windows(docs.withColumnRenamed("doc_id", "item_id"), 8)
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.agg(F.count("*")).first()[0] == len(ITEM.split()) - 7
