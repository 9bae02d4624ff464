"""Boilerplate lines against plain counting."""

import random
from collections import defaultdict

from hitloom.llm import site_spread

SCHEMA = "doc_id long, text string, source string, line string"


def brute(rows, min_sites, max_shared):
    own = {text: {x for x in text.split("\n") if x.strip(" ")} for _, text, _, _ in rows if text is not None}

    def widespread(texts):
        sites = defaultdict(set)
        for _, text, source, _ in rows:
            for line in own[text] if text in texts else ():
                sites[line].add(source)
        return {x for x, s in sites.items() if len(s - {None}) >= min_sites}

    wide = widespread(own)
    length = lambda lines: sum(map(len, lines))
    bad = widespread({t for t, lines in own.items() if length(lines & wide) <= max_shared * length(lines)}) & wide
    return [None if t is None else "\n".join(x for x in t.split("\n") if x not in bad) for _, t, _, _ in rows]


def test_equals_plain_counting_and_keeps_copied_documents(spark):
    pick = random.Random(6)
    rows = []
    for i in range(300):
        lines = [f"own line {pick.randrange(4000)}" for _ in range(pick.randrange(1, 6))]
        for k in range(4):  # lines spread over 3, 6, 9 and 12 of the sites
            if pick.random() < 0.4 and i % 12 < 3 * (k + 1):
                lines.insert(pick.randrange(len(lines) + 1), f"spread {k}")
        rows.append((i, "\n".join(lines), f"s{i % 12}", "x"))
    rows += [(400 + i, "copied one\ncopied two\ncopied three", f"s{i % 12}", "x") for i in range(40)]
    rows += [(500, None, "s1", "x"), (501, "", "s1", "x"), (502, "spread 3", None, "x"), (502, "spread 3", None, "x"), (503, " \n \n", "s1", "x")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    cleaned = site_spread.remove_boilerplate(table, min_sites=8)
    assert cleaned.columns == [*table.columns, "n_lines", "n_removed_lines"]
    expected = sorted(zip((r[0] for r in rows), brute(rows, 8, 0.5)), key=repr)
    found = cleaned.collect()
    assert sorted(((r["doc_id"], r["text"]) for r in found), key=repr) == expected
    assert sum(r["n_removed_lines"] for r in found) > 50
    assert [r["text"] for r in found if r["doc_id"] == 410] == ["copied one\ncopied two\ncopied three"]


def test_blocks_go_and_copies_do_not_shield_them(spark):
    """A block of several lines goes from its own texts and from many near copies that hold it too."""
    pick = random.Random(9)
    block = "top of the page\nmenu of the page\nsearch the page"
    prose = [f"sentence {i} of a document that is copied from site to site" for i in range(12)]
    rows = [(i, f"{block}\n" + " ".join(f"own{i}w{k}" for k in range(30)), f"s{i % 10}", "x") for i in range(40)]
    for i in range(400):
        changed = [line + " changed" * (pick.random() < 0.2) + (f" {i}" if pick.random() < 0.05 else "") for line in prose]
        rows.append((100 + i, "\n".join([*block.split("\n"), *changed]), f"s{i % 20}", "x"))
    cleaned = site_spread.remove_boilerplate(spark.createDataFrame(rows, SCHEMA).repartition(4), min_sites=8)
    found = {r["doc_id"]: (r["text"], r["n_removed_lines"]) for r in cleaned.collect()}
    assert found == {i: (text.removeprefix(block + "\n"), 3) for i, text, _, _ in rows}


def test_empty_table_and_no_python(spark):
    table = spark.createDataFrame([], SCHEMA)
    cleaned = site_spread.remove_boilerplate(table)
    assert cleaned.count() == 0
    assert "Python" not in cleaned._jdf.queryExecution().executedPlan().toString()
