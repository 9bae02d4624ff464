"""The divergence audit against plain counting, with few terms and shared paths."""

import re
from collections import Counter
from itertools import product

import numpy as np
import pytest

from hitloom.llm import source_divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_audit(rows, least_docs=3, top=200):
    rows = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        docs = Counter(term for _, _, terms in own for term in set(terms))
        kept = sorted(term for term, n in docs.items() if n >= least_docs)
        groups = {s: Counter() for _, s, _ in own}
        for _, source, terms in own:
            groups[source].update(t for t in terms if docs[t] >= least_docs)
        whole = sum(groups.values(), Counter())

        def share(n, term):
            return 1 + 10**9 * (n[term] + 1) // (sum(n.values()) + len(kept))

        def f(p, q):
            return (p - q) ** 2 // q

        for source, n in groups.items():
            pairs = [(-sum(f(share(n, t), share(m, t)) for t in kept), other) for other, m in groups.items() if other != source]
            terms = [(-f(share(n, t), share(whole, t)), t) for t in kept if n[t] and share(n, t) > share(whole, t)]
            by_bytes = lambda x: (x[0], x[1].encode())
            for part, found in (("pair", sorted(pairs, key=by_bytes)), ("term", sorted(terms, key=by_bytes)[:top])):
                out += [(lang, source, part, item, -value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def audit(spark, rows, **settings):
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], "lang string, source string, text string, n int, term string")
    return sorted(map(tuple, source_divergence.audit(docs, **settings).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_counting(spark, monkeypatch, seed):
    pick = np.random.default_rng(seed)
    words = ["a", "B", "Éa", "éa", "漢字", "x1y", "don't", "z", "cc", "dd", "e_e", "\x7ff", "\xa0g", "h\x00i"]
    rows = []
    for _ in range(150):
        text = " ".join(words[min(i, len(words) - 1)] for i in pick.geometric(0.2, pick.integers(0, 12)) - 1)
        rows.append((["en", "de", None, ""][pick.integers(4)], "s" + str(pick.geometric(0.3)), text))
    rows += [("en", "s1", "a a dd " * 4000), ("en", None, None), ("fr", "alone", ""), ("fr", "other", "once"), *rows[:20]]
    assert audit(spark, rows) == plain_audit(rows)
    assert audit(spark, rows, least_docs=1, top=2) == plain_audit(rows, 1, 2)


def test_small_buffers(spark, monkeypatch):
    """Sums handed on early, and terms counted in parts, change nothing."""
    rows = [("l", f"s{i % 9}", f"w{chr(97 + i % 7)} common v{chr(97 + i % 3)}") for i in range(200)]
    expected = plain_audit(rows)
    sums, found = source_divergence._PairSums(), Counter()
    monkeypatch.setattr(source_divergence, "CORRECTIONS_AT_ONCE", 8)
    path, paths = source_divergence._Path(sums), list(product([3, 5], [4], [7, 9]))
    tree = [np.array([(i, p, 2) for i, p in enumerate(path)], np.int64) for path in sorted(paths)]
    for nodes in tree:
        path.insert(nodes, 2)
    path.leave(0)
    for batch in sums.rows("l"):
        found.update({(r["first"], r["second"]): r["value"] for r in batch.to_pylist()})
    f = lambda p, q: (p - q) ** 2 // q
    for a, b in ((0, 2), (2, 0), (1, 0)):
        assert found[a, b] == sum(2 * (f(n[a], n[b]) - f(n[a], 2) - f(2, n[b]) + f(2, 2)) for n in paths)
    assert audit(spark, rows) == expected


def test_empty_table(spark):
    assert audit(spark, []) == []
