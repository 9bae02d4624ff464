"""Personal data: the base against plain patterns, disclosing terms, defined cases."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hitloom.llm import disclosure as d

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and d.luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, *m.span()))
    return d.ordered(out)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab9012.-@+ ()_é\n"), max_size=60))
def test_base_equals_the_plain_patterns(text):
    assert d.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize(
    "text",
    ["call +49 (30) 1234-5678 or 4111 1111 1111 1111", "1.2.3.4.5.6.7.8 001.2.3.255", "a.b@c.d.e@f.g", "+12345678901234567", "a@b.c@d.e"],
)
def test_known_texts(text):
    assert d.base_spans(text) == plain_spans(text)


def test_long_runs_are_fast():
    assert d.base_spans("a" * 200_000) == [] and d.base_spans("1" * 200_000 + ".") == []


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, term string")


def test_terms_that_reveal_an_entity(spark):
    about = ["mail jo@a.org now zanzibar club %s" % w for w in ("one", "two", "three", "four")]
    others = [f"mail now the club one two three four text {i}" for i in range(200)]
    rows = {r["doc_id"]: r for r in d.find_spans(frame(spark, [*about, *others, None, "", about[0]])).collect()}
    assert len(rows) == 207
    assert rows[0]["spans"].startswith("email:5:13,") and "remove:18:26" in rows[0]["spans"]
    assert "club" not in [about[0][int(s.split(":")[1]) : int(s.split(":")[2])] for s in rows[0]["spans"].split(",")]
    assert rows[100]["spans"] == "" and rows[204]["spans"] == "" and rows[206]["spans"] == rows[0]["spans"]
    clean = {r["doc_id"]: r for r in d.sanitised(frame(spark, [*about, *others, None])).collect()}
    assert "jo@a.org" not in clean[0]["text"] and "zanzibar" not in clean[0]["text"] and "club" in clean[0]["text"]
    assert clean[204]["text"] is None and clean[0]["term"] == "x" and clean[50]["text"] == others[46]


def test_copies_are_no_support_and_empty_tables(spark):
    rows = d.find_spans(frame(spark, ["mail jo@a.org zanzibar"] * 9 + ["text"] * 50)).collect()
    assert {r["spans"] for r in rows} == {"email:5:13", ""}
    assert d.find_spans(frame(spark, ["x"]).where("false")).count() == 0


def brute(texts, settings):
    """Counted and estimated pair by pair."""
    n, copies = len(texts), Counter(texts)
    terms = {t: set(re.findall("[a-z0-9]+", t.lower())) for t in copies}
    held = {t: set().union(*(d.identities(k, t[a:b]) for k, a, b in d.base_spans(t))) for t in copies}
    df_term, df_entity, both = Counter(), Counter(), defaultdict(list)
    for t, c in copies.items():
        df_term.update(dict.fromkeys(terms[t], c))
        df_entity.update(dict.fromkeys(held[t], c))
        for e in held[t]:
            for w in terms[t]:
                both[e, w].append(c)
    telling = {}
    for (e, w), found in both.items():
        p, information = sum(found) / df_term[w], math.log(n / df_entity[e])
        if len(found) < 2 or information <= 0:
            continue
        m, z = (len(found) - 1) / p, settings.deviations
        low = (p + z * z / 2 / m - z * math.sqrt(p * (1 - p) / m + z * z / 4 / m / m)) / (1 + z * z / m)
        if 1 + math.log(low) / information >= settings.generalise_at:
            telling[e, w] = 1 + math.log(p) / information
    out = []
    for t in texts:
        parts = {w: max((telling[e, w] for e in held[t] if (e, w) in telling), default=None) for w in terms[t]}
        base = d.base_spans(t)
        own = {w: p for w, p in parts.items() if p is not None}
        out.append(d.joined(d.ordered(base + d.term_spans(t, own, base, settings.remove_at))))
    return out


def test_estimates_equal_brute_force(spark):
    pick = random.Random(3)
    texts = []
    for i in range(400):
        words = [f"w{pick.randrange(60)}" for _ in range(12)]
        club = pick.randrange(12)
        if pick.random() < 0.2:  # members of few clubs, whose names mostly stand beside their domain or network
            words += [f"club{club}"] + [f"n{pick.randrange(9)}.{pick.choice(['anna', 'bert'])}@c{club}.org"] * (pick.random() < 0.8)
            words += [f"10.0.{club}.{pick.randrange(4)}"] * (pick.random() < 0.5)
        pick.shuffle(words)
        texts += [" ".join(words)] * pick.choice([1, 1, 1, 3])
    expected = brute(texts, d.Disclosure())
    found = {r["doc_id"]: r["spans"] for r in d.find_spans(frame(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == expected
    kinds = Counter(span.split(":")[0] for spans in expected for span in spans.split(","))
    assert kinds["generalise"] > 5 and kinds["remove"] > 0


def test_only_texts_with_identities_are_kept_for_later_steps(spark):
    texts = ["mail jo@a.org", "no data", None, "", "call 10.0.0.1 or 300.0.0.1"]
    kept = {r["doc_id"]: r["text"] for r in d.base_table(frame(spark, texts)).collect()}
    assert kept == {0: texts[0], 1: None, 2: None, 3: None, 4: texts[4]}
