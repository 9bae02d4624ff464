"""Personal data, and terms of a text that reveal it.

The base finds e-mail addresses, IP addresses, payment cards and phone numbers.  The values found are
protected, and so is what they tell in general form: the domain and the name parts of a mailbox, an
address's network, a card's issuer, a phone's exchange.  Over all documents it is counted how often a term
and such an identity occur, and how often together: a term discloses an identity by their pointwise mutual
information, as a part of the information the identity itself holds, ``log(N / df(identity))``.

A single text tells nothing about the term, so a text's own occurrence is no evidence: of ``p``, the part
of a term's documents that hold the identity, the lower confidence bound is taken (Wilson's, at
``deviations``), with one text less than there are.  If the mutual information by that bound reaches
``generalise_at``, the term discloses; it is removed if its estimate reaches ``remove_at``, and generalised
otherwise.  Nothing else bounds counts or search; pairs that their two counts alone rule out aren't formed.

Defined cases: missing and empty texts have no spans, and an empty table gives no rows; copies count as
documents but not as evidence; a term inside a base span is not reported again; ties need no order, since
all terms above the threshold count; very long texts are read whole; extra columns are not read, and
``sanitised`` keeps them, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.workspace import Workspace, ship_code

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "generalise", "remove")
_RANK = {kind: i for i, kind in enumerate(KINDS)}

# --- fixed values: the base patterns, in forms that look at each character a bounded number of times --
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W_]+")
_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from their ``@``: all before it in a run of local characters belongs."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    found = list(emails(text))
    if not _DIGIT.search(text):
        return found
    for match in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in match[0]) <= 15:
                found.append(("phone", *match.span()))
    return ordered(found)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], _RANK[s[0]], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def entity(kind: str, value: str) -> int:
    """The identity of a value: without case, and without separators in numbers."""
    plain = value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value)
    return xxhash.xxh64_intdigest(f"{kind}:{plain}") - (1 << 63)


def identities(kind: str, value: str) -> set[int]:
    """The identity of a value, and those of its general forms."""
    general = set()
    if kind == "email":
        mailbox, domain = value.lower().rsplit("@", 1)
        general = {f"domain:{domain}", *(f"name:{part}" for part in re.findall("[a-z]{3,}", mailbox))}
    elif kind == "ip":
        general = {f"network:{value.rsplit('.', 1)[0]}"}
    else:
        digits = re.sub("[^0-9]", "", value)
        general = {f"issuer:{digits[:6]}" if kind == "card" else f"exchange:{digits[:-4]}"}
    return {entity(kind, value), *(xxhash.xxh64_intdigest(text) - (1 << 63) for text in general)}


BASE = (
    "doc_id long, text_hash long, n_email long, n_ip long, n_card long, n_phone long, base string, entities array<long>, "
    "text string"
)


def base_table(docs: DataFrame) -> DataFrame:
    """Per row: the base spans, their counts and identities, and the text if it has any: later steps need no other."""
    ship_code(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            rows = []
            for text in texts:
                text = text.as_py() or ""
                spans = base_spans(text)
                kinds = [s[0] for s in spans]
                held = sorted(set().union(*(identities(k, text[a:b]) for k, a, b in spans)))
                rows.append((*[kinds.count(k) for k in BASE_KINDS], joined(spans), held, text if held else None))
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.string()]
            names = ["doc_id", "text_hash", "n_email", "n_ip", "n_card", "n_phone", "base", "entities", "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(columns, types)]], names=names
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return chosen.mapInArrow(find, BASE)


def _terms(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


@dataclass(frozen=True)
class Disclosure:
    generalise_at: float = 0.8
    remove_at: float = 0.95
    deviations: float = 1.645


def lower_bound(part: Column, n: Column, deviations: float) -> Column:
    """Wilson's lower bound of a part seen in ``n`` cases."""
    square = deviations**2
    spread = deviations * F.sqrt(part * (1 - part) / n + square / (4 * n * n))
    return (part + square / (2 * n) - spread) / (1 + square / n)


def disclosing_terms(docs: DataFrame, base: DataFrame, work: Workspace, settings: Disclosure) -> DataFrame:
    """The texts with identities that a term of theirs discloses: text_hash, term, part."""
    n = float(base.count())
    held = base.select("text_hash", F.explode("entities").alias("entity"))
    # With copies, so that a text stands for as many documents; in one text alone nothing can be disclosed.
    texts_of = held.groupBy("text_hash", "entity").agg(F.count("*").alias("copies"))
    entities = texts_of.groupBy("entity").agg(F.sum("copies").alias("df_entity"), F.count("*").alias("n_texts"))
    entities = entities.where(F.col("n_texts") >= 2).select("entity", "df_entity")
    bearing = work.keep(texts_of.join(entities, "entity"), "bearing")
    most = bearing.agg(F.max("df_entity")).first()[0] or 0
    allowed = lambda df: F.pow(df, settings.generalise_at) * n ** (1 - settings.generalise_at)
    texts = bearing.select("text_hash").distinct()
    bearers = base.where(F.col("text").isNotNull()).select("text_hash", "text").join(texts, "text_hash", "left_semi")
    own = bearers.dropDuplicates(["text_hash"]).select("text_hash", F.explode(_terms(F.col("text"))).alias("term"))
    own = work.keep(own.where(F.col("term") != ""), "own")
    wanted = work.keep(own.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= 2).select("term"), "wanted")
    # Counted before the join, so that a task hands on each of its terms once.
    counts = (
        docs.select(F.explode(_terms(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df_term"))
        .where(F.col("df_term") <= allowed(F.lit(float(most))))
        .join(wanted, "term", "left_semi")
    )
    # Both occur together at most as often as the identity, which rules out frequent terms beforehand.
    together = work.keep(own.join(counts, "term"), "counted").join(bearing, "text_hash")
    together = together.where(F.col("df_term") <= allowed(F.col("df_entity")))
    pairs = together.groupBy("entity", "term").agg(
        F.count("*").alias("support"),
        F.sum("copies").alias("df_both"),
        F.max("df_entity").alias("df_entity"),
        F.max("df_term").alias("df_term"),
    )
    information = F.log(F.lit(n) / F.col("df_entity"))
    seen = F.col("df_both") / F.col("df_term")
    share = lambda p: F.when(information > 0, 1 + F.log(p) / information).otherwise(0.0)
    sure = lower_bound(seen, (F.col("support") - 1) / seen, settings.deviations)
    telling = pairs.where(F.col("support") >= 2).where(share(sure) >= settings.generalise_at)
    telling = work.keep(telling.select("entity", "term", share(seen).alias("part")), "telling")
    return together.join(telling, ["entity", "term"]).groupBy("text_hash", "term").agg(F.max("part").alias("part"))


def term_spans(text: str, terms: dict[str, float], base: list[Span], remove_at: float) -> list[Span]:
    """Where disclosing terms stand in a text, outside the base spans."""
    covered, at, out = ordered(list(base)), 0, []
    reach = 0
    for match in _TERM.finditer(text):
        while at < len(covered) and covered[at][1] < match.end():
            reach = max(reach, covered[at][2])
            at += 1
        if match.start() < reach:
            continue
        part = terms.get(match[0].lower())
        if part is not None:
            out.append(("remove" if part >= remove_at else "generalise", *match.span()))
    return out


def parse_spans(text: str) -> list[Span]:
    parts = [x.split(":") for x in text.split(",")] if text else []
    return [(kind, int(a), int(b)) for kind, a, b in parts]


def find_spans(docs: DataFrame, settings: Disclosure = Disclosure()) -> DataFrame:
    """Per row: doc_id, counts, base spans and all spans, as ``kind:start:end`` lists."""
    spark = docs.sparkSession
    work = Workspace(spark, "disclosure")
    base = work.keep(base_table(docs), "base")
    disclosed = disclosing_terms(docs, base, work, settings)
    # A text's own disclosing terms: at most as many as it has words.
    terms = work.keep(
        disclosed.groupBy("text_hash").agg(F.collect_list(F.struct("term", "part")).alias("terms")), "disclosed"
    )
    texts = base.where(F.col("text").isNotNull()).select("text_hash", "text").join(terms, "text_hash")
    remove_at = settings.remove_at

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, terms in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                base = base_spans(text)
                extra = term_spans(text, {t["term"]: t["part"] for t in terms}, base, remove_at)
                found.append(joined(ordered(base + extra)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["text_hash", "spans"])

    located = texts.dropDuplicates(["text_hash"]).select("text_hash", "text", "terms").mapInArrow(locate, "text_hash long, spans string")
    return base.join(located, "text_hash", "left").select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        "base",
        F.coalesce("spans", "base").alias("spans"),
        "text_hash",
    )


def sanitise(text: str, spans: list[Span]) -> str:
    """A text with base values replaced by their kind, and terms generalised to their shape or removed."""
    out, at = [], 0
    for kind, start, end in ordered(spans):
        if start < at:
            continue
        out.append(text[at:start])
        if kind == "generalise":
            out.append("[NUMBER]" if text[start:end].isdigit() else "[TERM]")
        elif kind != "remove":
            out.append(f"[{kind.upper()}]")
        at = end
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, settings: Disclosure = Disclosure()) -> DataFrame:
    """The rows with their texts sanitised; all other columns stay."""
    mark = uuid.uuid4().hex
    key, found = f"text_{mark}", f"spans_{mark}"
    spans = find_spans(docs, settings).select(F.col("text_hash").alias(key), F.col("spans").alias(found))
    keyed = docs.withColumn(key, F.xxhash64("text")).join(spans.dropDuplicates([key]), key, "left")
    at = docs.columns.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, spans = batch.columns
            texts = [t and sanitise(t, parse_spans(s)) for t, s in zip(columns[at].to_pylist(), spans.to_pylist())]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return keyed.select(*[F.col(f"`{c}`") for c in docs.columns], found).mapInArrow(apply, docs.schema)
