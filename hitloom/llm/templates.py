"""Benchmark decontamination by template canonicalisation.

Texts are split at white space.  In a window of words, numbers become a typed placeholder, units after a
number and names inside a sentence too; the rest is lower-cased without punctuation.  Such windows are
joined by hash.  Where one matches, the words behind equal placeholders are compared: a
re-parameterised copy replaces each value by one other value throughout.  An item is in a document when a
part of its windows occurs there, or, whatever part that is, a run of so many words.

The join has two steps.  Each window has an anchor, its longest pair of neighbouring words; documents'
pairs are looked up among the anchors.  Only at the few places found is the window's template built and
its hash compared.  A window without such a pair is looked up by its longest word.

Defined cases: missing and empty texts match nothing, and empty tables give no rows; an item with fewer
words than a window is one window; repeated rows of either table are reported alike; equal windows within
an item count once per place; of alignments with equally many slots the most consistent one counts; texts
of any length are read whole; extra columns are not read, and the filter keeps them, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.workspace import Workspace

# --- fixed values: units that make a number a quantity ----------------------------------------------
UNITS = (
    "mm cm m km mg g kg t ml cl l s sec secs second seconds min mins minute minutes h hour hours day days "
    "week weeks month months year years inch inches foot feet yard yards mile miles ounce ounces pound "
    "pounds dollar dollars cent cents euro euros percent degree degrees litre litres liter liters meter "
    "meters metre metres gram grams kilogram kilograms kilometer kilometers"
).split()

#: Placeholders, from the range of code points for private use.
NUMBER, UNIT, NAME = "\ue000", "\ue001", "\ue002"
#: Benchmark windows that are broadcast; the anchors of a larger benchmark are joined by a shuffle.
BROADCAST_WINDOWS = 200_000


_BLANKS = " \t\n\x0b\f\r"
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_NUMBERS = r"[0-9]+(?:[.,:/][0-9]+)*"


def raw_words(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit(_BLANKS)), r"\s+")


def _bare(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(_PUNCTUATION)))


def template(words: Column) -> Column:
    """The words of a window in canonical form, as many as before; it depends on nothing outside."""
    numbered = F.regexp_replace(F.array_join(words, " "), _NUMBERS, NUMBER)
    units = F.regexp_replace(numbered, rf"(?i)(?<={NUMBER}|{NUMBER} )(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", UNIT)
    names = F.regexp_replace(units, r"(?<=[\p{Ll},;] )\p{Lu}[\p{Ll}'-]+", NAME)
    return F.transform(F.split(names, " "), _bare)


def _anchor_form(word: Column) -> Column:
    """What a word of a document is looked up by: as in a template, but for names and units."""
    return F.when(word.rlike("[0-9]"), _bare(F.regexp_replace(word, _NUMBERS, NUMBER))).otherwise(_bare(word))


def _has_slot(word: Column) -> Column:
    return word.rlike(f"[{NUMBER}{UNIT}{NAME}]")


def benchmark_windows(items: DataFrame, window: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Every window of every item: its words and hash, its anchor's key and place, and the anchor's words."""
    own = items.select(F.col(item_id).alias("item_id"), raw_words(F.col(text)).alias("raw"))
    own = own.where((F.size("raw") > 0) & (F.element_at("raw", 1) != ""))
    size = F.least(F.size("raw"), F.lit(window))
    cut = own.select("item_id", "raw", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("raw") - size)).alias("at"))
    parts = cut.select("item_id", "at", "size", F.slice("raw", F.col("at") + 1, F.col("size")).alias("item_raw"))
    parts = parts.withColumn("part", template(F.col("item_raw")))
    # Names and units depend on their neighbours and can't be looked up; a window's first word is neither.
    fixed = lambda w: ~w.rlike(f"[{UNIT}{NAME}]")
    place = lambda w, beside, i: F.struct(
        F.coalesce(fixed(beside), F.lit(False)).alias("pair"),
        (F.length(w) + F.coalesce(F.length(beside), F.lit(0))).alias("n"),
        i.alias("i"),
        F.when(F.coalesce(fixed(beside), F.lit(False)), F.xxhash64(w, beside)).otherwise(F.xxhash64(w)).alias("key"),
    )
    places = F.transform("part", lambda w, i: F.when(fixed(w), place(w, F.get("part", i + 1), i)))
    parts = parts.withColumn("anchor", F.array_max(F.filter(places, lambda x: x.isNotNull())))
    return parts.select(
        "item_id", "at", "size", "item_raw", "part", F.xxhash64("part").alias("hash"), "anchor.key", "anchor.pair", F.col("anchor.i").alias("shift")
    )


def anchored_places(docs: DataFrame, windows: DataFrame, pair: bool, few: bool) -> DataFrame:
    """Where windows may start in texts, by their anchors: text_hash, item_id, at, start."""
    words = docs.select(F.xxhash64("text").alias("text_hash"), raw_words(F.col("text")).alias("words"))
    after = F.slice("words", 2, F.greatest(F.size("words"), F.lit(1)))
    # The outer form spares a second split of the text, which a test for empty arrays would need; the rows
    # made here hold two words, never the text's whole array.
    rows = words.select("text_hash", F.posexplode_outer(F.arrays_zip(F.col("words").alias("w"), after.alias("beside"))).alias("pos", "two"))
    key = [_anchor_form(F.col("two.w"))] + [_anchor_form(F.col("two.beside"))] * pair
    if pair:
        rows = rows.where(F.col("two.beside").isNotNull())
    small = windows.select("item_id", "at", "shift", "key")
    found = rows.select("text_hash", "pos", F.xxhash64(*key).alias("key")).join(F.broadcast(small) if few else small, "key")
    return found.select("text_hash", "item_id", "at", (F.col("pos") - F.col("shift")).alias("start")).where(F.col("start") >= 0)


def matches(docs: DataFrame, items: DataFrame, window: int, work: Workspace) -> DataFrame:
    """One row per text, item and pair of equal template windows, with the words of both."""
    windows = work.keep(benchmark_windows(items, window), "windows")
    few = windows.count() <= BROADCAST_WINDOWS
    places = anchored_places(docs, windows.where("pair"), True, few)
    single = windows.where("not pair")
    if not single.isEmpty():
        places = places.unionByName(anchored_places(docs, single, False, few))
    places = work.keep(places.distinct(), "places")
    told = places.join(F.broadcast(windows) if few else windows, ["item_id", "at"])
    # As many as the text has places of anchors.
    wanted = told.groupBy("text_hash").agg(F.collect_list(F.struct("item_id", "at", "start", "size", "hash", "part", "item_raw")).alias("places"))
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text")
    asked = texts.join(places.select("text_hash").distinct(), "text_hash", "left_semi").dropDuplicates(["text_hash"])
    both = asked.join(wanted, "text_hash").select("text_hash", "places", raw_words(F.col("text")).alias("words"))
    inside = F.filter("places", lambda p: p["start"] + p["size"] <= F.size("words"))
    slot = lambda p: p.withField("doc_raw", F.slice("words", p["start"] + 1, p["size"]))
    equal = F.filter(F.transform(inside, slot), lambda p: F.xxhash64(template(p["doc_raw"])) == p["hash"])
    return both.select("text_hash", F.explode(equal).alias("p")).select("text_hash", "p.item_id", "p.at", "p.start", "p.part", "p.item_raw", "p.doc_raw")


def longest_runs(found: DataFrame, window: int) -> DataFrame:
    """Per text and item the longest run of words that windows one after the other cover, in both alike."""
    aligned = found.select("text_hash", "item_id", "at", (F.col("start") - F.col("at")).alias("shift")).distinct()
    # As many rows as the item has windows.
    order = Window.partitionBy("text_hash", "item_id", "shift").orderBy("at")
    runs = aligned.withColumn("run", F.col("at") - F.row_number().over(order))
    sized = runs.groupBy("text_hash", "item_id", "shift", "run").agg(F.count("*").alias("n"))
    return sized.groupBy("text_hash", "item_id").agg((F.max("n") + (window - 1)).alias("run_words"))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = 8,
    min_share: float = 0.25,
    min_consistency: float = 0.8,
    min_run: int = 20,
) -> DataFrame:
    """Documents with benchmark items in them: a row per document and item.

    ``share`` is the part of the item's windows that occur, ``run_words`` the longest run of words (of an
    item shorter than a window: the item's), ``consistency`` the part of its slots whose value stands for
    one value of the item only.
    """
    work = Workspace(docs.sparkSession, "templates")
    docs = docs.select("doc_id", "text")
    items = items.select("item_id", "text")
    found = work.keep(matches(docs, items, window, work), "matches")
    key = ("text_hash", "item_id")
    # Each alignment of text and item is judged by itself; the one with most slots counts.
    slots = (
        found.select(*key, (F.col("start") - F.col("at")).alias("shift"), F.explode(F.arrays_zip("part", "item_raw", "doc_raw")).alias("slot"))
        .where(_has_slot(F.col("slot.part")))
        .groupBy(*key, "shift", F.col("slot.item_raw").alias("theirs"), F.col("slot.doc_raw").alias("ours"))
        .agg(F.count("*").alias("n"))
        .groupBy(*key, "shift", "theirs")
        .agg(F.max("n").alias("agree"), F.sum("n").alias("n"))
        .groupBy(*key, "shift")
        .agg(F.sum("n").alias("n"), (F.sum("agree") / F.sum("n")).alias("consistency"))
        .groupBy(*key)
        .agg(F.max_by("consistency", F.struct("n", "consistency")).alias("consistency"))
    )
    counted = found.groupBy(*key).agg(F.count_distinct("at").alias("matched"))
    sizes = items.select("item_id", F.size(raw_words(F.col("text"))).alias("n_words")).groupBy("item_id").agg(F.max("n_words").alias("n_words"))
    sizes = sizes.select("item_id", "n_words", F.greatest(F.col("n_words") - window + 1, F.lit(1)).alias("n_windows"))
    long_item = F.least(F.col("run_words"), F.col("n_words").cast("long"))
    judged = (
        counted.join(slots, list(key), "left")
        .join(longest_runs(found, window), list(key))
        .join(sizes, "item_id")
        .select(
            "text_hash",
            "item_id",
            "matched",
            "n_windows",
            (F.col("matched") / F.col("n_windows")).alias("share"),
            long_item.alias("run_words"),
            F.coalesce("consistency", F.lit(1.0)).alias("consistency"),
        )
        .where(((F.col("share") >= min_share) | (F.col("run_words") >= min_run)) & (F.col("consistency") >= min_consistency))
    )
    judged = work.keep(judged, "judged")
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash")).join(judged, "text_hash")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows without benchmark items, with all their columns."""
    mark = f"text_{uuid.uuid4().hex}"
    found = contaminated(docs, items).select(F.col("text_hash").alias(mark)).distinct()
    return docs.withColumn(mark, F.xxhash64("text")).join(found, mark, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
