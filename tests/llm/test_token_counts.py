"""Token counts: the library's own, encoded once per content, then taken from the cache."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from hitloom.llm import token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "a", "the", "ing", "\n", "\t", "\r\n", "é", "漢", "😀", ".", ",", "<s>", "<unk>", "<0x0A>", "\xa0", "▁", "▁▁", "\x00", "x" * 70]


@pytest.fixture()
def cache(tmp_path):
    return str(tmp_path / "cache")


def by_library(text: str | None) -> int:
    return len(SentencePieceProcessor(model_file=PIECES).encode(text or ""))


def test_counter_equals_the_library():
    pick = random.Random(3)
    texts = ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 14))) for _ in range(6000)]
    model = SentencePieceProcessor(model_file=PIECES)
    counter = token_counts.PieceCounter(PIECES, limit=500)
    found = list(counter.counts([text.replace("▁", " ") for text in texts]))
    assert counter._by_word and found == [len(ids) for ids in model.encode(texts)]
    counter._by_word = False
    assert list(counter.counts(texts)) == found


def test_counts_of_a_table(spark, cache):
    texts = ["two words", "two words", "two▁words", None, "", " ", "end ", "  a  b ", "word " * 30_000, "ü漢😀" * 3000]
    rows = [(i % 7, text, 5, "x") for i, text in enumerate(texts)] + [(None, "a", 6, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, content string")
    found = token_counts.count_tokens(docs, PIECES, cache)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    expected = sorted([(r[0] or -1, len((r[1] or "").encode()), by_library(r[1])) for r in rows])
    assert sorted((r[0] or -1, r[1], r[2]) for r in found.collect()) == expected


@pytest.mark.parametrize("few", [0, 100])
def test_only_misses_are_encoded_once(spark, cache, few):
    docs = spark.createDataFrame([(i, f"text {i % 5}") for i in range(40)], "doc_id long, text string").repartition(4)
    token_counts.count_tokens(docs, PIECES, cache, few).collect()
    version = token_counts.tokenizer_digest(PIECES)
    stored = spark.read.schema(token_counts.CACHE).parquet(cache)
    assert stored.count() == stored.select("content").distinct().count() == 5
    # A planted count is believed: what is in the cache is not encoded again.
    planted = spark.createDataFrame([(0, "new text")], "doc_id long, text string").select(
        token_counts.content_digest(F.col("text"), PIECES).alias("content"),
        F.lit(99).cast("long").alias("n_tokens"),
        F.lit(version).alias("tokenizer"),
    )
    for _ in range(2):  # as if two writers had met
        planted.write.mode("append").partitionBy("tokenizer").parquet(cache)
    more = spark.createDataFrame([(1, "new text"), (2, "text 3"), (3, "third one")], "doc_id long, text string")
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(more, PIECES, cache, few).collect()}
    assert found == {1: 99, 2: by_library("text 3"), 3: by_library("third one")}
    assert spark.read.schema(token_counts.CACHE).parquet(cache).count() == 8


def test_versions_have_counts_of_their_own(spark, cache):
    docs = spark.createDataFrame([(1, "some text ▁ here")], "doc_id long, text string")
    pieces = token_counts.count_tokens(docs, PIECES, cache).first()["n_tokens"]
    other = token_counts.count_tokens(docs, BYTES, cache).first()["n_tokens"]
    ids = Tokenizer.from_file(BYTES).encode("some text ▁ here", add_special_tokens=False).ids
    assert (pieces, other) == (by_library("some text ▁ here"), len(ids)) and pieces != other


def test_empty_table(spark, cache):
    assert token_counts.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PIECES, cache).count() == 0
