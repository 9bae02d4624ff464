"""Token counts of whole texts, looked up in a cache of digests before anything is encoded.

A text is known by the SHA-256 of its normalised content, a tokenizer by the SHA-256 of its file and of
its library's name and version.  Documents become narrow rows of digests, which join the stored counts
of that tokenizer version.  Only contents without a stored count are read again, once per distinct
content, encoded, and appended to the cache; then all documents take their counts from it.  Copies are
combined before texts are shuffled, so a group of copies is one row per task and one text in all.  The
second reading keeps only missing contents: by a broadcast set of at most ``FEW_MISSES`` digests, beyond
that by a join.

Normalising must not change the count: a missing text is empty, and for sentencepiece the sign that the
library itself writes for a blank (U+2581) is taken as a blank.

Defined cases: null and empty texts have 0 bytes and 0 tokens; texts of any length are counted whole;
repeated rows each get their count; an empty table gives no rows and leaves the cache as it is; other
columns of the input are not read.  Rows that two writers have appended for one content count once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm.encoding import encoder
from hitloom.llm.workspace import Workspace, ship_code

CACHE = "content binary, n_tokens long, tokenizer string"
#: Up to so many missing contents (32 bytes each) are broadcast to the reading of their texts.
FEW_MISSES = 100_000
_BLANK_SIGN = "▁"
_AFTER_WORD = re.compile("(?<=[^ ]) ")
_LONGEST_REMEMBERED = 64
_TOGETHER = 500

_counters: dict[str, "PieceCounter"] = {}


class PieceCounter:
    """Numbers of sentencepiece tokens, remembering those of words.

    Where no piece has a blank behind another character, pieces never cross the blank before a word, and
    a text has as many tokens as its words have.  With other models each text is encoded whole.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        self._by_word = self._words_stand_alone()
        self._limit = limit
        self._words: dict[str, int] = {}
        pieces = map(self._model.id_to_piece, range(self._model.get_piece_size()))
        self._begins = np.array([piece.startswith(_BLANK_SIGN) for piece in pieces])
        self._last_blank = len(self._model.encode("a ")) - len(self._model.encode("a"))

    def _words_stand_alone(self) -> bool:
        try:
            from sentencepiece import sentencepiece_model_pb2
        except ImportError:
            return False
        proto = sentencepiece_model_pb2.ModelProto.FromString(self._model.serialized_model_proto())
        rule, training = proto.normalizer_spec, proto.trainer_spec
        return (
            training.model_type == training.BPE
            and not training.treat_whitespace_as_suffix
            and rule.add_dummy_prefix
            and rule.escape_whitespaces
            and not rule.remove_extra_whitespaces
            and not rule.precompiled_charsmap
            and not any(piece.type in (piece.USER_DEFINED, piece.UNUSED) for piece in proto.pieces)
            and not any(re.search(f"[^{_BLANK_SIGN}]{_BLANK_SIGN}", piece.piece) for piece in proto.pieces)
        )

    def _learn(self, words: list[str]) -> None:
        """Remember words: encoded as one text, in which each begins with the blank's sign."""
        plain = [word for word in words if " " not in word]
        for at in range(0, len(plain), _TOGETHER):
            some = plain[at : at + _TOGETHER]
            ids = np.array(self._model.encode(" ".join(some)), np.int64)
            starts = np.flatnonzero(self._begins[ids])
            if len(starts) != len(some):  # a piece that begins with a blank's sign and is none
                plain_counts = map(len, self._model.encode(some, num_threads=1))
            else:
                plain_counts = np.diff(starts, append=len(ids)).tolist()
            self._words.update(zip(some, plain_counts))
        self._words.update([(word, len(self._model.encode(word))) for word in words if " " in word])

    def _words_of(self, text: str) -> list[str]:
        """Parts of a text that are tokenised by themselves; an empty one at the end is a last blank."""
        words = text.split(" ")
        return words if "" not in words else _AFTER_WORD.split(text)

    def counts(self, texts: list[str], together: int = 64) -> Iterator[int]:
        """The number of tokens of each normalised text; new words of ``together`` texts are learned at once."""
        if not self._by_word:
            yield from (len(self._model.encode(text)) for text in texts)
            return
        known = self._words
        for at in range(0, len(texts), together):
            split = [self._words_of(text) for text in texts[at : at + together]]
            distinct = set().union(*split)
            missing = distinct.difference(known)
            if len(known) + len(missing) > self._limit:
                known.clear()
                missing = distinct
            missing.discard("")
            known[""] = self._last_blank
            self._learn([word for word in missing if len(word) <= _LONGEST_REMEMBERED])
            for words in split:
                if words == [""]:
                    yield 0
                    continue
                try:
                    yield sum(map(known.__getitem__, words))
                except KeyError:  # long words are not remembered
                    yield sum([known[w] if w in known else len(self._model.encode(w)) for w in words])


def counter(path: str):
    """The counting function of this process for a tokenizer file; it must be on every executor."""
    if path.endswith(".json"):
        return lambda texts: map(len, encoder(path).encode_many(texts))
    if path not in _counters:
        _counters[path] = PieceCounter(path)
    return _counters[path].counts


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: its file, and the library that reads it."""
    import importlib.metadata

    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    digest = hashlib.sha256(f"{library} {importlib.metadata.version(library)}\n".encode())
    with open(path, "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()


def normalised(text: Column, path: str) -> Column:
    """A text as the tokenizer takes it, without differences that cannot change its count."""
    text = F.coalesce(text, F.lit(""))
    return text if path.endswith(".json") else F.replace(text, F.lit(_BLANK_SIGN), F.lit(" "))


def content_digest(text: Column, path: str) -> Column:
    return F.unhex(F.sha2(normalised(text, path).cast("binary"), 256))


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """One row per content that the cache has for a tokenizer version: content, n_tokens."""
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _encoded(texts: DataFrame, path: str) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path)
        for batch in batches:
            counts = pa.array(list(tokens(batch.column(1).to_pylist())), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts], ["content", "n_tokens"])

    return texts.mapInArrow(count, "content binary, n_tokens long")


def count_tokens(docs: DataFrame, path: str, cache: str, few_misses: int = FEW_MISSES) -> DataFrame:
    """Bytes and tokens of every document: doc_id, n_bytes, n_tokens.

    ``cache`` is a folder that all executors see; it is made if it does not exist.  ``docs`` is read
    once for digests, and again if contents are missing in the cache.
    """
    spark = docs.sparkSession
    ship_code(spark)
    work = Workspace(spark, "token-counts")
    version = tokenizer_digest(path)
    # Without rows this only makes the folder, so that a new cache can be read.
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(cache)

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    digests = work.keep(docs.select("doc_id", n_bytes, content_digest(F.col("text"), path).alias("content")), "digests")
    stored = stored_counts(spark, cache, version)
    missing = work.keep(digests.select("content").distinct().join(stored, "content", "left_anti"), "missing")
    n_missing = missing.count()
    if n_missing:
        text = normalised(F.col("text"), path).alias("text")
        texts = docs.select(content_digest(F.col("text"), path).alias("content"), text)
        few = n_missing <= few_misses
        if few:
            texts = texts.join(F.broadcast(missing), "content", "left_semi")
        texts = texts.groupBy("content").agg(F.first("text").alias("text"))
        if not few:  # already dealt out by content
            texts = texts.join(missing, "content", "left_semi")
        counted = _encoded(texts, path).withColumn("tokenizer", F.lit(version))
        counted.write.mode("append").partitionBy("tokenizer").parquet(cache)
    # As a table of its own, without a grouping above its shuffle, so that AQE can split a content of many rows.
    stored = work.keep(stored_counts(spark, cache, version), "stored")
    return digests.join(stored, "content", "left").select("doc_id", "n_bytes", "n_tokens")
