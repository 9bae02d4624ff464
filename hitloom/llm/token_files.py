"""Token ids in Arrow stream files of fixed-size-list batches.

A shard is an Arrow stream file.  Its rows are sequences of equal length: the ids, and a mask with one
byte for each, 1 for real ids and 0 for those that pad the shard's last sequence.  Nearly all masks are
equal, so they are a dictionary column: each different one is stored once.  All batches but the last have
the same number of rows and so of bytes; a memory-mapped shard gives any sequence and mask as a view.  A
second stream file beside it lists the shard's documents in their order, and so where they end.

Defined cases: a missing or empty text has only the end id; a text of any length is encoded whole and
runs on over as many sequences as it takes; a missing doc_id sorts first; repeated doc_ids are ordered by
their text's hash and all kept; an empty table gives no shard; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitloom.llm.encoding import encoder
from hitloom.llm.workspace import ship_code, shuffle_width

MANIFEST = "shard long, file string, n_documents long, n_tokens long"
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
READ = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long, first_sequence long"


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder as Spark itself resolves it: without a scheme, it lies in the default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path; a plain path is a local one."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def sequence_schema(length: int, ids: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("input_ids", pa.list_(ids, length)),
            ("attention_mask", pa.dictionary(pa.int8(), pa.list_(pa.uint8(), length))),
        ]
    )


class _ShardWriter:
    """Cuts a stream of ids into batches of ``rows`` sequences of ``length`` ids."""

    def __init__(self, sink, length: int, rows: int, dtype: np.dtype):
        self._length, self._capacity, self._dtype = length, length * rows, dtype
        self._schema = sequence_schema(length, pa.from_numpy_dtype(dtype))
        self._writer = ipc.new_stream(sink, self._schema)
        self._parts: list[np.ndarray] = []
        self._held = 0
        self.n_tokens = 0

    def add(self, ids: np.ndarray) -> None:
        self._parts.append(ids)
        self._held += len(ids)
        self.n_tokens += len(ids)
        if self._held >= self._capacity:
            self._flush()

    def _flush(self, closing: bool = False) -> None:
        ids = np.concatenate(self._parts)
        n = len(ids) if closing else len(ids) - len(ids) % self._capacity
        for at in range(0, n, self._capacity):
            self._write(ids[at : min(at + self._capacity, n)])
        self._parts, self._held = [ids[n:]], len(ids) - n

    def _write(self, ids: np.ndarray) -> None:
        short = -len(ids) % self._length
        sequences = pa.FixedSizeListArray.from_arrays(pa.array(np.pad(ids, (0, short))), self._length)
        which = np.zeros(len(sequences), np.int8)
        different = [np.ones(self._length, np.uint8)]
        if short:
            which[-1] = 1
            different.append((np.arange(self._length) < self._length - short).astype(np.uint8))
        different = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(different)), self._length)
        masks = pa.DictionaryArray.from_arrays(pa.array(which), different)
        self._writer.write_batch(pa.record_batch([sequences, masks], schema=self._schema))

    def close(self) -> None:
        if self._held:
            self._flush(closing=True)
        self._writer.close()


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    end_id: int,
    sequence_length: int = 2048,
    rows_per_batch: int = 32,
    shards: int | None = None,
) -> DataFrame:
    """Encode every text and write the shards in ascending doc_id order; returns the manifest.

    Documents are dealt to shards by ranges of doc_id.  A task writes under a name of its attempt and
    renames at its end, so a repeated task replaces its shard by an equal one.
    """
    spark = docs.sparkSession
    ship_code(spark)
    folder = qualified(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        encode = encoder(tokenizer_file)
        store, place = _filesystem(folder)
        name = f"{place}/shard-{shard:06d}"
        writer = sink = None
        end = np.array([end_id], encode.dtype)
        doc_ids, lengths = [], []
        for batch in batches:
            coded = encode.encode_many(batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), coded):
                if writer is None:
                    store.create_dir(place, recursive=True)
                    sink = store.open_output_stream(f"{name}.{attempt}.tokens")
                    writer = _ShardWriter(sink, sequence_length, rows_per_batch, encode.dtype)
                ids = np.concatenate([ids, end])
                writer.add(ids)
                doc_ids.append(doc_id)
                lengths.append(len(ids))
        if writer is None:
            return
        writer.close()
        sink.close()
        listed = pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(lengths, pa.int64())], schema=DOCUMENTS)
        with store.open_output_stream(f"{name}.{attempt}.documents") as sink, ipc.new_stream(sink, DOCUMENTS) as out:
            out.write_batch(listed)
        store.move(f"{name}.{attempt}.documents", f"{name}.documents.arrow")
        store.move(f"{name}.{attempt}.tokens", f"{name}.tokens.arrow")
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "file": [f"shard-{shard:06d}"], "n_documents": [len(doc_ids)], "n_tokens": [writer.n_tokens]}
        )

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(shards or shuffle_width(spark), "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


@dataclass
class TokenShard:
    """A shard opened for reading; sequences and masks are views of its mapped bytes."""

    table: pa.Table
    documents: pa.Table

    @classmethod
    def open(cls, folder: str, file: str) -> TokenShard:
        store, place = _filesystem(folder)
        path = f"{place}/{file}"
        if isinstance(store, fs.LocalFileSystem):
            source = pa.memory_map(f"{path}.tokens.arrow")
        else:
            source = store.open_input_file(f"{path}.tokens.arrow")
        with store.open_input_file(f"{path}.documents.arrow") as listed:
            documents = ipc.open_stream(listed).read_all()
        return cls(ipc.open_stream(source).read_all(), documents)

    def __len__(self) -> int:
        return self.table.num_rows

    def sequence(self, row: int) -> np.ndarray:
        return self.table.column("input_ids")[row].values.to_numpy(zero_copy_only=True)

    def mask(self, row: int) -> np.ndarray:
        return self.table.column("attention_mask")[row].value.values.to_numpy(zero_copy_only=True).view(bool)

    def _batches(self) -> Iterator[np.ndarray]:
        """The real ids of each batch; only a shard's last sequence is padded."""
        for batch in self.table.to_batches():
            ids = batch.column("input_ids").flatten().to_numpy(zero_copy_only=True)
            last = batch.column("attention_mask")[-1].value.values.to_numpy(zero_copy_only=True)
            yield ids[: len(ids) - len(last) + np.count_nonzero(last)]

    def _ends(self) -> np.ndarray:
        return np.cumsum(self.documents.column("n_tokens").to_numpy())

    def document_ends(self, row: int) -> np.ndarray:
        """The places in a sequence at which a document has its last id."""
        width = len(self.sequence(row))
        ends = self._ends() - 1 - row * width
        return ends[(ends >= 0) & (ends < width)]

    def each_document(self) -> Iterator[np.ndarray]:
        """The ids of one document after the other, a batch of sequences in memory at a time."""
        held: list[np.ndarray] = []
        ends, at = self._ends(), 0
        for ids in self._batches():
            first, last = np.searchsorted(ends, [at, at + len(ids)], "right")
            cut = 0
            for end in (ends[first:last] - at).tolist():
                yield np.concatenate([*held, ids[cut:end]])
                held, cut = [], end
            if cut < len(ids):
                held.append(ids[cut:])
            at += len(ids)
        if held:
            raise ValueError("ids after the end of the last document")


def read_token_files(spark: SparkSession, folder: str, sequence_length: int = 2048) -> DataFrame:
    """A row per document, from the files alone: where its ids start, how many they are, their CRC."""
    folder = qualified(spark, folder)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard: this window's single task sees the manifest only.
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = TokenShard.open(folder, row["file"])
                lengths, sums = [], []
                for ids in shard.each_document():
                    lengths.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                if lengths != shard.documents.column("n_tokens").to_pylist():
                    raise ValueError(f"{row['file']}: ids and document list differ")
                local = np.cumsum([0, *lengths[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        shard.documents.column("doc_id").combine_chunks(),
                        pa.array(local + row["base"], pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(sums, pa.int64()),
                        pa.array(np.full(len(lengths), row["shard"]), pa.int64()),
                        pa.array(local // sequence_length, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "first_sequence"],
                )

    return placed.repartition(shuffle_width(spark), "shard").select("shard", "file", "base").mapInArrow(read, READ)
