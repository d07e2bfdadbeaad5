"""Token ids in binary shard files: Simple-8b words with per-block offsets.

A shard holds consecutive documents. Its parts, all little-endian:

    8 bytes   magic
    words     unsigned 64-bit Simple-8b words, block after block of 1024 ids
    offsets   signed 64-bit: the first word of each block
    doc ids   signed 64-bit, then one byte each that tells whether the identifier is null
    lengths   signed 64-bit: ids of each document
    footer    four signed 64-bit: words, blocks, documents, ids
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import encode, simple8b
from .shared import bounded_batches, slices, text_of, work_folder, written

MAGIC = b"S8BSHARD"
SLICE_BYTES = 4 << 20
#: Blocks coded at a time.
RUN_BLOCKS = 1024


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ShardWriter:
    """Appends documents to one shard file; only a run of blocks and the document table are held."""

    def __init__(self, path: str):
        system, inner = _open(path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(inner)
        self.out.write(MAGIC)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_words = self.n_ids = 0
        self.offsets: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.nulls.append(nulls)
        self.lengths.append(lengths)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= RUN_BLOCKS * simple8b.BLOCK:
            self._flush(self.n_held // simple8b.BLOCK * simple8b.BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint64)
        for at in range(0, n, RUN_BLOCKS * simple8b.BLOCK):
            words, blocks = simple8b.encode(ids[at:min(n, at + RUN_BLOCKS * simple8b.BLOCK)])
            self.out.write(words.astype("<u8").tobytes())
            self.offsets.append(blocks + self.n_words)
            self.n_words += len(words)
        self.n_ids += n
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> tuple[int, int]:
        """Documents and ids of the finished file."""
        self._flush(self.n_held)
        tables = [(self.offsets, "<i8"), (self.docs, "<i8"), (self.nulls, "u1"), (self.lengths, "<i8")]
        sizes = []
        for parts, kind in tables:
            whole = np.concatenate(parts) if parts else np.zeros(0)
            sizes.append(len(whole))
            self.out.write(whole.astype(kind).tobytes())
        self.out.write(np.array([self.n_words, sizes[0], sizes[1], self.n_ids], "<i8").tobytes())
        self.out.close()
        return sizes[1], self.n_ids


class ShardReader:
    """Random access to a shard: the tables first, then ids block by block."""

    def __init__(self, path: str):
        system, inner = _open(path)
        self.file = system.open_input_file(inner)
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} isn't a shard")
        end = self.file.size() - 32
        self.n_words, blocks, docs, self.n_ids = np.frombuffer(self.file.read_at(32, end), "<i8").tolist()
        raw = self.file.read_at(8 * blocks + 17 * docs, end - 8 * blocks - 17 * docs)
        cut = [8 * blocks, 8 * blocks + 8 * docs, 8 * blocks + 9 * docs]
        self.offsets = np.frombuffer(raw[:cut[0]], "<i8")
        self.docs = np.frombuffer(raw[cut[0]:cut[1]], "<i8")
        self.nulls = np.frombuffer(raw[cut[1]:cut[2]], "u1").astype(bool)
        self.lengths = np.frombuffer(raw[cut[2]:], "<i8")

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks ``first`` up to but without ``last``."""
        start = int(self.offsets[first])
        stop = int(self.offsets[last]) if last < len(self.offsets) else self.n_words
        words = np.frombuffer(self.file.read_at(8 * (stop - start), len(MAGIC) + 8 * start), "<u8")
        n = min(last * simple8b.BLOCK, self.n_ids) - first * simple8b.BLOCK
        return simple8b.decode(words, self.offsets[first:last] - start, n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start``, reading only the blocks that hold them."""
        if not n:
            return np.zeros(0, np.uint64)
        first = start // simple8b.BLOCK
        found = self.blocks(first, -(-(start + n) // simple8b.BLOCK))
        return found[start - first * simple8b.BLOCK:][:n]

    def checksums(self) -> np.ndarray:
        """crc32 of each document's ids as unsigned 32-bit integers, in bounded memory."""
        sums, doc, left, crc = [], 0, None, 0
        for first in range(0, len(self.offsets), RUN_BLOCKS):
            raw = memoryview(self.blocks(first, min(first + RUN_BLOCKS, len(self.offsets))).astype("<u4")).cast("B")
            at = 0
            while doc < len(self.lengths):
                left = 4 * int(self.lengths[doc]) if left is None else left
                take = min(left, len(raw) - at)
                crc = zlib.crc32(raw[at:at + take], crc)
                at, left = at + take, left - take
                if left:
                    break
                sums.append(crc)
                doc, left, crc = doc + 1, None, 0
        sums += [0] * (len(self.lengths) - len(sums))  # documents without ids at the end
        return np.array(sums, np.int64)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 1) -> DataFrame:
    """Encode ``docs(doc_id, text, ...)`` into shards below ``folder`` in ascending doc_id order.

    Every whole text is encoded (null: empty) and ``end_id`` appended. Documents are dealt by
    ranges of doc_id, null first, equal identifiers by a row number, so a repeated identifier can
    spread over shards. Each task writes a file of its own name and reports it; the report is
    committed by Spark, so files of lost or repeated attempts are never read. Returns the report:
    shard, file, n_docs, n_ids, and ``start``, the ids of all shards before. Further columns are
    ignored; an empty table gives an empty report.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"),
        F.monotonically_increasing_id().alias("tie"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    tail = np.zeros(0, np.uint64) if end_id is None else np.array([end_id], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard, out, path = encode.word_ids(tokenizer), TaskContext.get().partitionId(), None, ""
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                if out is None:
                    path = f"shard-{shard:06d}-{uuid.uuid4().hex}.s8b"
                    out = ShardWriter(f"{folder}/{path}")
                ids, counts = words.flat(part.column("text"))
                ids = np.insert(ids, np.repeat(np.cumsum(counts), len(tail)), tail[0] if len(tail) else 0)
                lengths = counts + len(tail)
                doc_ids = part.column("doc_id")
                nulls = doc_ids.is_null().to_numpy(zero_copy_only=False)
                out.add(doc_ids.fill_null(0).to_numpy(), nulls, lengths, ids.astype(np.uint64))
        if out is not None:
            n_docs, n_ids = out.close()
            yield pa.record_batch(
                [pa.array([x]) for x in (shard, path, n_docs, n_ids)],
                names=["shard", "file", "n_docs", "n_ids"])

    report = dealt.drop("tie").mapInArrow(run, "shard long, file string, n_docs long, n_ids long")
    report = written(report, f"{folder}/report")
    # a row per shard, not per document
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return report.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(spark: SparkSession, folder: str, report: DataFrame) -> DataFrame:
    """Decode the reported shards: doc_id, start, n_tokens, ids_crc32 of every document."""
    n = max(1, report.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                shard = ShardReader(f"{folder}/{name}")
                before = start + np.cumsum(shard.lengths) - shard.lengths
                yield pa.record_batch(
                    [pa.array(shard.docs, pa.int64(), mask=shard.nulls), pa.array(before, pa.int64()),
                     pa.array(shard.lengths, pa.int64()), pa.array(shard.checksums(), pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return report.select("file", "start").repartition(n).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the shards and return what reading them back gives."""
    spark = docs.sparkSession
    folder = work_folder(spark, "tokens")
    return read(spark, folder, write(docs, folder, tokenizer, end_id))
