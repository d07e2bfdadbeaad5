"""Packing documents into fixed windows of tokens, best fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import encode
from .shared import bounded_batches, slices, text_of, work_folder, written

SLICE_BYTES = 4 << 20
#: Pieces that one task packs together.
GROUP_PIECES = 20_000


class OpenWindows:
    """Open windows in a segment tree over the remaining capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, left: int, by: int) -> None:
        node = self.leaves + left
        while node:
            self.counts[node] += by
            node >>= 1

    def push(self, window: int, left: int) -> None:
        if left:
            self.windows[left].append(window)
            self._add(left, 1)

    def pop_tightest(self, size: int) -> tuple[int, int] | None:
        """The window with the least remaining capacity of at least ``size``, and that capacity."""
        node = self.leaves + size
        if not self.counts[node]:
            # climb to the first subtree on the right that holds a window, then go down its left
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        left = node - self.leaves
        self._add(left, -1)
        return self.windows[left].pop(), left


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece; ``lengths`` must not rise and none exceed ``capacity``."""
    free, windows, offsets, used = OpenWindows(capacity), [], [], 0
    for size in lengths:
        found = free.pop_tightest(size)
        if found is None:
            window, left, used = used, capacity, used + 1
        else:
            window, left = found
        windows.append(window)
        offsets.append(capacity - left)
        free.push(window, left - size)
    return windows, offsets


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Every document cut into full windows and one shorter rest.

    Columns: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, the ids of the piece
    (``ids``, little-endian unsigned 32-bit). A document's tokens include ``end_id`` after it.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"))
    end = np.uint32(end_id).tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encode.word_ids(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                at, start, length, crc, tokens, ids = [], [], [], [], [], []
                for i, raw in enumerate(words.ids(part.column("text"))):
                    raw += end
                    for k in range(0, len(raw), step):
                        piece = raw[k:k + step]
                        at.append(i)
                        start.append(k // 4)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        tokens.append(len(raw) // 4)
                        if with_ids:
                            ids.append(piece)
                out = [part.column("doc_id").take(pa.array(at, pa.int64()))]
                out += [pa.array(x, pa.int64()) for x in (start, length, crc, tokens)]
                yield pa.record_batch(
                    out + [pa.array(ids, pa.binary())] * with_ids,
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)

    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return rows.mapInArrow(run, fields + (", ids binary" if with_ids else ""))


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, with_ids: bool = False,
    group_pieces: int = GROUP_PIECES, folder: str | None = None,
) -> DataFrame:
    """One row per piece of ``docs(doc_id, text, ...)`` with its ``sequence_id`` and ``offset``.

    Overlong documents give full windows, which are sequences of their own; the rests are dealt by
    the hash of their place into groups of about ``group_pieces`` (their number grows with the
    input) and each group is packed best fit decreasing, so only a group's last windows stay open.
    Offsets of a sequence are gapless from 0. Ties in length are ordered by doc_id (nulls last) and
    start. A null or empty text is one piece, its end id; repeated rows are packed as often as they
    occur. An empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "packing")
    cut = written(pieces(docs, tokenizer, capacity, end_id, with_ids), f"{folder}/pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    narrow = cut.withColumn("group", F.pmod(place, F.lit(groups)))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
        windows, offsets = best_fit(group["length"].tolist(), capacity)
        number = (np.int64(key[0]) << 32) + np.asarray(windows, np.int64)
        return group.drop(columns="group").assign(sequence_id=number, offset=np.asarray(offsets, np.int64))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return narrow.groupBy("group").applyInPandas(run, f"{fields}, sequence_id long, offset long")
