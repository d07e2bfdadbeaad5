"""Token counts in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import encode
from .shared import bounded_batches, slices, text_of

SLICE_BYTES = 4 << 20


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs(doc_id, text, ...)``.

    Counts equal the library's for the byte-level tokenizer file ``tokenizer``, without added
    special tokens. Batches hold about equally many bytes. Every text, long ones too, is split
    where white space begins, which no token spans, and each distinct piece is encoded once per
    worker while it is remembered; ids never leave the function. A null text counts as empty
    (0, 0), a null doc_id stays null, repeated rows each give a row, further columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = encode.piece_lengths(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sizes = [len(t.as_buffer()) for t in part.column("text")]
                counts = lengths.counts(part.column("text").to_pylist())
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array([c > limit for c in counts])],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
