"""What the operators have in common: written tables, row locators, bounded Arrow slices."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galleyproof.session import scratch_folder

BATCH_BYTES = "8m"
LOCATOR = ["__file", "__row"]


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors share (a local one only on a local master)."""
    return scratch_folder(spark, label, local=True)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: lineage ends here, on storage all can reach."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Have Spark cut Arrow batches by bytes, so that long texts never meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def text_of(docs: DataFrame) -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def located(docs: DataFrame, folder: str, whole: bool = False) -> DataFrame:
    """``doc_id, text`` of every row of ``docs`` and its place: ``__file`` and ``__row``.

    The place identifies a row even if identifiers are null or repeat. With ``whole`` the struct
    ``__all`` holds all columns of ``docs``, so that whatever they are called, they meet no name
    used here; ``unpacked`` gives them back. A frame that isn't read from files is written below
    ``folder`` first.
    """
    def placed(df: DataFrame) -> DataFrame:
        stored = df.metadataColumn("_metadata")  # also if a column has this name
        columns = [df["doc_id"], df["text"], stored["file_path"].alias("__file"), stored["row_index"].alias("__row")]
        every = F.struct(*[df[f"`{c}`"].alias(c) for c in df.columns]).alias("__all")
        return df.select(*columns, *[every] * whole)

    try:
        return placed(docs)
    except AnalysisException:
        return placed(written(docs, f"{folder}/landed"))


def unpacked(rows: DataFrame) -> DataFrame:
    """The columns that ``located`` packed."""
    return rows.select("__all.*")


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with up to ``limit`` bytes of ``column``, one row at least."""
    start, held = 0, 0
    for i, value in enumerate(batch.column(column)):
        size = len(value.as_buffer()) if value.is_valid else 0
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)
