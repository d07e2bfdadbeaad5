"""Landed files of forms and remote catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import date_from_parts
from ..operators import polish_names
from ..schemas import ARTICLE_JSON, DATASET_JSON
from ..session import scratch_folder


def read_datasets(spark: SparkSession, path: str) -> DataFrame:
    """Data set records, one JSON object per line."""
    return spark.read.schema(DATASET_JSON).json(path)


def numbered_lines(rows: DataFrame, folder: str, name: str = "line_index") -> DataFrame:
    """``rows``, read from text files, with their place over all files, counted from 0.

    Files come by name and their splits by offset. Rows are written once below ``folder`` with the
    split they come from and a number that rises within it; rows per split are then counted and
    added up (a row per split), and each row's number is moved by its split's start. No row is
    sorted.
    """
    split = ["_file", "_start"]
    rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    ).write.parquet(folder)
    landed = rows.sparkSession.read.parquet(folder)
    sizes = landed.groupBy(*split).agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*split, "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return landed.join(starts, split).withColumn(
        name, F.col("_at") - F.col("_first") + F.col("_before")).drop(*split, "_at", "_first", "_before")


def read_articles(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """Journal articles as (doi, title, pub_date, authors, article_index). Records without authors,
    title or year (front matter) are dropped; authors are lower-case surnames. ``article_index`` is
    the record's place over all files, front matter counted; of equal matches the first article
    wins. The records are landed once below ``folder`` (default: the scratch folder)."""
    folder = folder or scratch_folder(spark, "articles", local=True)
    raw = numbered_lines(spark.read.schema(ARTICLE_JSON).json(path), f"{folder}/records", "article_index")
    date = date_from_parts(F.get(F.col("published.date-parts"), F.lit(0)))
    surnames = F.transform("author", lambda a: F.lower(F.coalesce(a["family"], F.lit(""))))
    return raw.filter((F.size("author") > 0) & (F.size("title") > 0)).select(
        F.col("DOI").alias("doi"), F.get("title", F.lit(0)).alias("title"), date.alias("pub_date"),
        surnames.alias("authors"), "article_index",
    ).filter(F.col("pub_date").isNotNull())


def read_form(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """A landed sheet (arrivals, reports, replicators) with polished column names."""
    reader = spark.read.schema(schema)
    raw = reader.csv(path, header=True, quote='"', escape='"') if fmt == "csv" else reader.json(path)
    return polish_names(raw)
