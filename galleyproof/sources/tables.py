"""Parquet tables of a folder, and the catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES
from .files import list_folders


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Full scan of one table of a folder."""
    return spark.read.parquet(f"{path}/{name}")


def table_or_none(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    held = {folder.rsplit("/", 1)[1] for folder in list_folders(spark, path)}
    return table(spark, path, name) if name in held else None


def replace_table(df: DataFrame, path: str, name: str) -> None:
    """Create or replace a table from rows. The rows must not come from the table itself; use
    `VersionedTables` for that."""
    df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_bucketed(df: DataFrame, name: str, buckets: int, keys: list[str]) -> None:
    """A catalog table bucketed and sorted by key, so that joins on the key need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def empty(spark: SparkSession, name: str) -> DataFrame:
    """No rows, with a declared table's schema."""
    return spark.createDataFrame([], TABLES[name])


def non_empty(df: DataFrame | None) -> bool:
    """Whether a table exists and has a row; reads no more than it needs."""
    return df is not None and not df.isEmpty()


def catalog_tables(spark: SparkSession, pattern: str | None = None) -> dict[str, DataFrame]:
    """Tables and views of the current database by name, for `operators.table_stats`."""
    return {t.name: spark.table(t.name) for t in spark.catalog.listTables(pattern=pattern)}


def catalog_listing(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    """The current database's tables and views: table_name, n_rows, bytes, n_columns, is_temporary.

    Bytes are Spark's statistics of a stored table: the size of its files, or what ANALYZE found.
    A view that computes something has none (null). Rows are counted without reading columns, for
    which Parquet opens footers only.
    """
    listed = []
    for t in spark.catalog.listTables(pattern=pattern):
        df = spark.table(t.name)
        plan = df._jdf.queryExecution().optimizedPlan()
        stored = plan.getClass().getSimpleName() == "LogicalRelation"
        size = int(plan.stats().sizeInBytes()) if stored else None
        listed.append(df.agg(F.count("*").alias("n_rows")).select(
            F.lit(t.name).alias("table_name"), "n_rows", F.lit(size).cast("long").alias("bytes"),
            F.lit(len(df.columns)).alias("n_columns"), F.lit(t.isTemporary).alias("is_temporary")))
    if not listed:
        return spark.createDataFrame(
            [], "table_name string, n_rows long, bytes long, n_columns int, is_temporary boolean")
    return reduce(DataFrame.unionByName, listed)


def drop_column(df: DataFrame, col: str) -> DataFrame:
    if col not in df.columns:
        raise ValueError(f"no column {col}")
    return df.drop(col)


def describe(df: DataFrame) -> DataFrame:
    """Column names and types of a table as rows."""
    spark = df.sparkSession
    return spark.createDataFrame(df.dtypes, "column_name string, column_type string").select(
        F.col("column_name"), F.col("column_type"))
