"""Counts and sums. Every aggregate combines map-side before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(df: DataFrame, col: str, val) -> DataFrame:
    return df.agg(F.count_if(F.col(col) == F.lit(val)).alias("count"))


def all_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: for each column, whether no row has a value."""
    return df.agg(*[(F.count(c) == 0).alias(c) for c in cols])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows. Empty means unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def last_modified(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Newest form time and newest date over the tables; the time decides when there is one."""
    watched = {
        "form_arrivals": "timestamp", "reports": "timestamp",
        "iterations": "date_with_authors", "papers": "date_with_authors",
    }
    newest = []
    for name, col in watched.items():
        if name in tables and col in tables[name].columns:
            is_time = col == "timestamp"
            newest.append(
                tables[name].agg(
                    F.max(F.col(col) if is_time else F.lit(None)).cast("timestamp_ntz").alias("t"),
                    F.max(F.lit(None) if is_time else F.col(col)).cast("date").alias("d"),
                )
            )
    best = reduce(DataFrame.unionByName, newest).agg(
        F.max("d").alias("latest_date"), F.max("t").alias("latest_datetime")
    )
    comparison = F.coalesce("latest_datetime", F.col("latest_date").cast("timestamp_ntz"))
    return best.withColumn("comparison_timestamp", comparison)


def package_sizes(manifest: DataFrame) -> DataFrame:
    """Files, bytes, MB and GB (two digits) per package."""
    total = F.coalesce(F.sum("size"), F.lit(0))
    return manifest.groupBy("package").agg(
        F.count("*").alias("n_files"),
        total.alias("bytes"),
        (total / 1024**2).alias("size_mb"),
        F.bround(total / 1024**3, 2).alias("size_gb"),
    )


def largest_files(manifest: DataFrame) -> DataFrame:
    """Files with size in GB, largest first."""
    return manifest.withColumn("size_gb", F.col("size") / 1024**3).orderBy(F.desc("size"), "path")


def table_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def non_empty_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each table has a row; at most one row of each reaches the count."""
    probes = [
        df.limit(1).agg((F.count("*") > 0).alias("non_empty")).select(F.lit(name).alias("table_name"), "non_empty")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, probes)
