"""Latest rows per paper.

Both filters keep rank 1 only, so Spark prunes each map partition to its best row per paper
before the shuffle: a paper with very many rounds sends a few rows, not all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row per key, the first in the given order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def latest_iteration(iterations: DataFrame) -> DataFrame:
    """The row of the highest round of each paper."""
    return latest_by(iterations, ["paper_id"], F.desc("round"))


def current_rounds(iterations: DataFrame) -> DataFrame:
    """All rows at their paper's highest round; ties stay."""
    by_round = Window.partitionBy("paper_id").orderBy(F.desc("round"))
    ranked = iterations.filter(F.col("round").isNotNull()).withColumn("_rank", F.rank().over(by_round))
    return ranked.filter("_rank = 1").drop("_rank")
