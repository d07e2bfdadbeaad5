"""Joins whose hot keys can be split at run time."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_tag(keys: list[str]) -> Column:
    """A hash that is equal for equal keys; through text, so that integer widths do not matter."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def key_match(left: list[str], right: list[str], null_safe: bool) -> Column:
    """Equality of two lists of distinct column names."""
    pairs = [
        F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)
        for a, b in zip(left, right, strict=True)
    ]
    return reduce(and_, pairs)


def split_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """An equality join for a left side with hot keys and a right side reduced to one row per key.

    Spark would reuse the reduction's partitioning on the keys and then cannot split a hot one.
    The hash as a further join key makes it shuffle both sides for the join, which adaptive
    execution may split. A small right side is still broadcast. With ``null_safe`` null keys meet.
    """
    theirs = [f"_right_{k}" for k in keys]
    right = right.withColumnsRenamed(dict(zip(keys, theirs))).withColumn("_right_tag", key_tag(theirs))
    match = key_match(keys, theirs, null_safe) & (key_tag(keys) == F.col("_right_tag"))
    return left.join(right, match, how).drop(*theirs, "_right_tag")


#: Rows of a file, or places of a sieve, that share a bitmap of 512 bytes. Spark copies the bitmap for each bit read.
BITMAP_ROWS = 4096
#: Places of a sieve, a bit each (16 MB). Made of 8 million keys it lets 6 % of all other keys through.
SIEVE_PLACES = 1 << 27


def _block_and_bit(place: Column) -> list[Column]:
    return [F.shiftright(place, 12).alias("_block"), place.bitwiseAND(F.lit(BITMAP_ROWS - 1)).alias("_bit")]


def _bitmaps(bits: DataFrame, *by: str) -> DataFrame:
    """A bitmap of ``_bit`` per ``by``. Bits meet before they are put together, so no task sends
    almost empty bitmaps."""
    whole = F.bitmap_construct_agg("_bit")
    return bits.repartition(*by).groupBy(*by).agg(F.substring(whole, 1, BITMAP_ROWS // 8).alias("_bits"))


def _bit_is_set() -> Column:
    """Whether ``_bits`` has ``_bit``; false without a bitmap."""
    byte = "ascii(decode(substring(_bits, CAST(shiftright(_bit, 3) AS INT) + 1, 1), 'ISO-8859-1'))"
    return F.coalesce(F.expr(f"shiftright({byte}, CAST(_bit & 7 AS INT)) & 1 = 1"), F.lit(False))


def sieve(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``df`` without most of the rows whose key isn't among ``keys``; all whose key is are kept.

    A key's hash is a place in a bitmap of fixed size, which is broadcast. An inner join to what is
    left shuffles few rows of a large table (Spark moves a semi join to before the sieve).
    """
    at = _block_and_bit(key_tag(on).bitwiseAND(F.lit(SIEVE_PLACES - 1)))
    maps = _bitmaps(keys.select(*at), "_block")
    met = df.select("*", *at).join(F.broadcast(maps), "_block").filter(_bit_is_set())
    return met.select(*[F.col(f"`{c}`") for c in df.columns])


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` is a table as read from files whose rows have a place (Parquet)."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if plan.getClass().getSimpleName() != "LogicalRelation" or "_metadata" in df.columns:
        return False
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    return True


def key_marked(df: DataFrame, keys: DataFrame, on: list[str], mark: str, folder: str | None = None) -> DataFrame:
    """``df`` with a boolean column ``mark``: whether a row's key is among ``keys`` (null keys never are).

    Of a stored table only keys that pass a `sieve` are shuffled, with each row's file and place.
    What meets a key becomes a bit of a bitmap per 4,096 rows of a file; the table is scanned
    beside these, so that its wide rows don't move however many keys there are. The bitmaps are
    broadcast: a bit per row, 25 MB for 200 million, and the file's name per bitmap; they land in ``folder`` if one is given, for
    more than one use. ``keys`` is read twice. Any other frame is joined by `split_join`.
    """
    keys = keys.select(*on)
    if not is_stored(df):
        found = keys.distinct().withColumn(mark, F.lit(True))
        return split_join(df, found, on, "left").withColumn(mark, F.coalesce(mark, F.lit(False)))
    file, row = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index")
    places = sieve(df.select(*on, file, row.alias("_row")), keys, on)
    met = split_join(places, keys.distinct(), on).select("_file", *_block_and_bit(F.col("_row")))
    bits = _bitmaps(met, "_file", "_block")
    if folder:
        bits.write.parquet(folder)
        bits = df.sparkSession.read.schema(bits.schema).parquet(folder)
    placed = df.select("*", file, *_block_and_bit(row)).join(F.broadcast(bits), ["_file", "_block"], "left")
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], _bit_is_set().alias(mark))


def key_rows(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys`` ("left_semi") or isn't ("left_anti").

    Of a stored table only keys are shuffled (`key_marked`). Any other frame is joined by
    `split_join`.
    """
    if not is_stored(df):
        return split_join(df, keys, [key], how)
    return key_marked(df, keys, [key], "_met").filter("_met" if how == "left_semi" else "NOT _met").drop("_met")
