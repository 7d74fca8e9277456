"""Exact distinct counts that can be merged: bitmaps over surrogate numbers.

A bitmap covers 32,768 successive numbers. Kept per file, sheet and year, bitmaps are united for any coarser
question without reading the rows again.
"""

from pyspark.sql import DataFrame, functions as F


def bitmaps(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """``keys, bucket, bitmap``: which numbers occur, one row per key and range of numbers. Nulls do not count."""
    known = rows.filter(F.col(number).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(number)).alias("bucket")
    return known.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("bitmap"))


def united(maps: DataFrame, keys: list[str]) -> DataFrame:
    """The bitmaps of coarser keys."""
    return maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(maps: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """How many different numbers each key has; ``keys`` may be coarser than those of the bitmaps, or none."""
    counts = united(maps, keys).select(*keys, F.bitmap_count("bitmap").alias("n"))
    return counts.groupBy(*keys).agg(F.sum("n").alias(name))
