"""Dense surrogate numbers without sorting everything in one task."""

from pyspark.sql import DataFrame, Window, functions as F

PREFIX_DIGITS = 3  # 16**3 buckets


def number_rows(df: DataFrame, keys: list[str], id_column: str, after=None) -> DataFrame:
    """Number the rows 1, 2, ... in the order of the MD5 digest of their key.

    ``keys`` is unique in ``df``, a dimension: ids are INT and fail above 2**31, and each
    task sorts 1/4096 of the rows. The digest spreads the keys evenly over 4096
    buckets; rows are numbered inside their bucket, and the start of each bucket
    comes from the bucket sizes, a table of at most 4096 rows (hence the hint).
    ``after`` is a Column with the highest number already given.
    """
    text = F.concat_ws("\x1f", *(F.col(key).cast("string") for key in keys))
    tagged = df.withColumn("_digest", F.md5(text)).withColumn(
        "_bucket", F.substring("_digest", 1, PREFIX_DIGITS)
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tagged.groupBy("_bucket")
        .agg(F.count("*").alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", *keys))
    base = F.lit(0) if after is None else after
    return (
        tagged.withColumn("_place", place)
        .join(F.broadcast(starts), "_bucket")
        .withColumn(id_column, (base + F.col("_start") + F.col("_place")).cast("int"))
        .drop("_digest", "_bucket", "_place", "_start")
    )
