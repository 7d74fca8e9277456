"""Forward fill of sparse labels in row order."""

from pyspark.sql import DataFrame, Window, functions as F

ROWS_PER_BLOCK = 65_536


def forward_fill(
    df: DataFrame,
    value: str,
    keys: list[str],
    order: str,
    filled: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Carry the last non-null ``value`` forward within each key.

    ``order`` is a whole-number column, unique and not null within the key. A key
    may hold any number of rows, so it is never windowed as one group: rows are
    cut into blocks of at most ``rows_per_block`` order values, and each block is
    filled on its own. The value a block starts from comes from a summary with
    one row per block; only that summary is windowed by the whole key. Starting
    values enter the blocks as extra first rows, so the rows need no join and are
    shuffled and sorted once.
    """
    block = F.floor(F.col(order) / F.lit(rows_per_block)).cast("bigint")
    blocked = df.withColumn("_block", block)
    in_block = [*keys, "_block"]

    known = F.when(F.col(value).isNotNull(), F.col(order))
    ends = blocked.groupBy(*in_block).agg(F.max_by(value, known).alias("_end"))
    earlier = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = ends.withColumn("_start", F.last("_end", ignorenulls=True).over(earlier))
    first_rows = starts.filter("_start IS NOT NULL").select(
        *in_block, F.col("_start").alias(value), F.lit(True).alias("_is_start")
    )

    inside = (
        Window.partitionBy(*in_block)
        .orderBy(F.col(order).asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        blocked.withColumn("_is_start", F.lit(False))
        .unionByName(first_rows, allowMissingColumns=True)
        .withColumn(filled, F.last(value, ignorenulls=True).over(inside))
        .filter(~F.col("_is_start"))
        .drop("_block", "_is_start")
    )
