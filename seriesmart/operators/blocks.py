"""What stands before a row in its series, without ever windowing a whole series.

A series (all rows of a key) is cut into blocks of its order. Rows look back within their
block; what a block begins with comes from a summary with one row per block. So a series with a third of
all rows is many small groups.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F


def last_known(
    df: DataFrame, known: dict[str, Column], keys: list[str], order: list[str], width: int, strict: bool = False
) -> DataFrame:
    """Adds columns: each of ``known`` as it was, when last not null, at a row or before it.

    ``order`` begins with a whole-number column that is never null, of which a block has ``width`` values; rows
    of a key are told apart by all of it. With ``strict`` the row itself does not count. A
    summary of each block becomes the first row of the next ones, so rows are shuffled and
    sorted once and meet no join.
    """
    in_block, names = [*keys, "_block"], list(known)
    blocked = df.withColumn("_block", F.floor(F.col(order[0]) / F.lit(width)).cast("bigint"))
    blocked = blocked.withColumns({f"_own_{name}": column for name, column in known.items()} | {"_is_start": F.lit(False)})

    def held(name: str) -> Column:
        return F.max_by(f"_own_{name}", F.when(F.col(f"_own_{name}").isNotNull(), F.struct(*order)))

    ends = blocked.groupBy(*in_block).agg(*(held(name).alias(f"_end_{name}") for name in names))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        *in_block,
        *(F.last(f"_end_{name}", ignorenulls=True).over(earlier).alias(f"_own_{name}") for name in names),
        F.lit(True).alias("_is_start"),
    )
    inside = (
        Window.partitionBy(*in_block)
        .orderBy(F.col("_is_start").desc(), *order)
        .rowsBetween(Window.unboundedPreceding, -1 if strict else Window.currentRow)
    )
    looked = {name: F.last(f"_own_{name}", ignorenulls=True).over(inside) for name in names}
    every = blocked.unionByName(starts, allowMissingColumns=True).withColumns(looked)
    return every.filter(~F.col("_is_start")).drop("_block", "_is_start", *(f"_own_{name}" for name in names))


def islands(df: DataFrame, keys: list[str], index: str, width: int) -> DataFrame:
    """``keys, first, last, held, missing_before``: the runs of successive numbers in each series.

    ``index`` is a whole number, once per series. ``missing_before`` counts the
    numbers between a run and the one before it; null for the first run.
    """
    back = last_known(df, {"_before": F.col(index)}, keys, [index], width, strict=True)
    starts = F.col("_before").isNull() | (F.col("_before") + 1 < F.col(index))
    marked = last_known(
        back,
        {"_run": F.when(starts, F.struct(F.col(index).alias("first"), (F.col(index) - F.col("_before") - 1).alias("missing_before")))},
        keys,
        [index],
        width,
    )
    return marked.groupBy(*keys, "_run").agg(F.max(index).alias("last"), F.count("*").alias("held")).select(
        *keys, "_run.first", "last", "held", "_run.missing_before"
    )
