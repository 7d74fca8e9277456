"""Unpivot by position or by header, and pivot of the first figure."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from seriesmart.functions.numbers import safe_int
from seriesmart.operators.fill import ROWS_PER_BLOCK

YEAR_PLACE = StructType([StructField("position", IntegerType()), StructField("year", IntegerType())])


def cell(position: int) -> Column:
    """A cell of the grid row; NULL when the row is too short."""
    return F.get(F.col("cells"), F.lit(position))


def unpivot_positions(
    grid: DataFrame, positions: dict[int, str], keep: list[str], name: str, value: str
) -> DataFrame:
    """One row per (grid row, listed position). A narrow step: no shuffle, no join."""
    pairs = F.array(
        *(F.struct(F.lit(label).alias(name), cell(at).alias(value)) for at, label in positions.items())
    )
    return grid.select(*keep, F.inline_outer(pairs))


def header_years(header: Column, first: int = 2000, last: int = 2100) -> Column:
    """(position, year) of every header cell that reads as a year."""
    marked = F.transform(
        header, lambda text, at: F.struct(at.alias("position"), safe_int(text).alias("year"))
    )
    return F.filter(marked, lambda pair: pair["year"].between(first, last))


def unpivot_by_header(
    grid: DataFrame, header_row: int, value: str = "text", rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Unpivot each sheet by the years found in its own header row.

    The header of a sheet is one small row, so it meets the data rows before
    they are multiplied; there is no discovery on the driver. Whether it is
    broadcast is left to Spark: the number of sheets grows with the input. A sheet
    may hold any number of rows, so its rows meet the header in blocks of at most
    ``rows_per_block`` row numbers: the header goes to each block that has rows. A sheet
    whose header row holds no year fails; so does one without a header row.
    """
    found = header_years(F.col("cells"))
    where = F.concat_ws(" / ", "file", "sheet")
    empty = F.raise_error(F.concat(F.lit("no year in the header of "), where)).cast(ArrayType(YEAR_PLACE))
    headers = grid.filter(F.col("row_idx") == header_row).select(
        "file", "sheet", F.when(F.size(found) > 0, found).otherwise(empty).alias("years")
    )
    block = F.floor(F.col("row_idx") / F.lit(rows_per_block)).cast("bigint")
    data = grid.filter(F.col("row_idx") > header_row).withColumn("_block", block)
    held = data.select("file", "sheet", "_block").distinct().join(headers, ["file", "sheet"])
    lost = F.raise_error(F.concat(F.lit("no header row in "), where)).cast(ArrayType(YEAR_PLACE))
    columns = data.join(held, ["file", "sheet", "_block"], "left").select(
        "file", "sheet", "row_idx", "cells", F.explode(F.coalesce("years", lost)).alias("column")
    )
    text = F.get(F.col("cells"), F.col("column.position"))
    return columns.select(
        "file", "sheet", "row_idx", cell(0).alias("label"), "column.year", text.alias(value)
    )


def pivot_first(
    df: DataFrame,
    keys: list[str],
    name: str,
    value: str,
    order: str,
    measures: dict[str, str],
) -> DataFrame:
    """Rows to measure columns, keeping the first non-null figure in ``order``.

    All measures come from one aggregation with map-side combining, so a hot key
    is reduced before the single shuffle. Every measure column exists whether or
    not its name occurs. Groups without any figure, or with a null key, drop out.
    """
    figures = df.filter(F.col(value).isNotNull()).na.drop(subset=keys)
    figures = figures.filter(F.col(name).isin(list(measures)))
    firsts = [
        F.min_by(F.col(value), F.when(F.col(name) == label, F.col(order))).alias(column)
        for label, column in measures.items()
    ]
    return figures.groupBy(*keys).agg(*firsts)


def outer_merge(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join of two measure sets, each unique on ``on``."""
    return left.join(right, on, "full")
