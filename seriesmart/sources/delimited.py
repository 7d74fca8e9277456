"""Delimited text: every column is read as text and cast on purpose."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from seriesmart.functions.periods import year_in_text
from seriesmart.functions.text import trimmed


def _csv(spark: SparkSession, quoted_line_ends: bool = False):
    """A reader that fails rather than misreads.

    Every file's header must be that of the first, and every record as long as it. Files are split
    at line ends, so a record with a line end in quotes is too short and fails, unless
    ``quoted_line_ends`` says that there are such: then each file is read by one task.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("encoding", "UTF-8")
    reader = reader.option("enforceSchema", False).option("mode", "FAILFAST").option("columnPruning", False)
    return reader.option("multiLine", quoted_line_ends)


def read_text_table(
    spark: SparkSession, path, columns: list[str] | None = None, quoted_line_ends: bool = False, **more: Column
) -> DataFrame:
    """A published table with a header row (and perhaps a byte order mark).

    Columns are taken by name. Parts with another header, records of another length and,
    unless ``quoted_line_ends``, line ends in quotes fail. ``more`` are columns
    to compute beside them, which may use the ``_metadata`` of files.
    """
    table = _csv(spark, quoted_line_ends).csv(path)
    added = [column.alias(name) for name, column in more.items()]
    return table.select(*(F.col(f"`{c}`") for c in columns or table.columns), *added)


def typed(table: DataFrame, layout: StructType) -> DataFrame:
    """Text columns, found by name, as the declared types: blanks are NULL, bad text fails."""
    return table.select(
        *(
            F.when(trimmed(F.col(f"`{field.name}`")) != "", F.col(f"`{field.name}`"))
            .cast(field.dataType)
            .alias(field.name)
            for field in layout.fields
        )
    )


def text_layout(layout: StructType) -> StructType:
    return StructType([StructField(name, StringType()) for name in layout.fieldNames()])


def _named(spark: SparkSession, path) -> DataFrame:
    """All columns as text under the names of the header; files that disagree on it fail."""
    return _csv(spark).csv(path)


def read_records(spark: SparkSession, path, layout: StructType) -> DataFrame:
    """Normalised records, by column name; a path that does not exist yields no rows."""
    try:
        return typed(_named(spark, path), layout)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], layout)


def read_yearly(
    spark: SparkSession,
    path,
    layout: StructType,
    pattern: str = r"(20\d{2})",
    written_in: str = "file_name",
) -> DataFrame:
    """Many files of one shape, each row with the year written in its file's name (or path)."""
    named = _named(spark, path).select("*", F.col(f"_metadata.{written_in}").alias("_written_in"))
    year = year_in_text(F.col("_written_in"), pattern).cast("string").alias("file_year")
    return typed(named.select("*", year), StructType([*layout.fields, StructField("file_year", IntegerType())]))


def read_staging(spark: SparkSession, path, layout: StructType) -> DataFrame:
    """Rows ready to load: blanks become NULL, text is cast to the declared types."""
    return typed(_csv(spark).schema(text_layout(layout)).csv(path), layout)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_snapshot(df: DataFrame, root: str, key: str, day: str) -> str:
    """A CSV export under the dated name ``root/key/day``, where :mod:`snapshots` finds the newest."""
    path = f"{root.rstrip('/')}/{key}/{day}"
    export_csv(df, path)
    return path
