"""Conforming lookups: names to ids, regions to members, missing references.

Size policy. Tables built from fixed values are bounded by the source text and
are broadcast by hint. Every other lookup table is joined without a hint: Spark
compares its size with spark.sql.autoBroadcastJoinThreshold (again at run time,
under adaptive execution) and falls back to a shuffled join, where adaptive
execution splits hot keys.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart.functions.text import trimmed


def constants(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """A table of constants written in the program, text and whole numbers.

    Sent as Arrow it is a local relation, which Spark sizes exactly and joins
    and filters without a job.
    """
    columns = zip(*rows)
    arrays = [
        pa.array(column, pa.int32() if all(isinstance(v, int) for v in column) else pa.string())
        for column in columns
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=names))


def fixed_table(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """Constants to be broadcast: their size is bounded by the program text."""
    return F.broadcast(constants(spark, rows, names))


def lookup(df: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``df`` with a lookup table that is unique on ``on``."""
    return df.join(table, on, how)


def canonical(df: DataFrame, spellings: DataFrame, label: str, **options) -> DataFrame:
    """Replace a published label by its canonical name; unknown labels drop out.

    ``spellings`` has the columns (label, canonical).
    """
    named = df.withColumn("label", trimmed(F.col(label)))
    return lookup(named, spellings, ["label"], **options).drop("label")


def place_ids(spellings: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """(label, geography_id) for every known spelling of a place with an id.

    Joining the two small tables first leaves the large side one lookup.
    """
    names = dim_geography.select(F.col("cma_name").alias("canonical"), "geography_id")
    return spellings.join(names, "canonical").select("label", "geography_id")


def series_ids(labels: DataFrame, dim_indicator: DataFrame, source: str) -> DataFrame:
    """(series_label, indicator_id) for the labels of one source."""
    ids = dim_indicator.filter(F.col("source") == source).select("indicator_name", "indicator_id")
    return labels.join(ids, "indicator_name").select("series_label", "indicator_id")


def add_ids(
    df: DataFrame, ids: DataFrame, on: list[str], id_column: str, on_missing: str = "drop"
) -> DataFrame:
    """Attach a surrogate key; rows without one drop out or fail the job.

    Failing happens inside the plan, so it costs no second pass.
    """
    if on_missing == "drop":
        return df.join(ids, on)
    if on_missing != "fail":
        raise ValueError(f"on_missing must be 'drop' or 'fail', not {on_missing!r}")
    shown = F.concat_ws(", ", *(F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in on))
    problem = F.raise_error(F.concat(F.lit(f"no {id_column} for: "), shown)).cast("int")
    return df.join(ids, on, "left").withColumn(id_column, F.coalesce(F.col(id_column), problem))


def missing_references(df: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """The distinct keys of ``df`` that have no row in ``dim``."""
    return df.select(*on).distinct().join(dim, on, "left_anti")


def fan_out(df: DataFrame, members: DataFrame, region: str) -> DataFrame:
    """Copy each regional row to every member of its region.

    ``members`` has the columns (region, member id); regions without members and
    members without an id are absent from it, so their rows drop out.
    """
    keyed = df.withColumn("region", trimmed(F.col(region)))
    return keyed.join(members, "region").drop("region")
