"""Dimension builders: insert-if-absent with stable ids, and the calendar."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart import fixed_values as fixed
from seriesmart.functions import periods
from seriesmart.operators.lookup import constants
from seriesmart.operators.numbering import number_rows
from seriesmart.operators.upsert import as_layout, latest_per_key, without_matched
from seriesmart.schemas import DIM_DATE, DIM_GEOGRAPHY, DIM_INDICATOR


def absent_rows(new: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct new rows whose natural key the dimension does not have."""
    return without_matched(latest_per_key(new, keys, []), dim, keys)


def insert_absent(dim: DataFrame, new: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """Add unknown natural keys with fresh ids; ids already given never change."""
    highest = F.coalesce(dim.agg(F.max(id_column)).scalar(), F.lit(0))
    added = number_rows(absent_rows(new, dim, keys), keys, id_column, after=highest)
    return dim.unionByName(added.select(*dim.columns))


def calendar_rows(years: DataFrame) -> DataFrame:
    """Twelve monthly rows and one annual row (month 0) per row of ``years``."""
    days = years.select("year", F.explode(F.sequence(F.lit(0), F.lit(12))).alias("month"))
    month = F.col("month")
    return as_layout(
        days.select(
            periods.month_id(F.col("year"), month).alias("date_id"),
            "year",
            "month",
            periods.quarter_of_month(month).alias("quarter"),
            (month == 0).alias("is_annual"),
        ),
        DIM_DATE,
    )


def calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    span = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return calendar_rows(span)


def calendar_for(facts: DataFrame, date_id: str = "date_id") -> DataFrame:
    """A calendar that covers every year of the facts, so no fact loses its date."""
    ends = facts.agg(F.min(date_id).alias("low"), F.max(date_id).alias("high"))
    span = F.sequence(periods.year_of(F.col("low")), periods.year_of(F.col("high")))
    return calendar_rows(ends.filter("low IS NOT NULL").select(F.explode(span).alias("year")))


def seed_geography(spark: SparkSession) -> DataFrame:
    rows = [(at, *row) for at, row in enumerate(fixed.CITIES, start=1)]
    return constants(spark, rows, DIM_GEOGRAPHY.fieldNames())


def seed_indicators(spark: SparkSession) -> DataFrame:
    rows = [(at, *row) for at, row in enumerate(fixed.INDICATORS, start=1)]
    return constants(spark, rows, DIM_INDICATOR.fieldNames())


def seed_spellings(spark: SparkSession) -> DataFrame:
    rows = [(label, name) for name, labels in fixed.CITY_SPELLINGS.items() for label in labels]
    return constants(spark, rows, ["label", "canonical"])


def seed_members(spark: SparkSession) -> DataFrame:
    rows = [(region, name) for region, names in fixed.PROVINCE_MEMBERS.items() for name in names]
    return constants(spark, rows, ["region", "canonical"])
