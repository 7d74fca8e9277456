"""Published long tables (REF_DATE, GEO, series label, VALUE) to facts.

Each plan is a chain of narrow steps around broadcast-size lookups, so a raw
table of any size is conformed in one scan without a shuffle.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from seriesmart import fixed_values as fixed
from seriesmart.functions import numbers, periods
from seriesmart.functions.text import has_text, trimmed
from seriesmart.operators import lookup
from seriesmart.operators.dims import seed_members
from seriesmart.operators.reshape import pivot_first
from seriesmart.schemas import INCOME_KEY, MONTHLY_KEY


@dataclass(frozen=True)
class Dims:
    """The lookups a plan conforms to.

    ``spellings`` has (label, canonical), ``members`` has (region, canonical).
    """

    geography: DataFrame
    indicators: DataFrame
    spellings: DataFrame | None = None
    members: DataFrame | None = None


@dataclass(frozen=True)
class SeriesSpec:
    """Where a published table keeps its series label and what the labels mean."""

    label_column: str
    labels: dict[str, str]
    source: str = "StatCan"
    where: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(["REF_DATE", "GEO", "VALUE", self.label_column, *self.where]))


CPI = SeriesSpec("Products and product groups", fixed.CPI_LABELS, where={"UOM": fixed.CPI_BASE})
GASOLINE = SeriesSpec(
    "Type of fuel", fixed.FUEL_LABELS, where={"Type of fuel": next(iter(fixed.FUEL_LABELS))}
)
FOOD = SeriesSpec("Products", fixed.FOOD_LABELS)
HOUSE_PRICES = SeriesSpec("New housing price indexes", fixed.HOUSE_PRICE_LABELS)


def _figures(raw: DataFrame, spec: SeriesSpec, keep: list[str]) -> DataFrame:
    for column, wanted in spec.where.items():
        raw = raw.filter(F.col(f"`{column}`") == wanted)
    return (
        raw.filter(has_text(F.col("VALUE")))
        .select(
            F.col("GEO"),
            trimmed(F.col(f"`{spec.label_column}`")).alias("series_label"),
            periods.month_id_from_text(F.col("REF_DATE")).alias("date_id"),
            numbers.safe_double(F.col("VALUE")).alias("value"),
            *keep,
        )
        .na.drop(subset=["date_id", "value"])
    )


def _with_series(figures: DataFrame, spec: SeriesSpec, dims: Dims) -> DataFrame:
    labels = lookup.fixed_table(
        figures.sparkSession, spec.labels.items(), ["series_label", "indicator_name"]
    )
    ids = lookup.series_ids(labels, dims.indicators, spec.source)
    return lookup.lookup(figures, ids, ["series_label"])


def city_series(
    raw: DataFrame, dims: Dims, spec: SeriesSpec, keep: list[str] | None = None
) -> DataFrame:
    """Consumer prices, fuel and house prices: one row per city, month and series."""
    keep = keep or []
    figures = _figures(raw, spec, keep).withColumn("label", trimmed(F.col("GEO")))
    placed = lookup.lookup(figures, lookup.place_ids(dims.spellings, dims.geography), ["label"])
    return _with_series(placed, spec, dims).select(*MONTHLY_KEY, "value", *keep)


def regional_series(
    raw: DataFrame, dims: Dims, spec: SeriesSpec, keep: list[str] | None = None
) -> DataFrame:
    """Food prices: a provincial figure stands for each of its cities."""
    keep = keep or []
    members = dims.members if dims.members is not None else seed_members(raw.sparkSession)
    names = dims.geography.select(F.col("cma_name").alias("canonical"), "geography_id")
    cities = members.join(names, "canonical").select("region", "geography_id")
    figures = _with_series(_figures(raw, spec, keep), spec, dims)
    return lookup.fan_out(figures, cities, "GEO").select(*MONTHLY_KEY, "value", *keep)


def income_facts(
    raw: DataFrame, dims: Dims, order: str, statistics: dict[str, str] = fixed.INCOME_STATISTICS
) -> DataFrame:
    """Yearly incomes: one row per city, year, income source, age group and sex.

    ``order`` is the column of row positions that decides which of several
    figures for one key is the first.
    """
    figures = (
        raw.filter(F.col("Statistics").isin(list(statistics)) & has_text(F.col("VALUE")))
        .select(
            trimmed(F.col("GEO")).alias("label"),
            periods.annual_id(numbers.safe_int(F.col("REF_DATE"))).alias("date_id"),
            trimmed(F.col("`Income source`")).alias("income_source"),
            trimmed(F.col("`Age group`")).alias("age_group"),
            trimmed(F.col("Sex")).alias("sex"),
            "Statistics",
            numbers.safe_double(F.col("VALUE")).alias("value"),
            order,
        )
        .na.drop(subset=["value"])
    )
    placed = lookup.lookup(figures, lookup.place_ids(dims.spellings, dims.geography), ["label"])
    wide = pivot_first(placed, INCOME_KEY, "Statistics", "value", order, statistics)
    return wide.withColumn("num_persons", numbers.whole_count(F.col("num_persons")))
