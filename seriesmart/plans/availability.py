"""What the mart holds: the years of each indicator family."""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from seriesmart import fixed_values as fixed
from seriesmart.functions import periods
from seriesmart.functions.text import availability_line, or_no_data
from seriesmart.operators.blocks import islands

PERIODS_PER_BLOCK = 240


@dataclass(frozen=True)
class Family:
    """A named group of indicators: a LIKE pattern or a list of names, maybe one month."""

    name: str
    title: str
    names: str | list[str]
    month: int | None = None
    grain: str = "monthly"

    def holds(self) -> Column:
        indicator = F.col("indicator_name")
        fits = indicator.like(self.names) if isinstance(self.names, str) else indicator.isin(self.names)
        return fits if self.month is None else fits & (F.col("month") == self.month)


PUBLISHED_FAMILIES = [Family(*row) for row in fixed.FAMILIES]


def used_dates(facts: DataFrame) -> DataFrame:
    """The (indicator, date) pairs with a fact: a few rows per indicator, whatever the facts."""
    return facts.select("indicator_id", "date_id").distinct()


def family_years(
    facts: DataFrame, dim_indicator: DataFrame, dim_date: DataFrame, families: Iterable[Family]
) -> DataFrame:
    """(family, title, grain, min_year, max_year), one row per family, empty ones too.

    One scan of two fact columns serves all families. Facts are reduced before
    they meet the dimensions.
    """
    families = list(families)
    dated = (
        used_dates(facts)
        .join(dim_indicator.select("indicator_id", "indicator_name"), "indicator_id")
        .join(dim_date.select("date_id", "year", "month"), "date_id")
    )
    ends = []
    for at, family in enumerate(families):
        year = F.when(family.holds(), F.col("year").cast("int"))
        ends += [F.min(year).alias(f"low_{at}"), F.max(year).alias(f"high_{at}")]
    rows = F.array(
        *(
            F.struct(
                F.lit(family.name).alias("family"),
                F.lit(family.title).alias("title"),
                F.lit(family.grain).alias("grain"),
                F.col(f"low_{at}").alias("min_year"),
                F.col(f"high_{at}").alias("max_year"),
            )
            for at, family in enumerate(families)
        )
    )
    return dated.agg(*ends).select(F.inline(rows))


def annual_years(facts: DataFrame, family: str, title: str, grain: str = "annual") -> DataFrame:
    """The same row for a yearly fact table, whose date ids carry the year."""
    year = periods.year_of(F.col("date_id"))
    return facts.agg(F.min(year).alias("min_year"), F.max(year).alias("max_year")).select(
        F.lit(family).alias("family"),
        F.lit(title).alias("title"),
        F.lit(grain).alias("grain"),
        "min_year",
        "max_year",
    )


def availability_report(years: DataFrame) -> DataFrame:
    """Printed form: absent years read "(no data)"."""
    low, high = or_no_data(F.col("min_year")), or_no_data(F.col("max_year"))
    return years.select(
        "family",
        low.alias("min_year"),
        high.alias("max_year"),
        availability_line(F.col("title"), low, high, F.col("grain")).alias("line"),
    )


def mart_report(mart) -> DataFrame:
    """The nine published families over an opened mart.

    They come from the dates that the mart keeps beside its facts, without reading a fact; in a mart
    without them, from one scan of the monthly fact and one of incomes.
    """
    dates = mart.monthly if mart.dates is None else mart.dates
    incomes = mart.income if mart.income_dates is None else mart.income_dates
    years = family_years(dates, mart.indicators, mart.calendar, PUBLISHED_FAMILIES)
    return availability_report(years.unionByName(annual_years(incomes, *fixed.INCOME_FAMILY)))


def indicator_years(facts: DataFrame, dim_indicator: DataFrame) -> DataFrame:
    """(indicator_name, min_year, max_year) of every indicator; NULL years when it has no facts."""
    year = periods.year_of(F.col("date_id"))
    held = facts.groupBy("indicator_id").agg(F.min(year).alias("min_year"), F.max(year).alias("max_year"))
    names = dim_indicator.select("indicator_id", "indicator_name")
    return names.join(held, "indicator_id", "left").select("indicator_name", "min_year", "max_year")


def what_is_available(requests: DataFrame, years: DataFrame) -> DataFrame:
    """Requests (indicator_name, year) answered by the years held and whether this one is."""
    year = F.col("year")
    inside = F.coalesce(year.between(F.col("min_year"), F.col("max_year")), F.lit(False))
    return requests.join(years, "indicator_name", "left").select(
        "indicator_name",
        "year",
        inside.alias("in_range"),
        or_no_data(F.col("min_year")).alias("min_year"),
        or_no_data(F.col("max_year")).alias("max_year"),
    )


def _index(date_id: Column, frequency: Column) -> Column:
    """Successive whole numbers for successive periods: months, quarters or years."""
    year, month = periods.year_of(date_id), periods.month_of(date_id)
    quarter = F.greatest(periods.quarter_of_month(month), F.lit(1))
    return (
        F.when(frequency == "annual", year)
        .when(frequency == "quarterly", year * 4 + quarter - 1)
        .otherwise(year * 12 + F.greatest(month, F.lit(1)) - 1)
    )


def _date_id(index: Column, frequency: Column) -> Column:
    """The date of a period: its year, the last month of its quarter, or its month."""
    quarter = F.floor(index / 4) * 100 + (F.pmod(index, F.lit(4)) + 1) * 3
    month = F.floor(index / 12) * 100 + F.pmod(index, F.lit(12)) + 1
    return F.when(frequency == "annual", index * 100).when(frequency == "quarterly", quarter).otherwise(month).cast("int")


def coverage(mart, by_city: bool = False) -> DataFrame:
    """``indicator_name, source[, cma_name], first, last, held, missing_before``: the spans that each
    indicator (or each city's series of it) holds without a gap, as date ids.

    Gaps are counted in the indicator's own periods: months, quarters or years, so a yearly survey in October has
    none between two years. Facts are reduced to distinct periods before they are put in order, and a series is
    cut into blocks of PERIODS_PER_BLOCK.
    """
    keys = ["indicator_id", "geography_id"] if by_city else ["indicator_id"]
    names = mart.indicators.select("indicator_id", "indicator_name", "source", F.lower("frequency").alias("frequency"))
    facts = mart.monthly if by_city or mart.dates is None else mart.dates
    dated = facts.select(*keys, "date_id").distinct().join(names, "indicator_id")
    held = dated.select(*keys, _index(F.col("date_id"), F.col("frequency")).alias("index")).distinct()
    spans = islands(held, keys, "index", PERIODS_PER_BLOCK).join(names, "indicator_id")
    shown = ["indicator_name", "source"]
    if by_city:
        spans = spans.join(mart.geography.select("geography_id", "cma_name"), "geography_id")
        shown.append("cma_name")
    ends = (_date_id(F.col(end), F.col("frequency")).alias(end) for end in ("first", "last"))
    return spans.select(*shown, *ends, "held", "missing_before")


def coverage_report(mart, by_city: bool = False) -> DataFrame:
    """One line per indicator (or series) with all its spans, such as "201901–202012, 202201–202412 (12 missing)"."""
    spans = coverage(mart, by_city)
    keys = [name for name in ("indicator_name", "source", "cma_name") if name in spans.columns]
    line = F.concat(F.col("first").cast("string"), F.lit("–"), F.col("last").cast("string"))
    found = spans.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("first", line.alias("line")))).alias("spans"),
        F.coalesce(F.sum("missing_before"), F.lit(0)).alias("missing"),
    )
    text = F.array_join(F.col("spans.line"), ", ")
    note = F.when(F.col("missing") > 0, F.concat(F.lit(" ("), F.col("missing").cast("string"), F.lit(" missing)"))).otherwise("")
    return found.select(*keys, "missing", F.concat(text, note).alias("line"))
