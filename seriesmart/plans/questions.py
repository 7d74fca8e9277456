"""Questions over the mart, as parameterised DataFrame functions."""

from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesmart import fixed_values as fixed
from seriesmart.functions import periods
from seriesmart.operators import nearest
from seriesmart.operators.blocks import last_known

QUERY_BYTES = 32 << 20
PLACES_PER_YEAR = 13  # the annual value, then twelve months


@dataclass(frozen=True)
class Mart:
    """Dimensions, facts, and, where the mart keeps them, the dates that the facts have (per indicator, and of incomes)."""

    geography: DataFrame
    indicators: DataFrame
    calendar: DataFrame
    monthly: DataFrame
    income: DataFrame | None = None
    tenure: DataFrame | None = None
    dates: DataFrame | None = None
    income_dates: DataFrame | None = None


def series(
    mart: Mart,
    indicators: list[str] | None = None,
    cities: list[str] | None = None,
    source: str | None = None,
) -> DataFrame:
    """Facts with names, source, unit and period attached.

    Names are filtered on the dimensions, which Spark broadcasts while they are
    small, so facts of other series drop out during their scan. Two sources may have an
    indicator of one name; ``source`` tells them apart.
    """
    names = of_source(mart, source).drop("category")
    places = mart.geography.select("geography_id", "cma_name")
    if indicators is not None:
        names = names.filter(F.col("indicator_name").isin(indicators))
    if cities is not None:
        places = places.filter(F.col("cma_name").isin(cities))
    dates = mart.calendar.select("date_id", "year", "month", "quarter", "is_annual")
    return (
        mart.monthly.select("geography_id", "date_id", "indicator_id", "value")
        .join(names, "indicator_id")
        .join(places, "geography_id")
        .join(dates, "date_id")
    )


def of_source(mart: Mart, source: str | None) -> DataFrame:
    return mart.indicators if source is None else mart.indicators.filter(F.col("source") == source)


def only_years(mart: Mart, first: int, last: int) -> Mart:
    """The mart for a span of years.

    The range on date_id reaches the scan; where the facts carry the year they
    are partitioned by, whole partitions are left out as well.
    """
    kept = mart.monthly.filter(periods.in_years(F.col("date_id"), first, last))
    if "year" in kept.columns:
        kept = kept.filter(F.col("year").between(first, last))
    return replace(mart, monthly=kept)


def value_of(mart: Mart, indicator: str, city: str, year: int, source: str | None = None) -> DataFrame:
    """One indicator for one place and year, with source, unit and period."""
    rows = series(only_years(mart, year, year), [indicator], [city], source)
    return rows.select(
        "indicator_name", "source", "unit", "frequency", "cma_name", "date_id", "year", "month", "value"
    )


def compare_cities(
    mart: Mart, indicator: str, cities: list[str], first_year: int, last_year: int, source: str | None = None
) -> DataFrame:
    """A table of periods (by source) and cities for one indicator; one column per city asked for."""
    rows = series(only_years(mart, first_year, last_year), [indicator], cities, source)
    columns = [F.max(F.when(F.col("cma_name") == city, F.col("value"))).alias(city) for city in cities]
    return rows.groupBy("source", "date_id").agg(*columns)


def latest_values(mart: Mart, indicators: list[str], source: str | None = None) -> DataFrame:
    """(indicator_id, geography_id, date_id, value) at the last date of each series.

    The facts are reduced to one row per series before the names are joined.
    """
    ids = of_source(mart, source).filter(F.col("indicator_name").isin(indicators)).select("indicator_id")
    newest = mart.monthly.join(ids, "indicator_id").groupBy("indicator_id", "geography_id")
    return newest.agg(
        F.max("date_id").alias("date_id"), F.max_by("value", "date_id").alias("value")
    )


def numbered_top(df: DataFrame, order: list[Column], k: int, position: str = "position") -> DataFrame:
    """The first ``k`` rows in ``order``, numbered; only those k meet in one task."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn(position, F.row_number().over(Window.orderBy(*order)))


def rank_cities(
    mart: Mart, indicator: str, k: int, ascending: bool = True, source: str | None = None
) -> DataFrame:
    """The k cities with the lowest (or highest) latest value; ties go by name."""
    named = latest_values(mart, [indicator], source).join(
        mart.geography.select("geography_id", "cma_name"), "geography_id"
    )
    first = F.col("value").asc() if ascending else F.col("value").desc()
    top = numbered_top(named, [first, F.col("cma_name").asc()], k)
    return top.select("position", "cma_name", "date_id", "value")


def lowest_and_highest(mart: Mart, indicator: str, source: str | None = None) -> DataFrame:
    """The cities with the lowest and the highest latest value, from one pass; ties go by name."""
    named = latest_values(mart, [indicator], source).join(
        mart.geography.select("geography_id", "cma_name"), "geography_id"
    )
    row = F.struct("cma_name", "date_id", "value")
    ends = named.agg(
        F.min_by(row, F.struct("value", "cma_name")).alias("lowest"),
        F.min_by(row, F.struct(-F.col("value"), "cma_name")).alias("highest"),
    )
    sides = [F.struct(F.lit(side).alias("side"), f"{side}.*") for side in ("lowest", "highest")]
    return ends.filter("lowest IS NOT NULL").select(F.inline(F.array(*sides)))


def rank_affordability(
    mart: Mart, rent: str, prices: str, salary: float, k: int, months: int = 12, source: str | None = None
) -> DataFrame:
    """The k cities where the yearly rent takes the smallest share of a salary.

    The latest price index stands beside it, and is absent where none is held. ``source``
    is that of the rents.
    """
    wanted = latest_values(mart, [rent, prices]) if source is None else latest_values(mart, [rent], source).unionByName(
        latest_values(mart, [prices])
    )
    latest = wanted.join(
        mart.indicators.select("indicator_id", "indicator_name"), "indicator_id"
    )
    rents = F.max(F.when(F.col("indicator_name") == rent, F.col("value"))).alias("rent")
    index = F.max(F.when(F.col("indicator_name") == prices, F.col("value"))).alias("price_index")
    cities = latest.groupBy("geography_id").agg(rents, index).filter("rent IS NOT NULL")
    share = F.round(F.col("rent").cast("double") * months / F.lit(float(salary)), 6)
    named = cities.join(mart.geography.select("geography_id", "cma_name"), "geography_id")
    shares = named.withColumn("rent_share", share)
    top = numbered_top(shares, [F.col("rent_share").asc(), F.col("cma_name").asc()], k)
    return top.select("position", "cma_name", "rent", "price_index", "rent_share")


@dataclass(frozen=True)
class Threshold:
    """Marks values of the indicators LIKE ``names`` that lie beyond ``limit``."""

    names: str
    limit: float
    below: bool
    mark: str


PUBLISHED_THRESHOLDS = [
    Threshold("Vacancy rate%", fixed.TIGHT_VACANCY, True, "tight"),
    Threshold("%delinquency rate", fixed.ELEVATED_DELINQUENCY, False, "elevated"),
]


def threshold_marks(rows: DataFrame, thresholds: list[Threshold] = PUBLISHED_THRESHOLDS) -> DataFrame:
    """Add ``mark``: the word of the first threshold a value passes, else NULL."""
    mark = F.lit(None).cast("string")
    for rule in reversed(thresholds):
        value = F.col("value").cast("double")
        beyond = value < rule.limit if rule.below else value > rule.limit
        mark = F.when(F.col("indicator_name").like(rule.names) & beyond, F.lit(rule.mark)).otherwise(mark)
    return rows.withColumn("mark", mark)


def grain_notes(mart: Mart) -> DataFrame:
    """Each held series with its grain, so that months and years are not mixed up."""
    held = mart.monthly.groupBy("indicator_id").agg(F.max("date_id").alias("last_date_id"))
    return held.join(mart.indicators, "indicator_id").select(
        "indicator_name", "source", "frequency", "last_date_id"
    )


def yearly_average(facts: DataFrame) -> DataFrame:
    """Monthly facts averaged to (geography_id, indicator_id, year).

    Sums and counts are exact decimals, so the outcome does not depend on the
    order in which tasks finish.
    """
    monthly = facts.filter(periods.monthly(F.col("date_id")))
    year = periods.year_of(F.col("date_id")).alias("year")
    sums = monthly.groupBy("geography_id", "indicator_id", year).agg(
        F.sum("value").alias("total"), F.count("value").alias("months")
    )
    mean = (F.col("total") / F.col("months")).cast("decimal(12,4)")
    return sums.select("geography_id", "indicator_id", "year", mean.alias("value"), "months")


def bridge_to_years(facts: DataFrame, annual: DataFrame) -> DataFrame:
    """Monthly facts, averaged, beside the annual facts of the same city and year."""
    yearly = yearly_average(facts)
    by_year = annual.withColumn("year", periods.year_of(F.col("date_id"))).drop("date_id")
    return yearly.join(by_year, ["geography_id", "year"])


def annual_rows(facts: DataFrame, mart: Mart, cities: list[str] | None = None, **where) -> DataFrame:
    """Rows of an annual fact (``mart.income`` or ``mart.tenure``) with city and year, filtered by its columns."""
    places = mart.geography.select("geography_id", "cma_name")
    if cities is not None:
        places = places.filter(F.col("cma_name").isin(cities))
    for column, value in where.items():
        facts = facts.filter(F.col(column) == value)
    years = facts.withColumn("year", periods.year_of(F.col("date_id")))
    return years.join(places, "geography_id")


def compare_incomes(
    facts: DataFrame, mart: Mart, measure: str, cities: list[str], first_year: int, last_year: int, **where
) -> DataFrame:
    """A table of years by cities of one measure; ``where`` must leave one row per city and year."""
    span = facts.filter(periods.in_years(F.col("date_id"), first_year, last_year))
    rows = annual_rows(span, mart, cities, **where)
    columns = [F.max(F.when(F.col("cma_name") == city, F.col(measure))).alias(city) for city in cities]
    return rows.groupBy("year").agg(*columns)


def rank_incomes(
    facts: DataFrame, mart: Mart, measure: str, k: int, ascending: bool = False, **where
) -> DataFrame:
    """The k cities with the highest (or lowest) latest figure of one measure; ties go by name."""
    held = facts.filter(F.col(measure).isNotNull())
    for column, value in where.items():
        held = held.filter(F.col(column) == value)
    latest = held.groupBy("geography_id").agg(
        F.max("date_id").alias("date_id"), F.max_by(measure, "date_id").alias("value")
    )
    named = latest.join(mart.geography.select("geography_id", "cma_name"), "geography_id")
    first = F.col("value").asc() if ascending else F.col("value").desc()
    top = numbered_top(named, [first, F.col("cma_name").asc()], k)
    return top.select("position", "cma_name", "date_id", "value")


def beside_income(mart: Mart, **where) -> DataFrame:
    """The monthly series of the mart, averaged by year, beside the annual incomes of city and year."""
    annual = mart.income
    for column, value in where.items():
        annual = annual.filter(F.col(column) == value)
    return bridge_to_years(mart.monthly, annual.drop("year", "loaded_at"))


def nearest_documents(documents: DataFrame, queries: DataFrame, k: int, block_bytes: int = QUERY_BYTES) -> DataFrame:
    """The k documents most similar to each query vector, by exact cosine.

    ``documents`` has (doc_id, embedding), ``queries`` has (query_id, embedding). Queries go in blocks of about
    ``block_bytes``, each of which is broadcast; documents pass beside it where they lie, without
    a shuffle, in matrix products. A task keeps its best k per query of the block, so its memory does not
    depend on the number of queries, and what is shuffled is k rows per query and task. Vectors that are
    null, hold a null, have length 0, or another number of components than the query give no score.
    """
    kind = queries.schema["query_id"].dataType
    asked = nearest.usable(queries, F.col("embedding"), F.col("query_id").cast("string").alias("query_id"))
    held = nearest.usable(documents, F.col("embedding"), F.col("doc_id").cast("long").alias("doc_id"))
    blocks = max(1, ceil((asked.agg(F.sum(F.size("v"))).first()[0] or 0) * 8 / block_bytes))
    own = F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks))
    found = None
    for block in range(blocks):
        best = nearest.stream(held, asked.filter(own == block).toArrow(), k)
        found = best if found is None else found.unionByName(best)
    position = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc()))
    return (
        found.withColumn("position", position)
        .filter(F.col("position") <= k)
        .select(F.col("query_id").cast(kind).alias("query_id"), "position", "doc_id", "score")
    )


def side_by_side(
    mart: Mart, indicator: str, others: dict[str, int], source: str | None = None, width: int = 2 * PLACES_PER_YEAR
) -> DataFrame:
    """Each value of an indicator beside the last one of others: ``cma_name, date_id, value``, and per
    other its value under its name and the date of that as ``<name> date``.

    ``others`` says how many months old its value may be at most; an older one, or none, is null. So
    monthly prices can stand beside the survey of the last October, the last quarter or the
    year: an annual value counts from before January of its year. ``source`` is that of all the indicators.
    A city's rows are dealt by spans of two years, each of which starts from what was known before, so a city
    with most of the rows is many small groups.
    """
    names = of_source(mart, source).filter(F.col("indicator_name").isin([indicator, *others]))
    year, month = periods.year_of(F.col("date_id")), periods.month_of(F.col("date_id"))
    rows = (
        mart.monthly.select("geography_id", "date_id", "indicator_id", "value")
        .join(names.select("indicator_id", "indicator_name"), "indicator_id")
        .select(
            "geography_id",
            "date_id",
            "value",
            "indicator_name",
            (year * PLACES_PER_YEAR + month).alias("place"),
            (F.col("indicator_name") == indicator).cast("int").alias("last"),
        )
    )
    known = {
        f"other_{at}": F.when(F.col("indicator_name") == name, F.struct("date_id", "value"))
        for at, name in enumerate(others)
    }
    beside = last_known(rows, known, ["geography_id"], ["place", "last"], width).filter(F.col("indicator_name") == indicator)

    def months(date_id: Column) -> Column:
        return periods.year_of(date_id) * 12 + periods.month_of(date_id)

    columns = []
    for at, (name, oldest) in enumerate(others.items()):
        age = months(F.col("date_id")) - months(F.col(f"other_{at}.date_id"))
        for field, shown in (("value", name), ("date_id", f"{name} date")):
            columns.append(F.when(age <= oldest, F.col(f"other_{at}.{field}")).alias(shown))
    places = mart.geography.select("geography_id", "cma_name")
    return beside.join(places, "geography_id").select("cma_name", "date_id", "value", *columns)
