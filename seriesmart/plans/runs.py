"""From folders of downloaded files to published fact tables."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart import fixed_values as fixed
from seriesmart.functions import periods
from seriesmart.operators import dims as dimension
from seriesmart.plans import grids, series
from seriesmart.plans.loads import CALENDAR, INCOME, MONTHLY, TENURE, FactTable, LoadProblems, calendar_of, dates_of, load
from seriesmart.plans.questions import Mart
from seriesmart.plans.series import Dims
from seriesmart.sources import archives, delimited, snapshots, workbooks
from seriesmart.sources.scratch import Scratch
from seriesmart.sources.tables import Edit, commit, read_version

GEOGRAPHY, INDICATORS = "dim_geography", "dim_indicator"
FACTS = (MONTHLY, INCOME, TENURE)

CITY_SPECS = {
    "cpi_cma": series.CPI,
    "gasoline_prices": series.GASOLINE,
    "nhpi": series.HOUSE_PRICES,
}
INCOME_COLUMNS = ["REF_DATE", "GEO", "Statistics", "Income source", "Age group", "Sex", "VALUE"]

# Names of the workbooks of each publication, and the period written in them.
RATE_NAME = r"/mortgage-rates-(\d{2})-(\d{2})[^/]*$"
CREDIT_NAME = r"/mortgage-consumer-credit-trends-[^/]*?(\d{4})-q(\d)[^/]*$"
TENURE_NAME = r"/[^/]*income[^/]*tenure[^/]*$"
MEDIAN_GLOB, AVERAGE_GLOB = "real-median-household-income*.xlsx", "average-household*.xlsx"


def published_dims(spark: SparkSession) -> Dims:
    """The dimensions as first seeded; their size is fixed, hence the hints."""
    return Dims(
        geography=F.broadcast(dimension.seed_geography(spark)),
        indicators=F.broadcast(dimension.seed_indicators(spark)),
        spellings=F.broadcast(dimension.seed_spellings(spark)),
        members=F.broadcast(dimension.seed_members(spark)),
    )


def _grown(table: str, seed: DataFrame, keys: list[str], id_column: str) -> Edit:
    """Gives the stored dimension the seed rows it lacks; ids already given stay."""

    def grow(stored: DataFrame | None) -> DataFrame | None:
        if stored is None:
            return seed
        new = seed.drop(id_column)
        if dimension.absent_rows(new, stored, keys).isEmpty():
            return None
        return dimension.insert_absent(stored, new, keys, id_column)

    return Edit(table, grow)


def stored_dims(spark: SparkSession, mart_root: str) -> Dims:
    """The dimensions kept with the mart, made on first use, as one version."""
    seeds = published_dims(spark)
    grown = [
        _grown(GEOGRAPHY, dimension.seed_geography(spark), ["cma_name"], "geography_id"),
        _grown(INDICATORS, dimension.seed_indicators(spark), ["indicator_name", "source"], "indicator_id"),
    ]
    commit(spark, mart_root, grown)
    held = read_version(spark, mart_root, [GEOGRAPHY, INDICATORS])
    return Dims(
        geography=held[GEOGRAPHY], indicators=held[INDICATORS], spellings=seeds.spellings, members=seeds.members
    )


def publish_calendar(spark: SparkSession, mart_root: str) -> None:
    """A calendar over the years of all facts, if the mart's does not have them."""
    commit(spark, mart_root, [], [calendar_of(spark)])


def open_mart(spark: SparkSession, mart_root: str) -> Mart:
    """The published mart, for the questions: all its tables as one version has them."""
    dates = [dates_of(MONTHLY), dates_of(INCOME)]
    held = read_version(spark, mart_root, [GEOGRAPHY, INDICATORS, CALENDAR, *(t.name for t in FACTS), *dates])
    if not {GEOGRAPHY, INDICATORS, CALENDAR} <= set(held):
        raise FileNotFoundError(f"no mart under {mart_root}")
    facts = {table.name: held.get(table.name, _without_rows(spark, table)) for table in FACTS}
    return Mart(
        geography=held[GEOGRAPHY],
        indicators=held[INDICATORS],
        calendar=held[CALENDAR],
        monthly=facts[MONTHLY.name],
        income=facts[INCOME.name],
        tenure=facts[TENURE.name],
        dates=held.get(dates[0]),
        income_dates=held.get(dates[1]),
    )


def _without_rows(spark: SparkSession, table: FactTable) -> DataFrame:
    """What a fact table is while nothing was loaded."""
    return spark.createDataFrame([], table.layout).withColumn("year", F.lit(None).cast("int"))


def newest_table(
    spark: SparkSession, folder: str, columns: list[str], quoted_line_ends: bool = False
) -> DataFrame:
    """The newest snapshot in a folder, whether plain text or still in its archive.

    A snapshot is a file, or a folder of parts as Spark writes them; all its parts are read. The
    rows have their place in the snapshot as ``row_order``. Both forms give the same rows, but plain text
    with line ends in quotes fails unless ``quoted_line_ends`` is set.
    """
    newest = snapshots.newest_snapshot(spark, folder, "*.{csv,zip}")
    if newest.endswith(".zip"):
        rows = archives.read_archives(spark, newest, columns, spread=True)
        return rows.withColumn("row_order", F.struct("path", F.col("row_order").alias("at")))
    place = F.struct("_metadata.file_name", F.monotonically_increasing_id().alias("at"))
    return delimited.read_text_table(spark, newest, columns, quoted_line_ends, row_order=place)


def series_run(
    spark: SparkSession, raw_root: str, table: str, dims: Dims, quoted_line_ends: bool = False
) -> DataFrame:
    """Facts of one published table, from the newest file under ``raw_root/<table number>``."""
    folder = f"{raw_root}/{fixed.TABLE_NUMBERS[table]}"
    spec = series.FOOD if table == "food_prices" else CITY_SPECS.get(table)
    rows = newest_table(spark, folder, spec.columns if spec else INCOME_COLUMNS, quoted_line_ends)
    if table == "median_income":
        return series.income_facts(rows, dims, "row_order")
    if table == "food_prices":
        return series.regional_series(rows, dims, spec)
    return series.city_series(rows, dims, spec)


def rental_run(scratch: Scratch, folder: str, dims: Dims, problems: list[Exception]) -> DataFrame:
    """October facts from every survey workbook in the folder that is recognised.

    The others are added to ``problems`` and do not stop them.
    """
    others = [RATE_NAME, CREDIT_NAME, TENURE_NAME]
    grid = scratch.stage(workbooks.read_workbooks(scratch.spark, folder, skip_names=others, choose=grids.survey_choice), "survey")
    unknown = grids.unrecognised(grid)
    if unknown:
        problems.append(ValueError(f"unrecognised survey files: {unknown}"))
    return grids.rental_facts(grids.rental_records(grid, dims.spellings), dims)


def _newest_edition(scratch: Scratch, folder: str, pattern: str, order: list[int], sheets: list[str], name: str):
    files = snapshots.list_files(scratch.spark, folder, "*.xlsx")
    newest = snapshots.one_path(snapshots.latest_by_name(files, pattern, order))
    grid = scratch.stage(workbooks.read_workbooks(scratch.spark, newest, sheets=sheets), name)
    workbooks.require_sheets(grid, sheets)
    return grid


def rate_run(scratch: Scratch, folder: str, dims: Dims) -> DataFrame:
    """National rates from the newest edition; its name has the month before the year."""
    grid = _newest_edition(scratch, folder, RATE_NAME, [2, 1], [fixed.RATE_SHEET], "rates")
    return grids.rate_facts(grids.rate_records(grid), dims)


def credit_run(scratch: Scratch, folder: str, dims: Dims) -> DataFrame:
    """Quarterly trends from the newest edition."""
    sheets = list(dict.fromkeys(row[0] for row in fixed.CREDIT_LAYOUT))
    grid = _newest_edition(scratch, folder, CREDIT_NAME, [1, 2], sheets, "credit")
    return grids.credit_facts(grids.credit_records(grid), dims)


def tenure_run(scratch: Scratch, folder: str, dims: Dims) -> DataFrame:
    """Incomes by tenure from the median and the average workbook."""
    records = []
    for glob, column in ((MEDIAN_GLOB, "median_income"), (AVERAGE_GLOB, "avg_income")):
        grid = scratch.stage(workbooks.read_workbooks(scratch.spark, folder, glob, list(fixed.TENURE_SHEETS)), column)
        workbooks.require_sheets(grid, list(fixed.TENURE_SHEETS))
        records.append(grids.tenure_records(grid, dims.spellings, column))
    return grids.tenure_facts(*records, dims).orderBy("geography_id", "date_id", "tenure")


def runs(
    scratch: Scratch,
    raw_root: str,
    workbook_folder: str,
    dims: Dims,
    problems: list[Exception],
    quoted_line_ends: bool = False,
) -> dict[str, Callable]:
    """Source name to a function that gives its facts, in load order."""
    plans: dict[str, Callable[[], DataFrame]] = {
        table: (lambda table=table: series_run(scratch.spark, raw_root, table, dims, quoted_line_ends)) for table in fixed.TABLE_NUMBERS
    }
    plans["rental_survey"] = lambda: rental_run(scratch, workbook_folder, dims, problems)
    plans["credit_trends"] = lambda: credit_run(scratch, workbook_folder, dims)
    plans["mortgage_rates"] = lambda: rate_run(scratch, workbook_folder, dims)
    plans["income_tenure"] = lambda: tenure_run(scratch, workbook_folder, dims)
    return plans


def refresh(
    spark: SparkSession,
    raw_root: str,
    workbook_folder: str,
    mart_root: str,
    dims: Dims | None = None,
    sources: list[str] | None = None,
    years: tuple[int, int] | None = None,
    exports: str | None = None,
    day: str | None = None,
    scratch_root: str | None = None,
    quoted_line_ends: bool = False,
) -> dict[str, int]:
    """Conform the chosen sources (all by default) and upsert them.

    Every source is tried by itself, up to its written rows; those that fail, and survey
    workbooks that are not recognised, are reported together at the end, after the rest was
    published. Dimensions that grow are published first, as ids are needed for the facts; then all
    facts and their calendar appear as one version, so a reader never joins new facts with an old calendar. ``years`` keeps a span of them. With ``exports`` each source's facts are also
    written as CSV under ``exports/<source>/<day>``. ``quoted_line_ends`` is for plain text that has such. Given ``dims`` are published with the
    mart, if it has none. Intermediate tables are removed at the end.
    """
    if dims:
        given = ((GEOGRAPHY, dims.geography), (INDICATORS, dims.indicators))
        commit(spark, mart_root, [Edit(name, lambda held, rows=rows: rows if held is None else None) for name, rows in given])
    dims = dims or stored_dims(spark, mart_root)
    problems, batches, versions = [], [], {}
    with Scratch(spark, "refresh", scratch_root) as scratch:
        plans = runs(scratch, raw_root, workbook_folder, dims, problems, quoted_line_ends)
        for name in sources or list(plans):
            try:
                facts = plans[name]()
                if years:
                    facts = facts.filter(periods.in_years(F.col("date_id"), *years))
                if exports:
                    facts = scratch.stage(facts, f"facts-{name}")
                    delimited.export_snapshot(facts, exports, name, day or date.today().isoformat())
                batches.append((name, facts))
            except Exception as problem:  # noqa: BLE001 - reported with the others below
                problems.append(ExceptionGroup(f"{name} failed", [problem]))
        try:
            versions = load(spark, mart_root, batches, scratch_root)
        except LoadProblems as problem:
            versions = problem.versions
            problems.extend(problem.exceptions)
    if problems:
        raise LoadProblems("some sources failed", problems, versions)
    return versions
