"""Loading transformed batches: which table a source goes to, and in what order."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from seriesmart import schemas
from seriesmart.operators import dims as dimension
from seriesmart.operators.upsert import as_layout, latest_per_key, replay
from seriesmart.sources.scratch import Scratch
from seriesmart.sources.tables import ALL, Derived, Summary, commit, upsert_edit


class LoadProblems(ExceptionGroup):
    """What failed in a load, beside the versions of the tables that were published."""

    def __new__(cls, message: str, problems: list[Exception], versions: dict[str, int]):
        made = super().__new__(cls, message, problems)
        made.versions = versions
        return made

    def derive(self, problems):
        return LoadProblems(self.message, problems, self.versions)


@dataclass(frozen=True)
class FactTable:
    name: str
    layout: StructType
    keys: list[str]


MONTHLY = FactTable("fact_monthly", schemas.FACT_MONTHLY, schemas.MONTHLY_KEY)
INCOME = FactTable("fact_annual_income", schemas.FACT_ANNUAL_INCOME, schemas.INCOME_KEY)
TENURE = FactTable("fact_annual_income_tenure", schemas.FACT_ANNUAL_INCOME_TENURE, schemas.TENURE_KEY)

TARGETS = {
    "cpi_cma": MONTHLY,
    "gasoline_prices": MONTHLY,
    "food_prices": MONTHLY,
    "nhpi": MONTHLY,
    "median_income": INCOME,
    "rental_survey": MONTHLY,
    "mortgage_rates": MONTHLY,
    "credit_trends": MONTHLY,
    "income_tenure": TENURE,
}


CALENDAR = "dim_date"


def _span(tables: dict[str, dict]) -> str | None:
    """First and last year that any fact table has a folder for."""
    held = (tables[table.name]["folders"] for table in (MONTHLY, INCOME, TENURE) if table.name in tables)
    years = sorted(int(year) for folders in held for year in folders if year != ALL)
    return f"{years[0]}-{years[-1]}" if years else None


def calendar_of(spark: SparkSession) -> Derived:
    """The calendar over the years of all facts, told by their folders alone."""
    return Derived(CALENDAR, _span, lambda span: dimension.calendar(spark, *map(int, span.split("-"))))


def dates_of(table: FactTable) -> str:
    return f"{table.name}_dates"


def summaries() -> list[Summary]:
    """The dates of each indicator, and of the incomes, with their number of facts: renewed for the years of a load."""
    by_indicator = ["indicator_id", "date_id"]
    return [
        Summary(dates_of(MONTHLY), MONTHLY.name, lambda rows: rows.groupBy(*by_indicator).agg(F.count("*").alias("facts"))),
        Summary(dates_of(INCOME), INCOME.name, lambda rows: rows.groupBy("date_id").agg(F.count("*").alias("facts"))),
    ]


def load(
    spark: SparkSession, root: str, batches: list[tuple[str, DataFrame]], scratch: str | None = None
) -> dict[str, int]:
    """Upsert (source, transformed frame) pairs, given in load order, as one version of the mart.

    Each source is typed, reduced to one row per key (the larger values, as the upsert would) and written by
    itself first, which runs its plan: one that fails is left out and the others of its table still load. Frames for one table then
    become one batch and one upsert: replaying them one by one would end with the
    same rows. Every table is tried; those that can be loaded are published together, with a calendar over
    their years and a summary of their dates, and the failures are raised together, with what was
    published as ``versions``. Returns the published versions of the tables.
    """
    by_table: dict[str, tuple[FactTable, list[DataFrame]]] = {}
    edits, problems = [], []
    with Scratch(spark, "load", scratch) as run:
        for at, (source, frame) in enumerate(batches):
            table = TARGETS[source]
            try:
                single = latest_per_key(as_layout(frame, schemas.staging(table.layout)), table.keys, [])
                staged = run.stage(single, f"{at}-{source}")
            except Exception as problem:  # noqa: BLE001 - reported with the others below
                problems.append(ExceptionGroup(f"{source} failed", [problem]))
            else:
                by_table.setdefault(table.name, (table, []))[1].append(staged)
        for name, (table, frames) in by_table.items():
            try:
                edits.append(upsert_edit(run, name, replay(frames), table.keys, ["load_no"]))
            except Exception as problem:  # noqa: BLE001 - reported with the others below
                problems.append(ExceptionGroup(f"load of {name} failed", [problem]))
        versions = commit(spark, root, edits, [calendar_of(spark), *summaries()], problems)
    if problems:
        raise LoadProblems("some loads failed", problems, versions)
    return versions
