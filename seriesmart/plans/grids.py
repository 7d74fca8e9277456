"""Worksheet cell grids to normalised records, and records to facts."""

from pyspark.sql import DataFrame, functions as F

from seriesmart import fixed_values as fixed
from seriesmart.functions import numbers, periods, text
from seriesmart.operators import lookup
from seriesmart.operators.fill import forward_fill
from seriesmart.operators.reshape import cell, outer_merge, unpivot_by_header, unpivot_positions
from seriesmart.operators.upsert import latest_per_key
from seriesmart.plans.series import Dims
from seriesmart.schemas import MONTHLY_KEY, TENURE_KEY

SHEET = ["file", "sheet"]


# --- Rental survey ----------------------------------------------------------


def survey_sheets(grid: DataFrame) -> DataFrame:
    """(file, sheet, kind, file_year): the sheet to read in each survey file and what it holds.

    A file with an occupied-rent sheet is read from there, otherwise from its
    first CSD sheet, whose title says vacancy or rent. The kind is NULL for a
    file that fits neither.
    """
    title = F.when(F.col("row_idx") <= 2, F.array_join("cells", " "))
    said = grid.groupBy("file", "sheet").agg(
        F.min("sheet_idx").alias("sheet_idx"),
        F.coalesce(F.max(title.contains("Vacancy")), F.lit(False)).alias("vacancy"),
        F.coalesce(F.max(title.contains("Rent") | title.contains("Average")), F.lit(False)).alias("rent"),
    )
    kind = text.survey_kind(F.col("sheet"), F.col("vacancy"), F.col("rent"))
    rank = F.when(F.col("sheet") == fixed.OCCUPIED_SHEET, F.lit(-1)).when(
        F.col("sheet").startswith("CSD"), F.col("sheet_idx")
    )
    chosen = said.groupBy("file").agg(F.min_by(F.struct("sheet", kind.alias("kind")), rank).alias("pick"))
    stem = F.regexp_extract("file", r"^(.*?)(\.[^.]*)?$", 1)
    return chosen.select(
        "file",
        "pick.sheet",
        "pick.kind",
        periods.year_in_text(stem).alias("file_year"),
    )


def survey_choice(names: list[str]) -> list[str]:
    """The sheet to decode of a survey workbook: occupied rents, else the first CSD sheet, else the first."""
    csd = [name for name in names if name.startswith("CSD")]
    return [fixed.OCCUPIED_SHEET] if fixed.OCCUPIED_SHEET in names else (csd or names)[:1]


def unrecognised(grid: DataFrame) -> list[str]:
    """Survey files without a sheet of a known kind; ten at most, for a message."""
    unknown = survey_sheets(grid).filter("kind IS NULL").select("file").limit(10).collect()
    return [row[0] for row in unknown]


def _figures(positions: dict[int, str]):
    return F.array(
        *(F.struct(F.lit(n).alias("bedroom_type"), cell(p).alias("text")) for p, n in positions.items())
    )


def rental_records(grid: DataFrame, spellings: DataFrame) -> DataFrame:
    """(year, centre, bedroom_type, value, data_type) from both survey layouts."""
    occupied = F.col("sheet") == fixed.OCCUPIED_SHEET
    zone = text.trimmed(cell(0))
    wanted = F.when(
        occupied, (F.col("row_idx") >= fixed.OCCUPIED_FIRST_ROW) & text.is_city_zone(zone)
    ).otherwise((F.col("row_idx") >= fixed.SURVEY_FIRST_ROW) & text.is_total_row(F.col("cells")))
    rows = grid.filter(wanted).join(survey_sheets(grid).filter("kind IS NOT NULL"), SHEET)

    row_year = F.when(occupied, F.nullif(numbers.safe_int(cell(1)), F.lit(0)))
    no_year = F.raise_error(F.concat(F.lit("no year in file name: "), F.col("file"))).cast("int")
    rows = rows.select(
        "kind",
        F.coalesce(row_year, F.col("file_year"), no_year).alias("year"),
        F.when(occupied, zone).otherwise(text.trimmed(cell(1))).alias("label"),
        F.when(occupied, text.without_city_suffix(zone)).alias("short_label"),
        F.when(occupied, _figures(fixed.OCCUPIED_POSITIONS))
        .otherwise(_figures(fixed.SURVEY_POSITIONS))
        .alias("figures"),
    )
    # The zone as written may itself be a known spelling; otherwise its short form counts.
    short = spellings.select(
        F.col("label").alias("short_label"), F.col("canonical").alias("short_canonical")
    )
    rows = rows.join(spellings, "label", "left").join(short, "short_label", "left")
    rows = rows.withColumn("centre", F.coalesce("canonical", "short_canonical"))
    figures = rows.filter("centre IS NOT NULL").select("kind", "year", "centre", F.inline_outer("figures"))

    rent_only = F.col("kind") == "occupied_rent"
    bare = F.translate("text", ",", "")
    plain = F.when(rent_only, bare).otherwise(F.translate(bare, "%$", ""))
    return (
        figures.filter(~text.is_marked_empty(F.col("text")))
        .select(
            "year",
            "centre",
            "bedroom_type",
            numbers.safe_double(plain).alias("value"),
            F.when(rent_only, F.lit("rent")).otherwise(F.col("kind")).alias("data_type"),
        )
        .na.drop(subset=["value"])
    )


def rental_facts(records: DataFrame, dims: Dims) -> DataFrame:
    """October facts; centres or indicators without an id drop out."""
    pairs = [
        (kind, bedroom, f"{measure} - {bedroom}")
        for kind, measure in fixed.SURVEY_MEASURES.items()
        for bedroom in fixed.SURVEY_POSITIONS.values()
    ]
    names = lookup.fixed_table(
        records.sparkSession, pairs, ["data_type", "bedroom_type", "indicator_name"]
    )
    ids = dims.indicators.filter("source = 'CMHC'").select("indicator_name", "indicator_id")
    series = names.join(ids, "indicator_name").drop("indicator_name")
    places = dims.geography.select(F.col("cma_name").alias("centre"), "geography_id")
    return (
        records.withColumn("date_id", periods.october_id(F.col("year")))
        .join(places, "centre")
        .join(series, ["data_type", "bedroom_type"])
        .select(*MONTHLY_KEY, "value")
    )


# --- Income by tenure -------------------------------------------------------


def tenure_records(
    grid: DataFrame,
    spellings: DataFrame,
    value_column: str,
    header_row: int = fixed.TENURE_HEADER_ROW,
) -> DataFrame:
    """(canonical, year, tenure, value): the last figure of a sheet wins its key.

    Several spellings of a city may occur; keeping one figure per key is what the
    upsert would do later, and keeps the merge of two files one row to one row.
    """
    tenures = lookup.fixed_table(grid.sparkSession, fixed.TENURE_SHEETS.items(), ["sheet", "tenure"])
    cells = unpivot_by_header(grid.filter(F.col("sheet").isin(list(fixed.TENURE_SHEETS))), header_row)
    label = text.trimmed(F.col("label"))
    figures = (
        cells.filter(text.has_text(label) & ~label.isin(fixed.TENURE_SKIP_LABELS))
        .withColumn(value_column, numbers.safe_double(F.col("text")))
        .na.drop(subset=[value_column])
    )
    named = lookup.canonical(figures, spellings, "label").join(tenures, "sheet")
    named = named.select("canonical", "year", "tenure", value_column, "file", "row_idx")
    return latest_per_key(named, ["canonical", "year", "tenure"], ["file", "row_idx"]).drop("file", "row_idx")


def tenure_facts(medians: DataFrame, averages: DataFrame, dims: Dims) -> DataFrame:
    """Median and average incomes side by side; a figure may be in one file only."""
    merged = outer_merge(medians, averages, ["canonical", "year", "tenure"])
    places = dims.geography.select(F.col("cma_name").alias("canonical"), "geography_id")
    return (
        merged.join(places, "canonical")
        .withColumn("date_id", periods.annual_id(F.col("year")))
        .select(*TENURE_KEY, "median_income", "avg_income")
    )


# --- Mortgage rates ---------------------------------------------------------


def rate_records(grid: DataFrame) -> DataFrame:
    """(year, month, term, rate): the year stands only beside the first month."""
    year = numbers.safe_int(cell(0))
    rows = grid.filter(
        (F.col("sheet") == fixed.RATE_SHEET)
        & (F.col("row_idx") >= fixed.RATE_FIRST_ROW)
        & (cell(0).isNull() | year.isNotNull())  # other text in the year cell is a footer
    ).withColumn("stated_year", year)
    filled = forward_fill(rows, "stated_year", SHEET, "row_idx", "year")
    months = filled.withColumn("month", periods.month_number(cell(1)))
    figures = unpivot_positions(
        months.na.drop(subset=["year", "month"]), fixed.RATE_POSITIONS, ["year", "month"], "term", "text"
    )
    rate = numbers.rounded_rate(numbers.safe_double(F.col("text")))
    return figures.select("year", "month", "term", rate.alias("rate")).na.drop(subset=["rate"])


def rate_facts(records: DataFrame, dims: Dims, place: str = "Canada") -> DataFrame:
    """National facts; a missing place or indicator fails the job."""
    spark = records.sparkSession
    terms = lookup.fixed_table(spark, fixed.RATE_INDICATORS.items(), ["term", "indicator_name"])
    ids = dims.indicators.filter("source = 'CMHC'").select("indicator_name", "indicator_id")
    place_id = dims.geography.filter(F.col("cma_name") == place).select("geography_id").scalar()
    no_place = F.raise_error(F.lit(f"no geography_id for: {place}")).cast("int")
    named = lookup.lookup(records, terms, ["term"])
    return (
        lookup.add_ids(named, ids, ["indicator_name"], "indicator_id", on_missing="fail")
        .withColumn("geography_id", F.coalesce(place_id, no_place))
        .withColumn("date_id", periods.month_id(F.col("year"), F.col("month")))
        .select(*MONTHLY_KEY, F.col("rate").alias("value"))
        .na.drop()
    )


# --- Mortgage and credit trends ---------------------------------------------


def credit_records(grid: DataFrame, layout=None) -> DataFrame:
    """(year, quarter, indicator_name, geography, value) from the four data sheets.

    All sheets are read in one pass: a small layout table says which cell of
    which sheet holds which indicator. Short labels ("Q2") take the year of the
    last full one ("2021Q4"), but for sheets that state every label in full.
    """
    table = lookup.fixed_table(
        grid.sparkSession,
        layout or fixed.CREDIT_LAYOUT,
        ["sheet", "position", "indicator_name", "geography"],
    )
    sheets = sorted({row[0] for row in layout or fixed.CREDIT_LAYOUT})
    rows = grid.filter(F.col("sheet").isin(sheets) & (F.col("row_idx") >= fixed.CREDIT_FIRST_ROW))
    rows = rows.withColumn("stated_year", periods.label_year(cell(0)))
    rows = rows.withColumn("quarter", periods.label_quarter(cell(0)))
    filled = forward_fill(rows, "stated_year", SHEET, "row_idx", "carried_year")
    carried = F.when(~F.col("sheet").isin(fixed.FULL_LABEL_ONLY_SHEETS), F.col("carried_year"))
    dated = filled.withColumn("year", F.coalesce("stated_year", carried)).na.drop(subset=["year", "quarter"])
    value = numbers.safe_double(F.get(F.col("cells"), F.col("position")))
    return (
        dated.join(table, "sheet")
        .select("year", "quarter", "indicator_name", "geography", value.alias("value"))
        .na.drop(subset=["value"])
    )


def credit_facts(records: DataFrame, dims: Dims) -> DataFrame:
    """Quarter-end facts; a missing place or indicator fails the job."""
    places = dims.geography.select(F.col("cma_name").alias("geography"), "geography_id")
    ids = dims.indicators.filter("source = 'CMHC'").select("indicator_name", "indicator_id")
    placed = lookup.add_ids(records, places, ["geography"], "geography_id", on_missing="fail")
    keyed = lookup.add_ids(placed, ids, ["indicator_name"], "indicator_id", on_missing="fail")
    month = periods.quarter_end_month(F.col("quarter"))
    return (
        keyed.withColumn("date_id", periods.month_id(F.col("year"), month))
        .select(*MONTHLY_KEY, "value")
        .na.drop()
    )
