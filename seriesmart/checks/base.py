"""Registry, and the published-style tables and cell grids derived from the given tables.

``published`` looks like a downloaded long table: dates, places and figures are
text, with padding, unknown places, other units and marks for missing figures.
The cell grids look like worksheets, with sparse labels, footers and short rows.
Each has a twin in SQL below.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart import fixed_values as fixed
from seriesmart.functions import numbers, periods
from seriesmart.plans.runs import published_dims as seeds  # noqa: F401 - used by the checks
from seriesmart.plans.trade import PRIORITIES, TRADE_INDICATORS, table
from seriesmart.sources.scratch import Scratch


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def full_sql(self) -> str:
        return PRELUDE + self.sql


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    def register(run):
        CHECKS[name] = Check(run, sql)
        return run

    return register


def staged(df: DataFrame, name: str) -> DataFrame:
    """A costly input that its query reads more than once, written first as production does."""
    return Scratch(df.sparkSession, "check").stage(df, name)


# --- Published-style long table ---------------------------------------------

# Every known spelling, then places no lookup knows; two per nation.
PLACES = [label for labels in fixed.CITY_SPELLINGS.values() for label in labels]
PLACES += ["Lethbridge", "Kelowna", "Canada"][: 50 - len(PLACES)]
PROVINCES = list(fixed.PROVINCE_MEMBERS)[:4] + ["Ontario"]
CPI_BY_PRIORITY = dict(zip(PRIORITIES, fixed.CPI_LABELS))
FOOD_BY_STATUS = dict(zip("FOP", fixed.FOOD_LABELS))
HOUSE_BY_STATUS = dict(zip("FOP", fixed.HOUSE_PRICE_LABELS))
STATISTIC_BY_STATUS = dict(zip("FOP", fixed.INCOME_STATISTICS))
FUEL = next(iter(fixed.FUEL_LABELS))


def literal(text: str) -> str:
    return '"' + text + '"'


def pick(column: str, labels: dict[str, str]) -> str:
    whens = " ".join(f"when {literal(k)} then {literal(v)}" for k, v in labels.items())
    return f"case {column} {whens} end"


def item(labels, index: str) -> str:
    """The label at an index counted from 0."""
    return f"element_at(array({', '.join(map(literal, labels))}), cast({index} as int) + 1)"


def as_text(number: str) -> str:
    return f"cast(cast({number} as decimal(12,2)) as string)"


PRICE = "cast(cast(o_totalprice as decimal(18,2)) as string)"


def published(spark: SparkSession, folder: str) -> DataFrame:
    """One text row per order, placed by its customer."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    rows = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    place = item(PLACES, "c_nationkey * 2 + o_orderkey % 2")
    return rows.selectExpr(
        "o_orderkey as row_order",
        "date_format(o_orderdate, 'yyyy-MM') as REF_DATE",
        "date_format(o_orderdate, 'yyyy') as REF_YEAR",
        f"if(o_orderkey % 3 = 0, concat('  ', {place}, ' '), {place}) as GEO",
        f"{item(PROVINCES, 'c_nationkey % 5')} as PROVINCE",
        f"if(o_orderstatus = 'P', '1992=100', {literal(fixed.CPI_BASE)}) as UOM",
        f"concat({pick('o_orderpriority', CPI_BY_PRIORITY)}, ' ') as product",
        f"if(o_orderstatus = 'F', {literal(FUEL)}, 'Premium unleaded gasoline') as fuel",
        f"{pick('o_orderstatus', FOOD_BY_STATUS)} as food",
        f"{pick('o_orderstatus', HOUSE_BY_STATUS)} as house_index",
        f"{pick('o_orderstatus', STATISTIC_BY_STATUS)} as Statistics",
        "concat(' ', c_mktsegment) as `Income source`",
        "o_orderpriority as `Age group`",
        "if(c_custkey % 2 = 0, 'Males', 'Females') as Sex",
        "case when o_orderkey % 17 = 0 then '' when o_orderkey % 19 = 0 then '..' "
        f"when o_orderkey % 23 = 0 then null else {PRICE} end as VALUE",
    )


def order_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text columns that need the orders alone."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as row_order",
        "date_format(o_orderdate, 'yyyy-MM') as REF_DATE",
        "case when o_orderkey % 17 = 0 then '--' when o_orderkey % 19 = 0 then '**' "
        "when o_orderkey % 23 = 0 then '' when o_orderkey % 29 = 0 then 'about' "
        f"when o_orderkey % 31 = 0 then null else concat('$', {PRICE}, '%') end as raw",
        "concat('  ', o_orderpriority, ' ') as padded",
        "o_orderstatus as status",
    )


def regional_raw(rows: DataFrame) -> DataFrame:
    """A provincial table: the lowest stated figure per province, month and food."""
    value = numbers.safe_double(F.col("VALUE"))
    lowest = rows.groupBy(
        F.col("PROVINCE").alias("GEO"), "REF_DATE", F.col("food").alias("Products")
    ).agg(F.min(value).alias("low"))
    return lowest.filter("low IS NOT NULL").select(
        "GEO", "REF_DATE", "Products", F.col("low").cast("decimal(18,2)").cast("string").alias("VALUE")
    )


def annual_balances(spark: SparkSession, folder: str) -> DataFrame:
    """An annual fact: the highest balance among a nation's customers with orders in the year."""
    years = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    placed = years.distinct().join(customers, "c_custkey")
    return placed.groupBy(
        (F.col("c_nationkey") + 1).cast("int").alias("geography_id"),
        periods.annual_id(F.col("year")).alias("date_id"),
    ).agg(F.max("c_acctbal").alias("balance"))


# --- Cell grids from events ---------------------------------------------------

CREDIT_BY_TYPE = {
    "signup": "DATA_1", "view": "DATA_7", "click": "DATA_13", "purchase": "DATA_25", "error": "NOTES",
}
MONTH_NAMES = [*map(str.title, fixed.MONTHS), "TOTAL"]
TENURE_BY_TYPE = {
    "signup": "All Households", "view": "All Households", "click": "Renter",
    "purchase": "Owner", "error": "Notes",
}


def grid_rows(rows: DataFrame, file: str, sheet: str, row_idx: str, cells: str) -> DataFrame:
    """Grid rows from SQL expressions, one per row.

    They come out of a generator, so each cell is computed once; plain columns
    would be computed again in every filter that Spark pushes below them.
    """
    row = (
        f"named_struct('file', {file}, 'sheet_idx', 0, 'sheet', {sheet}, "
        f"'row_idx', cast({row_idx} as bigint), 'cells', {cells})"
    )
    return rows.selectExpr(f"inline(array({row}))")


def credit_grid(spark: SparkSession, folder: str) -> DataFrame:
    """One file per user and a data sheet per event type, in event order."""
    label = (
        "case when event_id % 11 = 0 then 'Source: survey' "
        "when event_id % 5 = 0 then concat(event_id % 9 + 2015, 'Q', event_id % 5 + 1) "
        "else concat('Q', event_id % 4 + 1) end"
    )
    return grid_rows(
        table(spark, folder, "events"),
        file="concat('trends-', user_id, '.xlsx')",
        sheet=pick("event_type", CREDIT_BY_TYPE),
        row_idx="event_id + 1",
        cells=f"array({label}, {as_text('value')}, if(event_id % 7 <> 0, {as_text('value * 2')}, null), "
        f"if(event_id % 13 = 0, 'n/a', {as_text('value * 3')}), {as_text('value * 4')}, "
        f"{as_text('value * 5')})",
    )


def rate_grid(spark: SparkSession, folder: str) -> DataFrame:
    """One file per user; the year stands beside every 12th row, footers every 37th."""
    year = (
        "case when event_id % 37 = 0 then 'Source: lenders' "
        "when event_id % 12 = 0 then cast(event_id % 9 + 2015 as string) end"
    )
    return grid_rows(
        table(spark, folder, "events"),
        file="concat('rates-', user_id, '.xlsx')",
        sheet=f"if(event_type = 'error', 'Notes', {literal(fixed.RATE_SHEET)})",
        row_idx="event_id + 1",
        cells=f"array({year}, {item(MONTH_NAMES, 'event_id % 13')}, {as_text('value')}, "
        f"if(event_id % 7 <> 0, {as_text('value * 2')}, null), "
        f"if(event_id % 13 = 0, '..', {as_text('value * 3')}))",
    )


def survey_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Survey files per user: two of three with a CSD sheet, one with occupied rents.

    Each file has a title row, and a data row per event.
    """
    events = table(spark, folder, "events")
    names = {
        "file": "concat(user_id % 6 + 2018, '_survey_', user_id, '.xlsx')",
        "sheet": f"if(user_id % 3 = 2, {literal(fixed.OCCUPIED_SHEET)}, 'CSD - SDR')",
    }
    title = "if(user_id % 3 = 0, 'Vacancy Rates (%)', 'Average Rents ($)')"
    title_rows = grid_rows(
        events.select("user_id").distinct(), **names, row_idx="1", cells=f"array({title}, 'by bedroom type')"
    )
    place = item(PLACES, "event_id % 50")
    zone = (
        f"case when event_id % 10 = 0 then concat('Remainder of ', {place}, ' CMA') "
        f"when {place} like '%CMA' then {place} else concat({place}, ' CMA') end"
    )
    stated = "if(event_id % 4 <> 0, cast(event_id % 6 + 2018 as string), null)"
    mark = (
        "case when event_id % 7 = 0 then '--' when event_id % 11 = 0 then '**' "
        f"else concat('$', {as_text('value')}, '%') end"
    )
    survey = (
        f"array('Province', if(event_id % 9 = 0, 'Total', concat(' ', {place})), 'Total', "
        f"if(event_id % 8 = 0, 'Row', 'Total'), {mark}, 'a', {as_text('value * 2')}, 'b', null, 'c', "
        f"{as_text('value * 4')}, 'd', {as_text('value * 5')})"
    )
    occupied = (
        f"array({zone}, {stated}, 'x', 'y', {as_text('value')}, null, null, null, null, {mark}, null, null, "
        f"null, null, {as_text('value * 3')}, null, null, null, null, '1,234.5')"
    )
    cells = f"if(user_id % 3 = 2, {occupied}, {survey})"
    data_rows = grid_rows(events, **names, row_idx="event_id + 11", cells=cells)
    return title_rows.unionByName(data_rows)


def tenure_grid(spark: SparkSession, folder: str, measure: str) -> DataFrame:
    """The median (or average) file: every event a data row, one header per sheet.

    The two files hold events of the same kinds but leave out different figures.
    """
    events = table(spark, folder, "events").withColumn("sheet", F.expr(pick("event_type", TENURE_BY_TYPE)))
    shift = 0 if measure == "median" else 1
    names = {"file": f"'{measure}.xlsx'", "sheet": "sheet"}
    header_rows = grid_rows(
        events.select("sheet").distinct(),
        **names,
        row_idx=f"{fixed.TENURE_HEADER_ROW}",
        cells="array('Geography', '2006', '', '2011', 'q', '1999', 'q', ' 2016 ')",
    )
    label = (
        "case when event_id % 21 = 0 then 'End of worksheet' "
        f"when event_id % 22 <> 0 then concat(' ', {item(PLACES, 'user_id % 50')}) end"
    )
    data_rows = grid_rows(
        events,
        **names,
        row_idx="event_id + 9",
        cells=f"array({label}, if(user_id % 3 <> {shift}, {as_text('value')}, null), 'A', "
        f"if(event_id % 5 = 0, 'x', {as_text(f'value * {2 + shift}')}), 'B', {as_text('value')}, 'C', "
        f"if(user_id % 4 <> {shift}, {as_text('value * 3')}, null))",
    )
    return header_rows.unionByName(data_rows)


# --- SQL twins ---------------------------------------------------------------


def quoted(text) -> str:
    if text is None:
        return "NULL"
    return str(text) if isinstance(text, (int, float)) else "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(quoted, row)) + ")" for row in rows) + ")"


def sql_list(items) -> str:
    return "[" + ", ".join(map(quoted, items)) + "]"


def sql_case(column: str, labels: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in labels.items())
    return f"CASE {column} {whens} END"


def sql_text(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(12,2)) AS VARCHAR)"


def number(text: str) -> str:
    return f"TRY_CAST(trim({text}) AS DOUBLE)"


_SPELLINGS = [(label, name) for name, labels in fixed.CITY_SPELLINGS.items() for label in labels]
_MEMBERS = [(region, name) for region, names in fixed.PROVINCE_MEMBERS.items() for name in names]
_SURVEY_SERIES = [
    (kind, bedroom, f"{measure} - {bedroom}")
    for kind, measure in fixed.SURVEY_MEASURES.items()
    for bedroom in fixed.SURVEY_POSITIONS.values()
]
_PLACE = f"{sql_list(PLACES)}[CAST({{}} AS BIGINT) + 1]"
_EVENT_PLACE = _PLACE.format("event_id % 50")
_FILE_YEAR = "CAST(user_id % 6 + 2018 AS VARCHAR)"
_MARK = (
    "CASE WHEN event_id % 7 = 0 THEN '--' WHEN event_id % 11 = 0 THEN '**' "
    f"ELSE '$' || {sql_text('value')} || '%' END"
)
_ZONE = (
    f"CASE WHEN event_id % 10 = 0 THEN 'Remainder of ' || {_EVENT_PLACE} || ' CMA' "
    f"WHEN {_EVENT_PLACE} LIKE '%CMA' THEN {_EVENT_PLACE} ELSE {_EVENT_PLACE} || ' CMA' END"
)


def _tenure_sql(measure: str) -> str:
    shift = 0 if measure == "median" else 1
    place = _PLACE.format("user_id % 50")
    return f"""
    SELECT {sql_case("event_type", TENURE_BY_TYPE)} AS sheet, event_id + 9 AS row_idx,
        CASE WHEN event_id % 21 = 0 THEN 'End of worksheet' WHEN event_id % 22 <> 0 THEN ' ' || {place} END AS label,
        [CASE WHEN user_id % 3 <> {shift} THEN {sql_text("value")} END,
         CASE WHEN event_id % 5 = 0 THEN 'x' ELSE {sql_text(f"value * {2 + shift}")} END,
         CASE WHEN user_id % 4 <> {shift} THEN {sql_text("value * 3")} END] AS texts
    FROM events"""


def _tenure_records_sql(grid: str, column: str) -> str:
    return f"""
    SELECT canonical, year, tenure, value AS {column} FROM (
        SELECT canonical, year, tenure, value,
            row_number() OVER (PARTITION BY canonical, year, tenure ORDER BY row_idx DESC, value DESC) AS rn
        FROM (SELECT sheet, row_idx, trim(label) AS label, unnest([2006, 2011, 2016]) AS year,
                  {number("unnest(texts)")} AS value FROM {grid}) u
        JOIN spelling s ON s.label = u.label
        JOIN tenure_sheet t ON t.sheet = u.sheet
        WHERE value IS NOT NULL AND u.label NOT IN ('End of worksheet', 'Georgraphy', 'Geography')
    ) WHERE rn = 1"""


PRELUDE = f"""
WITH spelling(label, canonical) AS {values(_SPELLINGS)},
member(region, canonical) AS {values(_MEMBERS)},
dim_geography(geography_id, cma_name, province, cma_code) AS
    {values((at, *row) for at, row in enumerate(fixed.CITIES, start=1))},
dim_indicator(indicator_id, indicator_name, source, unit, category, frequency) AS
    {values((at, *row) for at, row in enumerate(fixed.INDICATORS, start=1))},
cpi_label(label, indicator_name) AS {values(fixed.CPI_LABELS.items())},
food_label(label, indicator_name) AS {values(fixed.FOOD_LABELS.items())},
house_label(label, indicator_name) AS {values(fixed.HOUSE_PRICE_LABELS.items())},
survey_series(data_type, bedroom_type, indicator_name) AS {values(_SURVEY_SERIES)},
credit_layout(sheet, position, indicator_name, geography) AS {values(fixed.CREDIT_LAYOUT)},
tenure_sheet(sheet, tenure) AS {values(fixed.TENURE_SHEETS.items())},
published AS (
    SELECT o_orderkey AS row_order,
        strftime(o_orderdate, '%Y-%m') AS REF_DATE,
        strftime(o_orderdate, '%Y') AS REF_YEAR,
        CASE WHEN o_orderkey % 3 = 0 THEN '  ' || place || ' ' ELSE place END AS GEO,
        {sql_list(PROVINCES)}[CAST(c_nationkey % 5 AS BIGINT) + 1] AS PROVINCE,
        CASE WHEN o_orderstatus = 'P' THEN '1992=100' ELSE {quoted(fixed.CPI_BASE)} END AS UOM,
        {sql_case("o_orderpriority", CPI_BY_PRIORITY)} || ' ' AS product,
        CASE WHEN o_orderstatus = 'F' THEN {quoted(FUEL)} ELSE 'Premium unleaded gasoline' END AS fuel,
        {sql_case("o_orderstatus", FOOD_BY_STATUS)} AS food,
        {sql_case("o_orderstatus", HOUSE_BY_STATUS)} AS house_index,
        {sql_case("o_orderstatus", STATISTIC_BY_STATUS)} AS statistic,
        ' ' || c_mktsegment AS income_source,
        o_orderpriority AS age_group,
        CASE WHEN c_custkey % 2 = 0 THEN 'Males' ELSE 'Females' END AS sex,
        CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN '..'
             WHEN o_orderkey % 23 = 0 THEN NULL
             ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS VALUE
    FROM (SELECT *, {_PLACE.format("c_nationkey * 2 + o_orderkey % 2")} AS place
          FROM orders JOIN customer ON o_custkey = c_custkey)
),
order_text AS (
    SELECT o_orderkey AS row_order, strftime(o_orderdate, '%Y-%m') AS REF_DATE,
        CASE WHEN o_orderkey % 17 = 0 THEN '--' WHEN o_orderkey % 19 = 0 THEN '**'
             WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN 'about'
             WHEN o_orderkey % 31 = 0 THEN NULL
             ELSE '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '%' END AS raw,
        '  ' || o_orderpriority || ' ' AS padded, o_orderstatus AS status
    FROM orders
),
figures AS (
    SELECT *, trim(GEO) AS place, CAST(replace(REF_DATE, '-', '') AS INTEGER) AS date_id, {number("VALUE")} AS value_num
    FROM published WHERE {number("VALUE")} IS NOT NULL
),
placed AS (
    SELECT f.*, g.geography_id FROM figures f
    JOIN spelling s ON s.label = f.place JOIN dim_geography g ON g.cma_name = s.canonical
),
cpi AS (
    SELECT p.geography_id, p.date_id, i.indicator_id, p.value_num AS value, p.row_order, p.fuel
    FROM placed p JOIN cpi_label c ON c.label = trim(p.product)
    JOIN dim_indicator i ON i.indicator_name = c.indicator_name AND i.source = 'StatCan'
    WHERE p.UOM = {quoted(fixed.CPI_BASE)}
),
nhpi AS (
    SELECT p.geography_id, p.date_id, i.indicator_id, p.value_num AS value, p.row_order
    FROM placed p JOIN house_label c ON c.label = trim(p.house_index)
    JOIN dim_indicator i ON i.indicator_name = c.indicator_name AND i.source = 'StatCan'
),
income AS (
    SELECT geography_id, CAST(REF_YEAR AS INTEGER) * 100 AS date_id, trim(income_source) AS income_source,
        age_group, sex,
        arg_min(value_num, row_order) FILTER (statistic = 'Median income (excluding zeros)') AS median_income,
        arg_min(value_num, row_order) FILTER (statistic = 'Average income (excluding zeros)') AS avg_income,
        CAST(round(arg_min(value_num, row_order) FILTER (statistic = 'Number of persons with income')) AS BIGINT)
            AS num_persons
    FROM placed GROUP BY ALL
),
regional AS (
    SELECT PROVINCE AS GEO, REF_DATE, food AS product,
        CAST(min(value_num) AS DOUBLE) AS value
    FROM figures GROUP BY ALL
),
credit_grid AS (
    SELECT 'trends-' || user_id || '.xlsx' AS file,
        {sql_case("event_type", CREDIT_BY_TYPE)} AS sheet,
        event_id + 1 AS row_idx,
        CASE WHEN event_id % 11 = 0 THEN 'Source: survey'
             WHEN event_id % 5 = 0 THEN (event_id % 9 + 2015) || 'Q' || (event_id % 5 + 1)
             ELSE 'Q' || (event_id % 4 + 1) END AS label,
        [{sql_text("value")}, CASE WHEN event_id % 7 <> 0 THEN {sql_text("value * 2")} END,
         CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE {sql_text("value * 3")} END,
         {sql_text("value * 4")}, {sql_text("value * 5")}] AS texts
    FROM events
),
credit_filled AS (
    SELECT *, TRY_CAST(nullif(regexp_extract(label, '^(\\d{{4}})Q\\d', 1), '') AS INTEGER) AS stated_year,
        TRY_CAST(coalesce(nullif(regexp_extract(label, '^\\d{{4}}Q(\\d)', 1), ''),
                          nullif(regexp_extract(label, '^Q(\\d)$', 1), '')) AS INTEGER) AS quarter,
        last_value(TRY_CAST(nullif(regexp_extract(label, '^(\\d{{4}})Q\\d', 1), '') AS INTEGER) IGNORE NULLS)
            OVER (PARTITION BY file, sheet ORDER BY row_idx) AS carried_year
    FROM credit_grid WHERE sheet LIKE 'DATA%' AND row_idx >= {fixed.CREDIT_FIRST_ROW}
),
credit_records AS (
    SELECT CASE WHEN f.sheet = 'DATA_25' THEN stated_year ELSE coalesce(stated_year, carried_year) END AS year,
        quarter, indicator_name, geography, {number("texts[position]")} AS value
    FROM credit_filled f JOIN credit_layout l ON l.sheet = f.sheet
    WHERE quarter IS NOT NULL AND {number("texts[position]")} IS NOT NULL
      AND CASE WHEN f.sheet = 'DATA_25' THEN stated_year ELSE coalesce(stated_year, carried_year) END IS NOT NULL
),
rate_grid AS (
    SELECT 'rates-' || user_id || '.xlsx' AS file,
        CASE WHEN event_type = 'error' THEN 'Notes' ELSE {quoted(fixed.RATE_SHEET)} END AS sheet,
        event_id + 1 AS row_idx,
        CASE WHEN event_id % 37 = 0 THEN 'Source: lenders'
             WHEN event_id % 12 = 0 THEN CAST(event_id % 9 + 2015 AS VARCHAR) END AS year_text,
        {sql_list(MONTH_NAMES)}[event_id % 13 + 1] AS month_text,
        [{sql_text("value")}, CASE WHEN event_id % 7 <> 0 THEN {sql_text("value * 2")} END,
         CASE WHEN event_id % 13 = 0 THEN '..' ELSE {sql_text("value * 3")} END] AS texts
    FROM events
),
rate_records AS (
    SELECT year, CAST(month AS INTEGER) AS month, term, round({number("raw")}, 4) AS rate FROM (
        SELECT last_value(TRY_CAST(year_text AS INTEGER) IGNORE NULLS)
                OVER (PARTITION BY file, sheet ORDER BY row_idx) AS year,
            list_position({sql_list(fixed.MONTHS)}, upper(month_text)) AS month,
            texts
        FROM rate_grid
        WHERE sheet = {quoted(fixed.RATE_SHEET)} AND row_idx >= {fixed.RATE_FIRST_ROW}
          AND (year_text IS NULL OR TRY_CAST(year_text AS INTEGER) IS NOT NULL)
    ), LATERAL (SELECT unnest(['1 year', '3 year', '5 year']) AS term, unnest(texts) AS raw)
    WHERE year IS NOT NULL AND month > 0 AND {number("raw")} IS NOT NULL
),
survey_rows AS (
    SELECT CASE user_id % 3 WHEN 0 THEN 'vacancy' WHEN 1 THEN 'rent' ELSE 'occupied_rent' END AS kind,
        {_FILE_YEAR} || '_survey_' || user_id || '.xlsx' AS file,
        CASE WHEN user_id % 3 = 2 AND event_id % 4 <> 0 THEN CAST(event_id % 6 + 2018 AS INTEGER)
             ELSE CAST({_FILE_YEAR} AS INTEGER) END AS year,
        CASE WHEN user_id % 3 = 2 THEN {_ZONE} WHEN event_id % 9 = 0 THEN 'Total' ELSE {_EVENT_PLACE} END AS label,
        CASE WHEN user_id % 3 = 2 THEN event_id % 10 <> 0 ELSE event_id % 9 <> 0 AND event_id % 8 <> 0 END AS wanted,
        CASE WHEN user_id % 3 = 2
             THEN [{sql_text("value")}, {_MARK}, {sql_text("value * 3")}, '1,234.5', NULL]
             ELSE [{_MARK}, {sql_text("value * 2")}, NULL, {sql_text("value * 4")}, {sql_text("value * 5")}] END AS texts
    FROM events
),
rental_records AS (
    SELECT year, coalesce(a.canonical, b.canonical) AS centre, bedroom_type,
        {number("CASE WHEN kind = 'occupied_rent' THEN replace(raw, ',', '') ELSE translate(raw, '%$,', '') END")} AS value,
        CASE WHEN kind = 'vacancy' THEN 'vacancy' ELSE 'rent' END AS data_type
    FROM (SELECT *, unnest({sql_list(fixed.SURVEY_POSITIONS.values())}) AS bedroom_type, unnest(texts) AS raw
        FROM survey_rows WHERE wanted) r
    LEFT JOIN spelling a ON a.label = r.label
    LEFT JOIN spelling b ON r.kind = 'occupied_rent' AND b.label = regexp_replace(r.label, '\\s+CMA$', '')
    WHERE raw IS NOT NULL AND raw NOT IN ('--', '**', '') AND coalesce(a.canonical, b.canonical) IS NOT NULL
      AND {number("CASE WHEN kind = 'occupied_rent' THEN replace(raw, ',', '') ELSE translate(raw, '%$,', '') END")} IS NOT NULL
),
median_grid AS ({_tenure_sql("median")}),
average_grid AS ({_tenure_sql("average")}),
medians AS ({_tenure_records_sql("median_grid", "median_income")}),
averages AS ({_tenure_records_sql("average_grid", "avg_income")}),
tenure AS (
    SELECT g.geography_id, m.year * 100 AS date_id, m.tenure, m.median_income, m.avg_income
    FROM (SELECT * FROM medians FULL JOIN averages USING (canonical, year, tenure)) m
    JOIN dim_geography g ON g.cma_name = m.canonical
),
trade_indicator(indicator_id, indicator_name, source, unit, category, frequency) AS
    {values((at, *row) for at, row in enumerate(TRADE_INDICATORS, start=1))},
trade_geography AS (
    SELECT CAST(n_nationkey + 1 AS INTEGER) AS geography_id, n_name AS cma_name, r_name AS province,
        CAST(n_nationkey AS VARCHAR) AS cma_code
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
trade_named AS (
    SELECT c_nationkey AS nationkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS date_id,
        'Order value - ' || o_orderpriority AS indicator_name,
        sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS total, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
    UNION ALL
    SELECT s_nationkey, CAST(year(l_shipdate) * 100 + quarter(l_shipdate) * 3 AS INTEGER),
        'Ship price - ' || l_returnflag,
        sum(CAST(round(l_extendedprice * 100) AS BIGINT)), count(*)
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL
),
trade_fact AS (
    SELECT CAST(nationkey + 1 AS INTEGER) AS geography_id, date_id, indicator_id,
        CAST((200 * total + n) // (2 * n) AS BIGINT) AS units
    FROM trade_named JOIN trade_indicator USING (indicator_name)
),
trade_series AS (
    SELECT f.*, f.units / 10000.0 AS value, i.indicator_name, i.source, i.unit, i.frequency, g.cma_name,
        CAST(f.date_id // 100 AS INTEGER) AS year, CAST(f.date_id % 100 AS INTEGER) AS month
    FROM trade_fact f JOIN trade_indicator i USING (indicator_id) JOIN trade_geography g USING (geography_id)
),
cpi_target AS (
    SELECT geography_id, date_id, indicator_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY geography_id, date_id, indicator_id ORDER BY row_order DESC) AS rn
        FROM cpi WHERE fuel = {quoted(FUEL)}) WHERE rn = 1
),
cpi_batch AS (
    SELECT geography_id, date_id, indicator_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY geography_id, date_id, indicator_id ORDER BY row_order DESC) AS rn
        FROM cpi WHERE fuel <> {quoted(FUEL)}) WHERE rn = 1
)
"""
