"""Projections, filters, predicates (P) and scalar functions (F)."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from seriesmart import fixed_values as fixed
from seriesmart.checks.base import (
    FUEL,
    check,
    credit_grid,
    number,
    order_text,
    published,
    quoted,
    rate_grid,
    seeds,
    survey_grid,
)
from seriesmart.functions import numbers, periods, text
from seriesmart.operators.reshape import cell
from seriesmart.operators.upsert import as_layout, upsert
from seriesmart.plans.grids import survey_sheets
from seriesmart.plans.trade import month_of_date, table
from seriesmart.schemas import FACT_MONTHLY, staging


@check("P1_projection", "SELECT row_order, REF_DATE, VALUE AS raw_value FROM published")
def projection(spark, folder):
    return published(spark, folder).select("row_order", "REF_DATE", F.col("VALUE").alias("raw_value"))


@check(
    "P2_equality_filter",
    f"SELECT row_order, UOM, fuel FROM published WHERE UOM = '2002=100' AND fuel = {quoted(FUEL)}",
)
def equality_filter(spark, folder):
    rows = published(spark, folder)
    return rows.filter((F.col("UOM") == fixed.CPI_BASE) & (F.col("fuel") == FUEL)).select(
        "row_order", "UOM", "fuel"
    )


@check(
    "P3_in_list_filter",
    "SELECT row_order, statistic FROM published WHERE statistic IN "
    "('Median income (excluding zeros)', 'Number of persons with income')",
)
def in_list_filter(spark, folder):
    wanted = ["Median income (excluding zeros)", "Number of persons with income"]
    rows = published(spark, folder).filter(F.col("Statistics").isin(wanted))
    return rows.select("row_order", F.col("Statistics").alias("statistic"))


@check(
    "P4_non_empty_filter",
    "SELECT row_order, VALUE AS raw_value FROM published WHERE VALUE IS NOT NULL AND VALUE <> ''",
)
def non_empty_filter(spark, folder):
    rows = published(spark, folder).filter(text.has_text(F.col("VALUE")))
    return rows.select("row_order", F.col("VALUE").alias("raw_value"))


@check(
    "P5_drop_any_null",
    f"SELECT row_order, {number('VALUE')} AS value FROM published WHERE {number('VALUE')} IS NOT NULL",
)
def drop_any_null(spark, folder):
    value = numbers.safe_double(F.col("VALUE")).alias("value")
    return published(spark, folder).select("row_order", value).na.drop("any")


@check(
    "P6_drop_null_subset",
    f"""SELECT row_order, s.canonical, {number('VALUE')} AS value FROM published p
    JOIN spelling s ON s.label = trim(p.GEO)""",
)
def drop_null_subset(spark, folder):
    rows = published(spark, folder).select(
        "row_order",
        text.trimmed(F.col("GEO")).alias("label"),
        numbers.safe_double(F.col("VALUE")).alias("value"),
    )
    named = rows.join(seeds(spark).spellings, "label", "left")
    return named.na.drop(subset=["canonical"]).select("row_order", "canonical", "value")


@check(
    "P7_like_filter",
    "SELECT o_orderkey, 'Order value - ' || o_orderpriority AS indicator_name FROM orders "
    "WHERE ('Order value - ' || o_orderpriority) LIKE 'Order value - %O%'",
)
def like_filter(spark, folder):
    name = F.concat(F.lit("Order value - "), F.col("o_orderpriority")).alias("indicator_name")
    rows = table(spark, folder, "orders").select("o_orderkey", name)
    return rows.filter(F.col("indicator_name").like("Order value - %O%"))


@check(
    "P8_suffix_filter",
    "SELECT file, label AS zone FROM survey_rows WHERE kind = 'occupied_rent' "
    "AND label LIKE '%CMA' AND label NOT LIKE '%Remainder%'",
)
def suffix_filter(spark, folder):
    zone = text.trimmed(cell(0))
    rows = survey_grid(spark, folder).filter(
        (F.col("sheet") == fixed.OCCUPIED_SHEET) & (F.col("row_idx") >= fixed.OCCUPIED_FIRST_ROW)
    )
    return rows.filter(text.is_city_zone(zone)).select("file", zone.alias("zone"))


@check(
    "P9_total_rows",
    "SELECT file, label AS centre FROM survey_rows WHERE kind <> 'occupied_rent' AND wanted",
)
def total_rows(spark, folder):
    rows = survey_grid(spark, folder).filter(F.col("row_idx") >= fixed.SURVEY_FIRST_ROW)
    rows = rows.filter(F.col("sheet").startswith("CSD") & text.is_total_row(F.col("cells")))
    return rows.select("file", text.trimmed(cell(1)).alias("centre"))


@check(
    "P10_marked_empty_filter",
    "SELECT row_order, raw FROM order_text WHERE raw IS NOT NULL AND raw NOT IN ('--', '**', '')",
)
def marked_empty_filter(spark, folder):
    rows = order_text(spark, folder).filter(~text.is_marked_empty(F.col("raw")))
    return rows.select("row_order", "raw")


@check(
    "P11_header_and_footer_skip",
    "SELECT file, row_idx, year_text FROM rate_grid WHERE row_idx >= 3 "
    "AND (year_text IS NULL OR TRY_CAST(year_text AS INTEGER) IS NOT NULL)",
)
def header_and_footer_skip(spark, folder):
    footer = cell(0).isNotNull() & numbers.safe_int(cell(0)).isNull()
    rows = rate_grid(spark, folder).filter((F.col("row_idx") >= fixed.RATE_FIRST_ROW) & ~footer)
    return rows.select("file", "row_idx", cell(0).alias("year_text"))


@check(
    "P12_period_grain",
    """SELECT o_orderkey, d AS date_id, d % 100 BETWEEN 1 AND 12 AS is_monthly, d % 100 = 10 AS is_october,
        d % 100 IN (3, 6, 9, 12) AS is_quarter_end, d BETWEEN 199700 AND 199912 AS in_span
    FROM (SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS d FROM orders)""",
)
def period_grain(spark, folder):
    date_id = month_of_date(F.col("o_orderdate")).alias("date_id")
    rows = table(spark, folder, "orders").select("o_orderkey", date_id)
    at = F.col("date_id")
    return rows.select(
        "o_orderkey",
        "date_id",
        periods.monthly(at).alias("is_monthly"),
        periods.october(at).alias("is_october"),
        periods.quarter_ends(at).alias("is_quarter_end"),
        periods.in_years(at, 1997, 1999).alias("in_span"),
    )


@check(
    "P13_constant_column",
    "SELECT row_order, (SELECT geography_id FROM dim_geography WHERE cma_name = 'Canada') AS geography_id, "
    "'orders' AS source FROM order_text",
)
def constant_column(spark, folder):
    nation = seeds(spark).geography.filter("cma_name = 'Canada'").select("geography_id").scalar()
    return order_text(spark, folder).select(
        "row_order", nation.alias("geography_id"), F.lit("orders").alias("source")
    )


@check(
    "P14_rename",
    "SELECT o_orderkey AS row_order, o_totalprice AS median_income, o_orderstatus AS income_status FROM orders",
)
def rename(spark, folder):
    names = {"o_orderkey": "row_order", "o_totalprice": "median_income", "o_orderstatus": "income_status"}
    return table(spark, folder, "orders").select(*names).withColumnsRenamed(names)


@check(
    "P15_absent_columns",
    "SELECT CAST(o_custkey AS INTEGER) AS geography_id, CAST(NULL AS INTEGER) AS date_id, "
    "CAST(NULL AS INTEGER) AS indicator_id, CAST(CAST(o_totalprice AS DECIMAL(12,4)) AS DOUBLE) AS value FROM orders",
)
def absent_columns(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("geography_id"), F.col("o_totalprice").alias("value")
    )
    typed = as_layout(rows, staging(FACT_MONTHLY))
    return typed.withColumn("value", F.col("value").cast("double"))


@check(
    "P16_type_projection",
    "SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS geography_id, "
    "CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(o_orderdate AS VARCHAR)[1:10] AS day FROM orders",
)
def type_projection(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("geography_id"),
        numbers.whole_count(F.col("o_totalprice") * 100).alias("cents"),
        F.col("o_orderdate").cast("date").cast("string").alias("day"),
    )


# --- Scalar functions ----------------------------------------------------------


@check("F1_trim", "SELECT row_order, trim(padded) AS label FROM order_text")
def trim(spark, folder):
    return order_text(spark, folder).select("row_order", text.trimmed(F.col("padded")).alias("label"))


@check(
    "F2_month_id_from_text",
    "SELECT row_order, TRY_CAST(replace(REF_DATE, '-', '') AS INTEGER) AS date_id FROM order_text",
)
def month_id_from_text(spark, folder):
    return order_text(spark, folder).select(
        "row_order", periods.month_id_from_text(F.col("REF_DATE")).alias("date_id")
    )


@check("F3_annual_id", "SELECT o_orderkey, CAST(year(o_orderdate) * 100 AS INTEGER) AS date_id FROM orders")
def annual_id(spark, folder):
    year = F.year("o_orderdate")
    return table(spark, folder, "orders").select("o_orderkey", periods.annual_id(year).alias("date_id"))


@check(
    "F4_month_and_october_id",
    "SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS date_id, "
    "CAST(year(o_orderdate) * 100 + 10 AS INTEGER) AS october_id FROM orders",
)
def month_and_october_id(spark, folder):
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        periods.month_id(year, month).alias("date_id"),
        periods.october_id(year).alias("october_id"),
    )


@check(
    "F5_quarter_end_month",
    "SELECT event_id, CAST(CASE WHEN event_id % 10 BETWEEN 1 AND 4 THEN event_id % 10 * 3 END AS INTEGER) "
    "AS end_month FROM events",
)
def quarter_end_month(spark, folder):
    quarter = F.col("event_id") % 10
    return table(spark, folder, "events").select(
        "event_id", periods.quarter_end_month(quarter).alias("end_month")
    )


@check("F6_quarter_of_month", "SELECT o_orderkey, CAST(quarter(o_orderdate) AS INTEGER) AS quarter FROM orders")
def quarter_of_month(spark, folder):
    quarter = periods.quarter_of_month(F.month("o_orderdate")).alias("quarter")
    return table(spark, folder, "orders").select("o_orderkey", quarter)


@check(
    "F7_month_number",
    "SELECT file, row_idx, CASE WHEN month_text <> 'TOTAL' THEN "
    "CAST(month(strptime(month_text || ' 2000', '%b %Y')) AS INTEGER) END AS month FROM rate_grid",
)
def month_number(spark, folder):
    return rate_grid(spark, folder).select(
        "file", "row_idx", periods.month_number(cell(1)).alias("month")
    )


@check(
    "F8_clean_number",
    f"SELECT row_order, {number('translate(raw, $$%$,$$, $$$$)')} AS value FROM order_text".replace("$$", "'"),
)
def clean_number(spark, folder):
    return order_text(spark, folder).select(
        "row_order", numbers.cleaned_double(F.col("raw")).alias("value")
    )


@check("F9_safe_number", f"SELECT row_order, {number('VALUE')} AS value FROM published")
def safe_number(spark, folder):
    value = numbers.safe_double(F.col("VALUE")).alias("value")
    return published(spark, folder).select("row_order", value)


@check(
    "F10_year_in_text",
    "SELECT DISTINCT file, CAST(regexp_extract(file, '(20\\d{2})', 1) AS INTEGER) AS file_year FROM survey_rows",
)
def year_in_text(spark, folder):
    year = periods.year_in_text(F.col("file")).alias("file_year")
    return survey_grid(spark, folder).select("file", year).distinct()


@check("F11_period_label", "SELECT file, row_idx, stated_year, quarter FROM credit_filled")
def period_label(spark, folder):
    rows = credit_grid(spark, folder).filter(
        F.col("sheet").startswith("DATA") & (F.col("row_idx") >= fixed.CREDIT_FIRST_ROW)
    )
    return rows.select(
        "file",
        "row_idx",
        periods.label_year(cell(0)).alias("stated_year"),
        periods.label_quarter(cell(0)).alias("quarter"),
    )


@check(
    "F12_round",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_discount * 100 + l_tax, 4) AS rate FROM lineitem",
)
def round_four(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        numbers.rounded_rate(F.col("l_discount") * 100 + F.col("l_tax")).alias("rate"),
    )


@check(
    "F13_without_suffix",
    "SELECT file, regexp_replace(label, '\\s+CMA$', '') AS centre FROM survey_rows WHERE kind = 'occupied_rent'",
)
def without_suffix(spark, folder):
    rows = survey_grid(spark, folder).filter(
        (F.col("sheet") == fixed.OCCUPIED_SHEET) & (F.col("row_idx") >= fixed.OCCUPIED_FIRST_ROW)
    )
    return rows.select("file", text.without_city_suffix(text.trimmed(cell(0))).alias("centre"))


@check("F14_row_year_or_file_year", "SELECT file, year FROM survey_rows WHERE kind = 'occupied_rent'")
def row_year_or_file_year(spark, folder):
    rows = survey_grid(spark, folder).filter(
        (F.col("sheet") == fixed.OCCUPIED_SHEET) & (F.col("row_idx") >= fixed.OCCUPIED_FIRST_ROW)
    )
    year = F.coalesce(numbers.safe_int(cell(1)), periods.year_in_text(F.col("file")))
    return rows.select("file", year.alias("year"))


@check("F15_survey_kind", "SELECT DISTINCT file, kind FROM survey_rows")
def survey_kind(spark, folder):
    return survey_sheets(survey_grid(spark, folder)).select("file", "kind")


@check(
    "F16_split_date_id",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
        CAST(quarter(o_orderdate) AS INTEGER) AS quarter, false AS is_annual FROM orders""",
)
def split_date_id(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", month_of_date(F.col("o_orderdate")).alias("date_id")
    )
    at = F.col("date_id")
    return rows.select(
        "o_orderkey",
        periods.year_of(at).alias("year"),
        periods.month_of(at).alias("month"),
        periods.quarter_of_month(periods.month_of(at)).alias("quarter"),
        periods.is_annual(at).alias("is_annual"),
    )


@check(
    "F17_load_time",
    "SELECT row_order, row_order % 3 = 0 AS is_fresh FROM (SELECT DISTINCT row_order FROM order_text)",
)
def load_time(spark, folder):
    """Rows of a batch bear a time after the call began; the kept ones bear their old time."""
    began = datetime.now(timezone.utc)
    old = F.lit("2001-02-03").cast("timestamp")
    target = order_text(spark, folder).select("row_order", "raw").withColumn("loaded_at", old)
    batch = target.filter("row_order % 3 = 0").drop("loaded_at")
    loaded = upsert(target, batch, ["row_order"])
    kept = F.col("loaded_at") == old
    fresh = F.col("loaded_at") >= F.lit(began) - F.expr("interval 1 second")
    return loaded.select("row_order", F.when(kept, F.lit(False)).when(fresh, F.lit(True)).alias("is_fresh"))


@check(
    "F18_range_text",
    """SELECT c_custkey, coalesce(CAST(low AS VARCHAR), '(no data)') AS low, coalesce(CAST(high AS VARCHAR), '(no data)') AS high,
        c_name || ': ' || coalesce(CAST(low AS VARCHAR), '(no data)') || '–' || coalesce(CAST(high AS VARCHAR), '(no data)')
            || ' monthly' AS line
    FROM customer LEFT JOIN (
        SELECT o_custkey, CAST(year(min(o_orderdate)) AS INTEGER) AS low, CAST(year(max(o_orderdate)) AS INTEGER) AS high
        FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
)
def range_text(spark, folder):
    spans = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.year(F.min("o_orderdate")).alias("first"), F.year(F.max("o_orderdate")).alias("last")
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    low, high = text.or_no_data(F.col("first")), text.or_no_data(F.col("last"))
    return customers.join(spans, "c_custkey", "left").select(
        "c_custkey",
        low.alias("low"),
        high.alias("high"),
        text.availability_line(F.col("c_name"), low, high, F.lit("monthly")).alias("line"),
    )
