"""Aggregations (A), windows (W), order and top-k (O), unions (U), reshapes (M)."""

from pyspark.sql import functions as F

from seriesmart import fixed_values as fixed
from seriesmart.checks.base import (
    check,
    credit_grid,
    published,
    rate_grid,
    seeds,
    staged,
    tenure_grid,
)
from seriesmart.checks.transforms import cpi_inputs, income_rows, target_and_batch, tenure
from seriesmart.functions import numbers, periods, text
from seriesmart.operators import bitmaps, lookup
from seriesmart.operators.fill import forward_fill
from seriesmart.operators.reshape import cell, pivot_first, unpivot_by_header, unpivot_positions
from seriesmart.operators.upsert import latest_per_key, union_all
from seriesmart.plans import questions
from seriesmart.plans.availability import Family, availability_report, family_years
from seriesmart.plans.series import city_series
from seriesmart.plans.trade import stored_trade_mart, table, trade_mart
from seriesmart.sources.scratch import fresh_folder

TRADE_FAMILIES = [
    Family("order_value", "Order values", "Order value%"),
    Family("ship_price", "Ship prices", "Ship price%", None, "quarterly"),
    Family("september", "September ship prices", "Ship price%", 9, "annual"),
    Family("urgent", "Urgent orders", ["Order value - 1-URGENT"]),
    Family("mixed", "Low and returned", ["Order value - 5-LOW", "Ship price - R"]),
    Family("none", "Nothing held", "Vacancy rate%", None, "annual"),
]

FAMILY_SQL = """
    SELECT f.family, f.title, f.grain, CAST(min(s.year) AS INTEGER) AS min_year, CAST(max(s.year) AS INTEGER) AS max_year
    FROM (VALUES ('order_value', 'Order values', 'monthly'), ('ship_price', 'Ship prices', 'quarterly'),
        ('september', 'September ship prices', 'annual'), ('urgent', 'Urgent orders', 'monthly'),
        ('mixed', 'Low and returned', 'monthly'), ('none', 'Nothing held', 'annual')) f(family, title, grain)
    LEFT JOIN trade_series s ON CASE f.family
        WHEN 'order_value' THEN s.indicator_name LIKE 'Order value%'
        WHEN 'ship_price' THEN s.indicator_name LIKE 'Ship price%'
        WHEN 'september' THEN s.indicator_name LIKE 'Ship price%' AND s.month = 9
        WHEN 'urgent' THEN s.indicator_name = 'Order value - 1-URGENT'
        WHEN 'mixed' THEN s.indicator_name IN ('Order value - 5-LOW', 'Ship price - R')
        ELSE s.indicator_name LIKE 'Vacancy rate%' END
    GROUP BY ALL"""


def trade_years(spark, folder):
    mart = trade_mart(spark, folder)
    return family_years(mart.monthly, mart.indicators, mart.calendar, TRADE_FAMILIES)


@check(
    "A1_year_range",
    """SELECT coalesce(CAST(min(year) AS VARCHAR), '(no data)') AS min_year,
        coalesce(CAST(max(year) AS VARCHAR), '(no data)') AS max_year
    FROM trade_series WHERE indicator_name LIKE 'Order value%'""",
)
def year_range(spark, folder):
    mart = stored_trade_mart(spark, folder, fresh_folder(spark, "mart"))
    family = Family("order_value", "Order values", "Order value%")
    years = family_years(mart.monthly, mart.indicators, mart.calendar, [family])
    return availability_report(years).select("min_year", "max_year")


@check("A2_family_coverage", FAMILY_SQL)
def family_coverage(spark, folder):
    return trade_years(spark, folder)


@check(
    "A3_pivot_first",
    "SELECT geography_id, date_id, income_source, age_group, sex, median_income, avg_income, num_persons FROM income",
)
def pivot_first_figures(spark, folder):
    rows = income_rows(published(spark, folder))
    figures = rows.select(
        text.trimmed(F.col("GEO")).alias("label"),
        periods.annual_id(numbers.safe_int(F.col("REF_DATE"))).alias("date_id"),
        text.trimmed(F.col("`Income source`")).alias("income_source"),
        F.col("`Age group`").alias("age_group"),
        F.col("Sex").alias("sex"),
        "Statistics",
        numbers.safe_double(F.col("VALUE")).alias("value"),
        "row_order",
    )
    dims = seeds(spark)
    placed = lookup.lookup(figures, lookup.place_ids(dims.spellings, dims.geography), ["label"])
    keys = ["geography_id", "date_id", "income_source", "age_group", "sex"]
    wide = pivot_first(placed, keys, "Statistics", "value", "row_order", fixed.INCOME_STATISTICS)
    return wide.withColumn("num_persons", numbers.whole_count(F.col("num_persons")))


@check("A4_distinct_names", "SELECT DISTINCT canonical FROM published JOIN spelling ON label = trim(GEO)")
def distinct_names(spark, folder):
    rows = lookup.canonical(published(spark, folder), seeds(spark).spellings, "GEO")
    return rows.select("canonical").distinct()


@check(
    "A5_distinct_count_per_sheet",
    """SELECT g.sheet, count(*) AS row_count, count(DISTINCT canonical) AS city_count
    FROM median_grid g JOIN spelling s ON s.label = trim(g.label) GROUP BY g.sheet""",
)
def distinct_count_per_sheet(spark, folder):
    rows = tenure_grid(spark, folder, "median").filter(F.col("row_idx") > fixed.TENURE_HEADER_ROW)
    named = lookup.canonical(rows.withColumn("name", cell(0)), seeds(spark).spellings, "name")
    # Counting names once per sheet: the first step leaves one row per (sheet, name).
    per_name = named.groupBy("sheet", "canonical").agg(F.count("*").alias("n"))
    return per_name.groupBy("sheet").agg(
        F.sum("n").alias("row_count"), F.count("*").alias("city_count")
    )


@check("A6_row_counts", "SELECT UOM AS batch, count(*) AS row_count FROM published GROUP BY UOM")
def row_counts(spark, folder):
    rows = published(spark, folder)
    return rows.groupBy(F.col("UOM").alias("batch")).agg(F.count("*").alias("row_count"))


@check("W1_forward_fill", "SELECT file, sheet, row_idx, stated_year, carried_year FROM credit_filled")
def forward_filled(spark, folder):
    rows = credit_grid(spark, folder).filter(
        F.col("sheet").startswith("DATA") & (F.col("row_idx") >= fixed.CREDIT_FIRST_ROW)
    )
    stated = rows.withColumn("stated_year", periods.label_year(cell(0)))
    filled = forward_fill(stated, "stated_year", ["file", "sheet"], "row_idx", "carried_year")
    return filled.select("file", "sheet", "row_idx", "stated_year", "carried_year")


@check(
    "W2_latest_per_key",
    """SELECT geography_id, date_id, indicator_id, row_order, value FROM (
        SELECT *, row_number() OVER (PARTITION BY geography_id, date_id, indicator_id ORDER BY row_order DESC) AS rn
        FROM cpi) WHERE rn = 1""",
)
def latest_rows(spark, folder):
    rows = city_series(*cpi_inputs(spark, folder), keep=["row_order"])
    newest = latest_per_key(rows, ["geography_id", "date_id", "indicator_id"], ["row_order"])
    return newest.select("geography_id", "date_id", "indicator_id", "row_order", "value")


@check(
    "O1_sorted_output",
    "SELECT geography_id, date_id, tenure, median_income, avg_income FROM tenure ORDER BY ALL",
)
def sorted_output(spark, folder):
    return tenure(spark, folder).orderBy("geography_id", "date_id", "tenure")


@check("O2_sorted_names", "SELECT DISTINCT trim(GEO) AS label FROM published ORDER BY label")
def sorted_names(spark, folder):
    rows = published(spark, folder).select(text.trimmed(F.col("GEO")).alias("label"))
    return rows.distinct().orderBy("label")


@check(
    "O3_newest_row",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
)
def newest_row(spark, folder):
    rows = table(spark, folder, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1)
    return rows.select("o_orderkey", "o_totalprice")


@check(
    "O4_lowest_and_highest",
    """, latest AS (SELECT cma_name, max(date_id) AS date_id, arg_max(value, date_id) AS value FROM trade_series
        WHERE indicator_name = 'Order value - 2-HIGH' GROUP BY cma_name)
    SELECT * FROM (SELECT 'lowest' AS side, cma_name, date_id, value FROM latest ORDER BY value, cma_name LIMIT 1)
    UNION ALL SELECT * FROM (
        SELECT 'highest', cma_name, date_id, value FROM latest ORDER BY value DESC, cma_name LIMIT 1)""",
)
def lowest_and_highest(spark, folder):
    mart = stored_trade_mart(spark, folder, fresh_folder(spark, "mart"))
    rows = questions.lowest_and_highest(mart, "Order value - 2-HIGH")
    return rows.withColumn("value", F.col("value").cast("double"))


@check(
    "U1_union_of_sheets",
    """SELECT 'credit' AS kind, file, sheet, row_idx FROM credit_grid
    UNION ALL SELECT 'rate', file, sheet, row_idx FROM rate_grid""",
)
def union_of_sheets(spark, folder):
    columns = ["kind", "file", "sheet", "row_idx"]
    credit = credit_grid(spark, folder).withColumn("kind", F.lit("credit")).select(*columns)
    rates = rate_grid(spark, folder).withColumn("kind", F.lit("rate")).select(*columns)
    return union_all([credit, rates])


@check(
    "U2_append",
    """SELECT geography_id, date_id, indicator_id, value FROM cpi_target
    UNION ALL SELECT geography_id, date_id, indicator_id, value FROM cpi_batch""",
)
def append(spark, folder):
    key = ["geography_id", "date_id", "indicator_id"]
    target, batch = target_and_batch(spark, folder)
    return union_all([target, latest_per_key(batch, key, ["row_order"]).drop("row_order")])


@check(
    "M1_unpivot_positions",
    """SELECT file, row_idx, term, raw FROM rate_grid,
        LATERAL (SELECT unnest(['1 year', '3 year', '5 year']) AS term, unnest(texts) AS raw)
    WHERE raw IS NOT NULL""",
)
def unpivot_terms(spark, folder):
    rows = unpivot_positions(
        rate_grid(spark, folder), fixed.RATE_POSITIONS, ["file", "row_idx"], "term", "raw"
    )
    return rows.na.drop(subset=["raw"])


@check(
    "M2_unpivot_by_header",
    """SELECT sheet, row_idx, trim(label) AS label, year, raw FROM (
        SELECT sheet, row_idx, label, CAST(unnest([2006, 2011, 2016]) AS INTEGER) AS year, unnest(texts) AS raw
        FROM median_grid) WHERE raw IS NOT NULL""",
)
def unpivot_years(spark, folder):
    rows = unpivot_by_header(staged(tenure_grid(spark, folder, "median"), "median"), fixed.TENURE_HEADER_ROW, "raw")
    rows = rows.na.drop(subset=["raw"])
    return rows.select("sheet", "row_idx", text.trimmed(F.col("label")).alias("label"), "year", "raw")


@check(
    "A8_distinct_by_bitmaps",
    """, placed_orders AS (SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey
        FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT nation, year, count(DISTINCT o_custkey) AS customers FROM placed_orders GROUP BY nation, year
    UNION ALL SELECT nation, NULL, count(DISTINCT o_custkey) FROM placed_orders GROUP BY nation
    UNION ALL SELECT NULL, year, count(DISTINCT o_custkey) FROM placed_orders GROUP BY year
    UNION ALL SELECT NULL, NULL, count(DISTINCT o_custkey) FROM placed_orders""",
)
def distinct_by_bitmaps(spark, folder):
    """Customers with orders by nation and year, by either and over all, from one stored table of bitmaps."""
    owners = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    orders = table(spark, folder, "orders").select("o_custkey", F.year("o_orderdate").alias("year")).distinct()
    maps = bitmaps.bitmaps(orders.join(owners, F.col("o_custkey") == F.col("c_custkey")), ["nation", "year"], "o_custkey")
    held = staged(maps, "bitmaps")
    found = [bitmaps.distinct_counts(held, keys, "customers") for keys in (["nation", "year"], ["nation"], ["year"], [])]
    layout = ["nation", "year", "customers"]
    whole = [
        rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast(found[0].schema[c].dataType).alias(c) for c in layout))
        for rows in found
    ]
    return union_all(whole)
