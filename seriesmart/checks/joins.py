"""Lookups and joins (J) and set operations on names (U3)."""

from pyspark.sql import functions as F

from seriesmart.checks.base import (
    annual_balances,
    check,
    published,
    regional_raw,
    seeds,
    staged,
    tenure_grid,
)
from seriesmart.functions import numbers, text
from seriesmart.operators import lookup
from seriesmart.operators.dims import calendar_rows
from seriesmart.operators.reshape import outer_merge
from seriesmart.operators.upsert import matched, without_matched
from seriesmart.plans import questions
from seriesmart.plans.grids import tenure_records
from seriesmart.plans.series import CPI
from seriesmart.plans.trade import (
    order_values,
    table,
    trade_facts,
    trade_mart,
    with_indicator_ids,
)


def _cpi_labels(spark):
    return lookup.fixed_table(spark, CPI.labels.items(), ["series_label", "indicator_name"])


@check(
    "J1_canonical_name",
    "SELECT row_order, canonical FROM published JOIN spelling ON label = trim(GEO)",
)
def canonical_name(spark, folder):
    rows = lookup.canonical(published(spark, folder), seeds(spark).spellings, "GEO")
    return rows.select("row_order", "canonical")


@check(
    "J2_label_to_indicator",
    "SELECT row_order, indicator_name FROM published JOIN cpi_label ON label = trim(product)",
)
def label_to_indicator(spark, folder):
    rows = published(spark, folder).withColumn("series_label", text.trimmed(F.col("product")))
    return lookup.lookup(rows, _cpi_labels(spark), ["series_label"]).select("row_order", "indicator_name")


@check(
    "J3_composite_key",
    """SELECT row_order, indicator_id FROM published JOIN cpi_label c ON c.label = trim(product)
    JOIN dim_indicator i ON i.indicator_name = c.indicator_name
        AND i.source = CASE WHEN UOM = '2002=100' THEN 'StatCan' ELSE 'CMHC' END""",
)
def composite_key(spark, folder):
    source = F.when(F.col("UOM") == "2002=100", F.lit("StatCan")).otherwise(F.lit("CMHC"))
    rows = published(spark, folder).select(
        "row_order", text.trimmed(F.col("product")).alias("series_label"), source.alias("source")
    )
    named = lookup.lookup(rows, _cpi_labels(spark), ["series_label"])
    return lookup.lookup(named, seeds(spark).indicators, ["indicator_name", "source"]).select(
        "row_order", "indicator_id"
    )


@check(
    "J4_chained_lookup",
    """SELECT row_order, indicator_id FROM published LEFT JOIN cpi_label c ON c.label = trim(product)
    LEFT JOIN dim_indicator i ON i.indicator_name = c.indicator_name AND i.source = 'StatCan'""",
)
def chained_lookup(spark, folder):
    rows = published(spark, folder).withColumn("series_label", text.trimmed(F.col("product")))
    ids = lookup.series_ids(_cpi_labels(spark), seeds(spark).indicators, "StatCan")
    return lookup.lookup(rows, ids, ["series_label"], how="left").select("row_order", "indicator_id")


@check(
    "J5_surrogate_key",
    """SELECT row_order, geography_id FROM published p JOIN spelling s ON s.label = trim(p.GEO)
    JOIN dim_geography g ON g.cma_name = s.canonical""",
)
def surrogate_key(spark, folder):
    dims = seeds(spark)
    rows = published(spark, folder).withColumn("label", text.trimmed(F.col("GEO")))
    ids = lookup.place_ids(dims.spellings, dims.geography)
    keyed = lookup.lookup(rows, ids, ["label"], how="left")
    return keyed.select("row_order", "geography_id").na.drop(subset=["geography_id"])


@check(
    "J6_fan_out",
    """SELECT r.GEO AS province, g.geography_id, r.REF_DATE, r.product, r.value FROM regional r
    JOIN member m ON m.region = r.GEO JOIN dim_geography g ON g.cma_name = m.canonical""",
)
def fan_out(spark, folder):
    dims = seeds(spark)
    names = dims.geography.select(F.col("cma_name").alias("canonical"), "geography_id")
    cities = dims.members.join(names, "canonical").select("region", "geography_id")
    spread = lookup.fan_out(regional_raw(published(spark, folder)), cities, "GEO")
    return spread.select(
        F.col("GEO").alias("province"),
        "geography_id",
        "REF_DATE",
        F.col("Products").alias("product"),
        numbers.safe_double(F.col("VALUE")).alias("value"),
    )


@check(
    "J7_star_join",
    "SELECT indicator_name, source, unit, frequency, cma_name, date_id, year, month, value FROM trade_series",
)
def star_join(spark, folder):
    rows = questions.series(trade_mart(spark, folder))
    return rows.select(
        "indicator_name",
        "source",
        "unit",
        "frequency",
        "cma_name",
        "date_id",
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.col("value").cast("double").alias("value"),
    )


@check(
    "J8_full_merge",
    """SELECT canonical, year, tenure, median_income, avg_income
    FROM medians FULL JOIN averages USING (canonical, year, tenure)""",
)
def full_merge(spark, folder):
    spellings = seeds(spark).spellings
    medians = tenure_records(staged(tenure_grid(spark, folder, "median"), "median"), spellings, "median_income")
    averages = tenure_records(staged(tenure_grid(spark, folder, "average"), "average"), spellings, "avg_income")
    return outer_merge(medians, averages, ["canonical", "year", "tenure"])


@check(
    "J9_missing_references",
    "SELECT DISTINCT trim(GEO) AS label FROM published WHERE trim(GEO) NOT IN (SELECT label FROM spelling)",
)
def missing_references(spark, folder):
    rows = published(spark, folder).select(text.trimmed(F.col("GEO")).alias("label"))
    return lookup.missing_references(rows, seeds(spark).spellings, ["label"])


@check(
    "J10_anti_join",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS "
    "(SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')",
)
def anti_join(spark, folder):
    urgent = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'")
    urgent = urgent.select(F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return without_matched(customers, urgent, ["c_custkey"])


@check(
    "J11_matched_rows",
    """SELECT geography_id, date_id, indicator_id, units / 10000.0 AS value FROM trade_fact
    WHERE EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN trade_indicator i ON i.indicator_name = 'Order value - ' || o_orderpriority
        WHERE o_orderstatus = 'F' AND c_nationkey + 1 = geography_id AND i.indicator_id = trade_fact.indicator_id
          AND year(o_orderdate) * 100 + month(o_orderdate) = date_id)""",
)
def matched_rows(spark, folder):
    finished = table(spark, folder, "orders").filter("o_orderstatus = 'F'")
    batch = with_indicator_ids(order_values(spark, folder, finished))
    replaced = matched(trade_facts(spark, folder), batch, ["geography_id", "date_id", "indicator_id"])
    return replaced.withColumn("value", F.col("value").cast("double"))


@check(
    "J12_years_by_months",
    """SELECT DISTINCT CAST(year(o_orderdate) * 100 + m AS INTEGER) AS date_id
    FROM orders, (SELECT unnest(range(0, 13)) AS m)""",
)
def years_by_months(spark, folder):
    years = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return calendar_rows(years).select("date_id")


@check(
    "J13_bridge_to_years",
    """SELECT f.geography_id, f.indicator_id, f.year, f.units / 10000.0 AS value, f.months, b.balance
    FROM (SELECT geography_id, indicator_id, CAST(date_id // 100 AS INTEGER) AS year,
            (2 * sum(units) + count(*)) // (2 * count(*)) AS units, count(*) AS months
          FROM trade_fact GROUP BY ALL) f
    JOIN (SELECT CAST(c_nationkey + 1 AS INTEGER) AS geography_id, CAST(year(o_orderdate) AS INTEGER) AS year,
            CAST(max(c_acctbal) AS DOUBLE) AS balance
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) b
      ON b.geography_id = f.geography_id AND b.year = f.year""",
)
def bridge_to_years(spark, folder):
    bridged = questions.bridge_to_years(trade_facts(spark, folder), annual_balances(spark, folder))
    return bridged.withColumn("value", F.col("value").cast("double"))


@check(
    "U3_name_difference",
    "SELECT DISTINCT trim(GEO) AS label FROM published EXCEPT SELECT label FROM spelling",
)
def name_difference(spark, folder):
    rows = published(spark, folder).select(text.trimmed(F.col("GEO")).alias("label"))
    return rows.subtract(seeds(spark).spellings.select("label"))
