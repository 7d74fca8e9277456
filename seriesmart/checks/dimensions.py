"""Dimension builders (D) and loads (L)."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from seriesmart.checks.base import FUEL, check, published, quoted, seeds, staged
from seriesmart.checks.transforms import (
    SPECS,
    cpi_inputs,
    income_rows,
    target_and_batch,
    tenure,
)
from seriesmart.operators.dims import insert_absent
from seriesmart.operators.numbering import number_rows
from seriesmart.operators.upsert import as_layout, latest_per_key
from seriesmart.plans import series
from seriesmart.plans.loads import load
from seriesmart.plans.trade import table, trade_calendar
from seriesmart.schemas import FACT_MONTHLY, INCOME_KEY, MONTHLY_KEY, TENURE_KEY, staging
from seriesmart.sources.scratch import fresh_folder
from seriesmart.sources.tables import cluster_published, publish, read_published, reload_staging, upsert_published


def plain(rows):
    """Fact columns in comparable types, without the load time."""
    return rows.select(*MONTHLY_KEY, F.col("value").cast("double").alias("value"))


@check(
    "D1_surrogate_keys",
    "SELECT c_name, CAST(row_number() OVER (ORDER BY md5(c_name), c_name) AS INTEGER) AS customer_id FROM customer",
)
def surrogate_keys(spark, folder):
    return number_rows(table(spark, folder, "customer").select("c_name"), ["c_name"], "customer_id")


@check(
    "D2_insert_if_absent",
    """, old AS (
        SELECT c_name, c_mktsegment, CAST(row_number() OVER (ORDER BY md5(c_name), c_name) AS INTEGER) AS customer_id
        FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT * FROM old UNION ALL
    SELECT c_name, c_mktsegment, CAST((SELECT max(customer_id) FROM old)
        + row_number() OVER (ORDER BY md5(c_name), c_name) AS INTEGER)
    FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def insert_if_absent(spark, folder):
    names = table(spark, folder, "customer").select("c_name", "c_mktsegment")
    old = number_rows(names.filter("c_mktsegment = 'BUILDING'"), ["c_name"], "customer_id")
    return insert_absent(staged(old, "dimension"), names, ["c_name"], "customer_id")


@check(
    "D3_calendar",
    """SELECT CAST(y * 100 + m AS INTEGER) AS date_id, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month,
        CAST(CASE WHEN m > 0 THEN ceil(m / 3.0) END AS INTEGER) AS quarter, m = 0 AS is_annual
    FROM (SELECT unnest(range(
            (SELECT least(year(min(o_orderdate)), (SELECT year(min(l_shipdate)) FROM lineitem)) FROM orders),
            (SELECT greatest(year(max(o_orderdate)), (SELECT year(max(l_shipdate)) FROM lineitem)) FROM orders) + 1)) AS y),
        (SELECT unnest(range(0, 13)) AS m)""",
)
def calendar(spark, folder):
    days = trade_calendar(spark, folder)
    return days.select(
        "date_id", *(F.col(c).cast("int").alias(c) for c in ("year", "month", "quarter")), "is_annual"
    )


UPSERT_SQL = """
    SELECT geography_id, date_id, indicator_id, value FROM cpi_batch UNION ALL
    SELECT geography_id, date_id, indicator_id, value FROM cpi_target t WHERE NOT EXISTS (
        SELECT 1 FROM cpi_batch b WHERE b.geography_id = t.geography_id
          AND b.date_id = t.date_id AND b.indicator_id = t.indicator_id)"""


def published_upsert(spark, target, batch, keys, order=None):
    """What production does: a published table, then an upsert of a batch into it."""
    root = fresh_folder(spark, "fact")
    publish(spark, target.withColumn("loaded_at", F.current_timestamp()), root)
    upsert_published(spark, root, batch, keys, order)
    return read_published(spark, root).drop("year")


@check("L1_upsert_monthly", UPSERT_SQL)
def upsert_monthly(spark, folder):
    target, batch = target_and_batch(spark, folder)
    fresh = batch.withColumn("value", F.col("value").cast("decimal(12,4)"))
    return plain(published_upsert(spark, as_layout(target, FACT_MONTHLY), fresh, MONTHLY_KEY, ["row_order"]))


@check(
    "L2_upsert_income",
    """, batch AS (
        SELECT geography_id, CAST(REF_YEAR AS INTEGER) * 100 AS date_id, trim(income_source) AS income_source,
            age_group, sex,
            arg_min(value_num, row_order) FILTER (statistic = 'Median income (excluding zeros)') AS median_income,
            arg_min(value_num, row_order) FILTER (statistic = 'Average income (excluding zeros)') AS avg_income,
            CAST(round(arg_min(value_num, row_order) FILTER (statistic = 'Number of persons with income')) AS BIGINT)
                AS num_persons
        FROM placed WHERE UOM = '2002=100' GROUP BY ALL)
    SELECT * FROM batch UNION ALL
    SELECT * FROM income t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.geography_id = t.geography_id
        AND b.date_id = t.date_id AND b.income_source = t.income_source AND b.age_group = t.age_group AND b.sex = t.sex)""",
)
def upsert_income(spark, folder):
    rows, dims = income_rows(published(spark, folder)), seeds(spark)
    target = series.income_facts(rows, dims, "row_order")
    batch = series.income_facts(rows.filter("UOM = '2002=100'"), dims, "row_order")
    return published_upsert(spark, target, batch, INCOME_KEY).drop("loaded_at")


@check(
    "L3_upsert_tenure",
    """SELECT geography_id, date_id, tenure, avg_income AS median_income, median_income AS avg_income
    FROM tenure WHERE tenure <> 'Owner' UNION ALL SELECT * FROM tenure WHERE tenure = 'Owner'""",
)
def upsert_tenure(spark, folder):
    target = staged(tenure(spark, folder), "tenure")
    batch = target.filter("tenure <> 'Owner'").select(
        *TENURE_KEY, F.col("avg_income").alias("median_income"), F.col("median_income").alias("avg_income")
    )
    return published_upsert(spark, target, batch, TENURE_KEY).drop("loaded_at")


@check(
    "L4_reload_staging",
    f"SELECT geography_id, date_id, indicator_id, value FROM cpi WHERE fuel <> {quoted(FUEL)}",
)
def reload(spark, folder):
    target, batch = target_and_batch(spark, folder)
    path = fresh_folder(spark, "staging")
    for rows in (target, batch):
        staged = reload_staging(as_layout(rows, staging(FACT_MONTHLY)), path)
    return plain(staged)


@check(
    "L5_load_in_order",
    f""", loads AS (
        SELECT 0 AS load_no, geography_id, date_id, indicator_id, value FROM cpi WHERE fuel = {quoted(FUEL)}
        UNION ALL SELECT 1, geography_id, date_id, indicator_id, value FROM nhpi
        UNION ALL SELECT 2, geography_id, date_id, indicator_id, value FROM cpi WHERE fuel <> {quoted(FUEL)})
    SELECT geography_id, date_id, indicator_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY geography_id, date_id, indicator_id
            ORDER BY load_no DESC, value DESC) AS rn FROM loads) WHERE rn = 1""",
)
def load_in_order(spark, folder):
    root = fresh_folder(spark, "mart")
    rows = series.city_series(*cpi_inputs(spark, folder), keep=["fuel"])
    nhpi = series.city_series(published(spark, folder), seeds(spark), SPECS["nhpi"])
    first, later = rows.filter(F.col("fuel") == FUEL), rows.filter(F.col("fuel") != FUEL)
    load(spark, root, [("cpi_cma", first), ("nhpi", nhpi), ("cpi_cma", later)])
    return plain(read_published(spark, f"{root}/fact_monthly"))


def dealt_load(spark, folder, root, part):
    """A writer with a session of its own, which loads one half of the batch's cities."""
    _, batch = target_and_batch(spark, folder)
    own = batch.filter(F.col("geography_id") % 2 == part)
    load(spark, root, [("cpi_cma", latest_per_key(own, MONTHLY_KEY, ["row_order"]).drop("row_order"))])


@check("L6_two_writers", UPSERT_SQL)
def two_writers(spark, folder):
    """Two writers load into one mart at the same time, in the same years."""
    root = fresh_folder(spark, "mart")
    target, _ = target_and_batch(spark, folder)
    load(spark, root, [("cpi_cma", target)])
    with ThreadPoolExecutor(2) as writers:
        done = [writers.submit(dealt_load, spark.newSession(), folder, root, part) for part in (0, 1)]
    for writer in done:
        writer.result()
    return plain(read_published(spark, f"{root}/fact_monthly"))


@check("L7_clustered_layout", UPSERT_SQL)
def clustered_layout(spark, folder):
    """A table in Z-order, an upsert into some of its years, and these put into Z-order again."""
    target, batch = target_and_batch(spark, folder)
    root = fresh_folder(spark, "fact")
    publish(spark, as_layout(target, FACT_MONTHLY).withColumn("loaded_at", F.current_timestamp()), root)
    cluster_published(spark, root)
    upsert_published(spark, root, batch.withColumn("value", F.col("value").cast("decimal(12,4)")), MONTHLY_KEY, ["row_order"])
    cluster_published(spark, root)
    return plain(read_published(spark, root).drop("year"))
