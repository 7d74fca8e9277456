"""End-to-end transforms (E) on the published-style table and the cell grids."""

from dataclasses import replace

from pyspark.sql import functions as F

from seriesmart.checks.base import (
    FUEL,
    check,
    credit_grid,
    published,
    rate_grid,
    regional_raw,
    seeds,
    staged,
    survey_grid,
    tenure_grid,
)
from seriesmart.operators.upsert import latest_per_key
from seriesmart.plans import grids, series

SPECS = {
    "cpi": replace(series.CPI, label_column="product"),
    "gasoline": replace(series.GASOLINE, label_column="fuel", where={"fuel": series.GASOLINE.where["Type of fuel"]}),
    "nhpi": replace(series.HOUSE_PRICES, label_column="house_index"),
}


def cpi_inputs(spark, folder):
    return published(spark, folder), seeds(spark), SPECS["cpi"]


def target_and_batch(spark, folder):
    """A monthly fact table and a later batch of rows, some for the same keys."""
    key = ["geography_id", "date_id", "indicator_id"]
    rows = series.city_series(*cpi_inputs(spark, folder), keep=["row_order", "fuel"])
    first = rows.filter(F.col("fuel") == FUEL).drop("fuel")
    target = latest_per_key(first, key, ["row_order"]).drop("row_order")
    return target, rows.filter(F.col("fuel") != FUEL).drop("fuel")


def income_rows(rows):
    return rows.drop("REF_DATE").withColumnRenamed("REF_YEAR", "REF_DATE")


@check("E1_consumer_prices", "SELECT geography_id, date_id, indicator_id, value FROM cpi")
def consumer_prices(spark, folder):
    return series.city_series(*cpi_inputs(spark, folder))


@check(
    "E2_gasoline_prices",
    """SELECT geography_id, date_id, i.indicator_id, value_num AS value FROM placed
    JOIN dim_indicator i ON i.indicator_name = 'Gasoline price (per litre)' AND i.source = 'StatCan'
    WHERE fuel = 'Regular unleaded gasoline at self service filling stations'""",
)
def gasoline_prices(spark, folder):
    return series.city_series(published(spark, folder), seeds(spark), SPECS["gasoline"])


@check(
    "E3_food_prices",
    """SELECT g.geography_id, CAST(replace(r.REF_DATE, '-', '') AS INTEGER) AS date_id, i.indicator_id, r.value
    FROM regional r JOIN member m ON m.region = r.GEO JOIN dim_geography g ON g.cma_name = m.canonical
    JOIN food_label f ON f.label = r.product
    JOIN dim_indicator i ON i.indicator_name = f.indicator_name AND i.source = 'StatCan'""",
)
def food_prices(spark, folder):
    return series.regional_series(regional_raw(published(spark, folder)), seeds(spark), series.FOOD)


@check("E4_house_prices", "SELECT geography_id, date_id, indicator_id, value FROM nhpi")
def house_prices(spark, folder):
    return series.city_series(published(spark, folder), seeds(spark), SPECS["nhpi"])


@check("E5_annual_income", "SELECT * FROM income")
def annual_income(spark, folder):
    return series.income_facts(income_rows(published(spark, folder)), seeds(spark), "row_order")


@check(
    "E6_rental_survey",
    """SELECT g.geography_id, CAST(r.year * 100 + 10 AS INTEGER) AS date_id, i.indicator_id, r.value
    FROM rental_records r JOIN dim_geography g ON g.cma_name = r.centre
    JOIN survey_series s ON s.data_type = r.data_type AND s.bedroom_type = r.bedroom_type
    JOIN dim_indicator i ON i.indicator_name = s.indicator_name AND i.source = 'CMHC'""",
)
def rental_survey(spark, folder):
    dims = seeds(spark)
    grid = staged(survey_grid(spark, folder), "survey")
    return grids.rental_facts(grids.rental_records(grid, dims.spellings), dims)


@check("E7_income_by_tenure", "SELECT * FROM tenure")
def tenure(spark, folder):
    dims = seeds(spark)
    records = [
        grids.tenure_records(staged(tenure_grid(spark, folder, measure), measure), dims.spellings, column)
        for measure, column in (("median", "median_income"), ("average", "avg_income"))
    ]
    return grids.tenure_facts(*records, dims)


@check(
    "E8_mortgage_rates",
    """SELECT (SELECT geography_id FROM dim_geography WHERE cma_name = 'Canada') AS geography_id,
        CAST(year * 100 + month AS INTEGER) AS date_id, indicator_id, rate AS value
    FROM rate_records JOIN dim_indicator ON indicator_name = 'Mortgage rate - ' || term""",
)
def mortgage_rates(spark, folder):
    return grids.rate_facts(grids.rate_records(rate_grid(spark, folder)), seeds(spark))


@check(
    "E9_credit_trends",
    """SELECT geography_id, CAST(year * 100 + quarter * 3 AS INTEGER) AS date_id, indicator_id, value
    FROM credit_records r JOIN dim_geography g ON g.cma_name = r.geography
    JOIN dim_indicator i ON i.indicator_name = r.indicator_name AND i.source = 'CMHC'
    WHERE quarter BETWEEN 1 AND 4""",
)
def credit_trends(spark, folder):
    return grids.credit_facts(grids.credit_records(credit_grid(spark, folder)), seeds(spark))
