"""An indicator mart over trade tables (orders, lineitem, customer, supplier, nation, region).

Places are nations. Orders give a monthly series per priority, shipped lines a
quarterly one per return flag. Facts are reduced by customer (supplier), period
and label before they meet the customers (suppliers), so a customer with a third
of all orders is a handful of rows by the time keys are shuffled.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seriesmart.functions import periods
from seriesmart.operators.dims import calendar_for
from seriesmart.operators.lookup import fixed_table
from seriesmart.operators.upsert import union_all
from seriesmart.plans.questions import Mart
from seriesmart.schemas import DIM_INDICATOR
from seriesmart.sources.tables import write_facts

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RETURN_FLAGS = ["A", "N", "R"]
TRADE_INDICATORS = [
    *((f"Order value - {p}", "orders", "USD", "Orders", "monthly") for p in PRIORITIES),
    *((f"Ship price - {f}", "lineitem", "USD", "Shipping", "quarterly") for f in RETURN_FLAGS),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trade_geography(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "cast(n_nationkey + 1 as int) as geography_id",
        "n_name as cma_name",
        "r_name as province",
        "cast(n_nationkey as string) as cma_code",
    )


def trade_indicators(spark: SparkSession) -> DataFrame:
    rows = [(at, *row) for at, row in enumerate(TRADE_INDICATORS, start=1)]
    return fixed_table(spark, rows, DIM_INDICATOR.fieldNames())


def month_of_date(date: Column) -> Column:
    return periods.month_id(F.year(date), F.month(date))


def _reduced(rows: DataFrame, owner: str, date_id: str, label: str, amount: str) -> DataFrame:
    """Sums in whole cents per (owner, period, label), before any join."""
    keyed = rows.selectExpr(
        f"{owner} as owner",
        f"cast({date_id} as int) as date_id",
        f"{label} as label",
        f"cast(round({amount} * 100) as bigint) as cents",
    )
    return keyed.groupBy("owner", "date_id", "label").agg(
        F.sum("cents").alias("total"), F.count("*").alias("n")
    )


def _means(reduced: DataFrame, owners: DataFrame, prefix: str) -> DataFrame:
    """Mean amounts per (nation, period, label) as DECIMAL(12,4).

    Cents become units of 1/10000, halves up, in whole numbers: exact in any
    order of summing.
    """
    sums = reduced.join(owners, "owner").groupBy("nationkey", "date_id", "label")
    sums = sums.agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return sums.selectExpr(
        "cast(nationkey + 1 as int) as geography_id",
        "date_id",
        f"concat('{prefix}', label) as indicator_name",
        "cast(((200 * total + n) div (2 * n)) / 10000 as decimal(12,4)) as value",
    )


def order_values(spark: SparkSession, folder: str, orders: DataFrame | None = None) -> DataFrame:
    """Mean order value per nation of the customer, month and priority."""
    orders = orders if orders is not None else table(spark, folder, "orders")
    owners = table(spark, folder, "customer").selectExpr("c_custkey as owner", "c_nationkey as nationkey")
    month = "year(o_orderdate) * 100 + month(o_orderdate)"
    reduced = _reduced(orders, "o_custkey", month, "o_orderpriority", "o_totalprice")
    return _means(reduced, owners, "Order value - ")


def ship_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Mean line price per nation of the supplier, quarter and return flag."""
    owners = table(spark, folder, "supplier").selectExpr("s_suppkey as owner", "s_nationkey as nationkey")
    quarter = "year(l_shipdate) * 100 + quarter(l_shipdate) * 3"
    lines = table(spark, folder, "lineitem")
    reduced = _reduced(lines, "l_suppkey", quarter, "l_returnflag", "l_extendedprice")
    return _means(reduced, owners, "Ship price - ")


def with_indicator_ids(named: DataFrame) -> DataFrame:
    ids = trade_indicators(named.sparkSession).select("indicator_id", "indicator_name")
    return named.join(ids, "indicator_name").select("geography_id", "date_id", "indicator_id", "value")


def trade_facts(spark: SparkSession, folder: str) -> DataFrame:
    """fact_monthly of the trade mart."""
    return with_indicator_ids(order_values(spark, folder).unionByName(ship_prices(spark, folder)))


def trade_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar of the trade mart, from the ends of its date columns alone."""
    dates = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
    ends = union_all(
        [
            table(spark, folder, name).selectExpr(f"min({date}) as low", f"max({date}) as high")
            for name, date in dates.items()
        ]
    )
    return calendar_for(ends.selectExpr("explode(array(year(low) * 100, year(high) * 100)) as date_id"))


def trade_mart(spark: SparkSession, folder: str) -> Mart:
    return Mart(
        geography=trade_geography(spark, folder),
        indicators=trade_indicators(spark),
        calendar=trade_calendar(spark, folder),
        monthly=trade_facts(spark, folder),
    )


def segment_balances(spark: SparkSession, folder: str) -> DataFrame:
    """An annual fact: balances of a nation's customers with orders in the year, by segment.

    The highest balance and the mean stand under the names of the annual income fact, so that its
    questions apply.
    """
    years = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    placed = years.distinct().join(customers, "c_custkey").withColumn("cents", F.round(F.col("c_acctbal") * 100).cast("long"))
    sums = placed.groupBy("c_nationkey", "year", "c_mktsegment").agg(
        F.max("cents").alias("most"), F.sum("cents").alias("total"), F.count("*").alias("n")
    )
    mean = F.round(F.col("total").cast("decimal(20,0)") / F.col("n"), 0) / 100
    return sums.select(
        (F.col("c_nationkey") + 1).cast("int").alias("geography_id"),
        periods.annual_id(F.col("year")).alias("date_id"),
        F.col("c_mktsegment").alias("income_source"),
        F.lit("All ages").alias("age_group"),
        F.lit("Both").alias("sex"),
        (F.col("most") / 100).cast("decimal(12,2)").alias("median_income"),
        mean.cast("decimal(12,2)").alias("avg_income"),
        F.col("n").alias("num_persons"),
    )


def stored_trade_mart(spark: SparkSession, folder: str, root: str) -> Mart:
    """The whole mart at rest: facts by indicator and year, so that a question prunes to its own."""
    write_facts(trade_facts(spark, folder), f"{root}/fact", partition_by=["indicator_id", "year"])
    write_facts(segment_balances(spark, folder), f"{root}/income")
    return Mart(
        geography=trade_geography(spark, folder),
        indicators=trade_indicators(spark),
        calendar=trade_calendar(spark, folder),
        monthly=spark.read.parquet(f"{root}/fact"),
        income=spark.read.parquet(f"{root}/income"),
    )
