"""Questions over the mart (Q) and nearest documents (V1)."""

from pyspark.sql import functions as F

from seriesmart.checks.aggregates import FAMILY_SQL, trade_years
from seriesmart.checks.base import annual_balances, check
from seriesmart.plans import availability, questions
from seriesmart.plans.trade import stored_trade_mart, table, trade_facts, trade_indicators, trade_mart
from seriesmart.sources import vectors
from seriesmart.sources.scratch import fresh_folder

LATEST_SQL = """, latest AS (
    SELECT indicator_name, cma_name, max(date_id) AS date_id, arg_max(value, date_id) AS value
    FROM trade_series GROUP BY ALL)
"""


def stored_mart(spark, folder):
    return stored_trade_mart(spark, folder, fresh_folder(spark, "mart"))


def as_double(rows, *columns):
    for column in columns:
        rows = rows.withColumn(column, F.col(column).cast("double"))
    return rows


def as_int(rows, *columns):
    for column in columns:
        rows = rows.withColumn(column, F.col(column).cast("int"))
    return rows


@check(
    "Q1_point_lookup",
    """SELECT indicator_name, source, unit, frequency, cma_name, date_id, year, month, value FROM trade_series
    WHERE indicator_name = 'Order value - 2-HIGH' AND cma_name = 'NATION_7' AND year = 1998""",
)
def point_lookup(spark, folder):
    rows = questions.value_of(stored_mart(spark, folder), "Order value - 2-HIGH", "NATION_7", 1998)
    return as_int(as_double(rows, "value"), "year", "month")


@check(
    "Q2_compare_cities",
    """SELECT source, date_id, max(value) FILTER (cma_name = 'NATION_3') AS "NATION_3",
        max(value) FILTER (cma_name = 'NATION_12') AS "NATION_12"
    FROM trade_series WHERE indicator_name = 'Order value - 5-LOW' AND year BETWEEN 1996 AND 1999
        AND cma_name IN ('NATION_3', 'NATION_12') GROUP BY source, date_id""",
)
def compare_cities(spark, folder):
    cities = ["NATION_3", "NATION_12"]
    rows = questions.compare_cities(stored_mart(spark, folder), "Order value - 5-LOW", cities, 1996, 1999)
    return as_double(rows, *cities)


@check(
    "Q3_rank_latest",
    LATEST_SQL
    + """SELECT CAST(row_number() OVER (ORDER BY value, cma_name) AS INTEGER) AS position, cma_name, date_id, value
    FROM latest WHERE indicator_name = 'Order value - 1-URGENT' ORDER BY 1 LIMIT 10""",
)
def rank_latest(spark, folder):
    rows = questions.rank_cities(stored_mart(spark, folder), "Order value - 1-URGENT", 10)
    return as_double(rows, "value")


@check(
    "Q4_affordability",
    LATEST_SQL
    + """, shares AS (
        SELECT r.cma_name, r.value AS rent, p.value AS price_index, round(r.value * 12 / 5000000.0, 6) AS rent_share
        FROM (SELECT * FROM latest WHERE indicator_name = 'Order value - 3-MEDIUM') r
        LEFT JOIN (SELECT * FROM latest WHERE indicator_name = 'Ship price - N') p USING (cma_name))
    SELECT CAST(row_number() OVER (ORDER BY rent_share, cma_name) AS INTEGER) AS position, *
    FROM shares ORDER BY 1 LIMIT 8""",
)
def affordability(spark, folder):
    mart = trade_mart(spark, folder)
    rows = questions.rank_affordability(mart, "Order value - 3-MEDIUM", "Ship price - N", 5_000_000, 8)
    return as_double(rows, "rent", "price_index")


@check(
    "Q5_threshold_marks",
    """SELECT indicator_name, cma_name, date_id, value,
        CASE WHEN indicator_name LIKE 'Order value%' AND value < 200000 THEN 'tight'
             WHEN indicator_name LIKE '%price - R' AND value > 40000 THEN 'elevated' END AS mark
    FROM trade_series""",
)
def threshold_marks(spark, folder):
    rules = [
        questions.Threshold("Order value%", 200_000, True, "tight"),
        questions.Threshold("%price - R", 40_000, False, "elevated"),
    ]
    rows = questions.series(trade_mart(spark, folder)).select(
        "indicator_name", "cma_name", "date_id", F.col("value").cast("double").alias("value")
    )
    return questions.threshold_marks(rows, rules)


@check(
    "Q6_availability_report",
    f"""SELECT family, coalesce(CAST(min_year AS VARCHAR), '(no data)') AS min_year,
        coalesce(CAST(max_year AS VARCHAR), '(no data)') AS max_year,
        title || ': ' || coalesce(CAST(min_year AS VARCHAR), '(no data)') || '–'
            || coalesce(CAST(max_year AS VARCHAR), '(no data)') || ' ' || grain AS line
    FROM ({FAMILY_SQL}
        UNION ALL SELECT 'balance', 'Balances', 'annual', CAST(min(year(o_orderdate)) AS INTEGER),
            CAST(max(year(o_orderdate)) AS INTEGER) FROM orders JOIN customer ON o_custkey = c_custkey)""",
)
def availability_report(spark, folder):
    years = trade_years(spark, folder)
    yearly = availability.annual_years(annual_balances(spark, folder), "balance", "Balances")
    return availability.availability_report(years.unionByName(yearly))


@check(
    "Q7_grain_notes",
    """SELECT indicator_name, source, frequency, max(date_id) AS last_date_id FROM trade_series GROUP BY ALL""",
)
def grain_notes(spark, folder):
    return questions.grain_notes(trade_mart(spark, folder))


@check(
    "Q8_what_is_available",
    """SELECT q.indicator_name, q.year, coalesce(q.year BETWEEN y.low AND y.high, false) AS in_range,
        coalesce(CAST(y.low AS VARCHAR), '(no data)') AS min_year, coalesce(CAST(y.high AS VARCHAR), '(no data)') AS max_year
    FROM (SELECT DISTINCT 'Order value - ' || o_orderpriority AS indicator_name,
              CAST(year(o_orderdate) + CASE WHEN o_orderstatus = 'F' THEN 20 ELSE 0 END AS INTEGER) AS year FROM orders
          UNION SELECT DISTINCT 'Return value - ' || l_returnflag, CAST(year(l_shipdate) AS INTEGER) FROM lineitem) q
    LEFT JOIN (SELECT indicator_name, min(year) AS low, max(year) AS high FROM trade_series GROUP BY ALL) y
        ON y.indicator_name = q.indicator_name""",
)
def what_is_available(spark, folder):
    late = F.when(F.col("o_orderstatus") == "F", F.lit(20)).otherwise(F.lit(0))
    asked = table(spark, folder, "orders").select(
        F.concat(F.lit("Order value - "), F.col("o_orderpriority")).alias("indicator_name"),
        (F.year("o_orderdate") + late).cast("int").alias("year"),
    )
    unknown = table(spark, folder, "lineitem").select(
        F.concat(F.lit("Return value - "), F.col("l_returnflag")).alias("indicator_name"),
        F.year("l_shipdate").alias("year"),
    )
    requests = asked.unionByName(unknown).distinct()
    years = availability.indicator_years(trade_facts(spark, folder), trade_indicators(spark))
    return availability.what_is_available(requests, years)


BALANCE_SQL = """, balances AS (
    SELECT n_name AS cma_name, year, c_mktsegment AS segment, round(max(c_acctbal), 2) AS most,
        round(CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / count(*)) / 100 AS mean, count(*) AS n
    FROM (SELECT DISTINCT o_custkey, year(o_orderdate) AS year FROM orders) o
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)
"""


@check(
    "Q9_annual_lookup",
    BALANCE_SQL
    + """SELECT cma_name, CAST(year AS INTEGER) AS year, segment AS income_source, most AS median_income,
        mean AS avg_income, n AS num_persons FROM balances WHERE cma_name = 'NATION_7' AND segment = 'BUILDING'""",
)
def annual_lookup(spark, folder):
    mart = stored_mart(spark, folder)
    rows = questions.annual_rows(mart.income, mart, ["NATION_7"], income_source="BUILDING").select(
        "cma_name", "year", "income_source", "median_income", "avg_income", "num_persons"
    )
    return as_double(rows, "median_income", "avg_income")


@check(
    "Q10_compare_annual",
    BALANCE_SQL
    + """SELECT CAST(year AS INTEGER) AS year, max(mean) FILTER (cma_name = 'NATION_3') AS "NATION_3",
        max(mean) FILTER (cma_name = 'NATION_12') AS "NATION_12"
    FROM balances WHERE segment = 'MACHINERY' AND year BETWEEN 1996 AND 1999
        AND cma_name IN ('NATION_3', 'NATION_12') GROUP BY year""",
)
def compare_annual(spark, folder):
    mart, cities = stored_mart(spark, folder), ["NATION_3", "NATION_12"]
    rows = questions.compare_incomes(
        mart.income, mart, "avg_income", cities, 1996, 1999, income_source="MACHINERY"
    )
    return as_double(rows, *cities)


@check(
    "Q11_rank_annual",
    BALANCE_SQL
    + """, last AS (SELECT cma_name, CAST(max(year) * 100 AS INTEGER) AS date_id, arg_max(most, year) AS value
        FROM balances WHERE segment = 'BUILDING' GROUP BY cma_name)
    SELECT CAST(row_number() OVER (ORDER BY value DESC, cma_name) AS INTEGER) AS position, *
    FROM last ORDER BY 1 LIMIT 7""",
)
def rank_annual(spark, folder):
    mart = stored_mart(spark, folder)
    rows = questions.rank_incomes(mart.income, mart, "median_income", 7, income_source="BUILDING")
    return as_double(rows, "value")


@check(
    "Q12_beside_annual",
    BALANCE_SQL
    + """, yearly AS (
        SELECT cma_name, indicator_id, year, CAST(sum(units) AS BIGINT) AS total, count(*) AS months
        FROM trade_series WHERE month BETWEEN 1 AND 12 GROUP BY ALL)
    SELECT y.indicator_id, y.year, g.geography_id,
        CAST(CAST(round(CAST(y.total AS DOUBLE) / y.months) AS DECIMAL(18,0)) / 10000.0 AS DOUBLE) AS value,
        y.months, b.mean AS avg_income
    FROM yearly y JOIN balances b USING (cma_name, year) JOIN trade_geography g USING (cma_name)
    WHERE b.segment = 'FURNITURE'""",
)
def beside_annual(spark, folder):
    rows = questions.beside_income(stored_mart(spark, folder), income_source="FURNITURE")
    wanted = rows.select("indicator_id", "year", "geography_id", "value", "months", "avg_income")
    return as_double(wanted, "value", "avg_income")


NEAREST_SQL = """, centre AS (
        SELECT label AS query_id, list(mean ORDER BY pos) AS embedding FROM (
            SELECT label, pos, avg(CAST(item AS DOUBLE)) AS mean FROM (
                SELECT label, unnest(embedding) AS item, generate_subscripts(embedding, 1) AS pos FROM embeddings)
            GROUP BY label, pos) GROUP BY label)
    SELECT query_id, position, doc_id, score FROM (
        SELECT query_id, doc_id, score,
            CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS position
        FROM (SELECT c.query_id, e.vec_id AS doc_id,
                round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.embedding), 6) AS score
              FROM embeddings e, centre c)) WHERE position <= 10"""


@check("V1_nearest_documents", NEAREST_SQL)
def nearest_documents(spark, folder):
    return questions.nearest_documents(*documents_and_centres(spark, folder), k=10)


@check("V2_indexed_documents", NEAREST_SQL)
def indexed_documents(spark, folder):
    """The same from an index at rest: first the nearest cells, then all that can reach what they gave."""
    documents, centres = documents_and_centres(spark, folder)
    index = vectors.build(documents, fresh_folder(spark, "index"))
    return vectors.search(index, centres, 10, probes=8, exact=True)


def documents_and_centres(spark, folder):
    rows = table(spark, folder, "embeddings")
    items = rows.select("label", F.posexplode("embedding").alias("at", "item"))
    means = items.groupBy("label", "at").agg(F.avg(F.col("item").cast("double")).alias("mean"))
    centres = means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "mean"))), lambda p: p["mean"]).alias("embedding")
    )
    documents = rows.select(F.col("vec_id").alias("doc_id"), "embedding")
    return documents, centres
