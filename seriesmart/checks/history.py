"""Queries on series in blocks: revisions and changes of snapshots, values side by side, spans held."""

from pyspark.sql import functions as F

from seriesmart.checks.base import check, quoted
from seriesmart.plans import availability, questions
from seriesmart.plans.trade import trade_facts, trade_mart
from seriesmart.schemas import MONTHLY_KEY
from seriesmart.sources import history
from seriesmart.sources.scratch import fresh_folder

# The days of the snapshots, and which stage of the figures each of them has.
DAYS = [("2024-01-05", 0), ("2024-02-05", 1), ("2024-03-05", 1), ("2024-04-05", 2), ("2024-05-05", 0)]
IN_SNAPSHOT = "(date_id div 100 % 2 = 1 OR (geography_id + date_id % 100 + {k}) % 13 <> 0)"
REVISED = "(date_id div 100 % 2 = 0 AND (geography_id * 7 + date_id % 100 + indicator_id) % 5 < {k})"

SNAPSHOTS_SQL = f""", days(day, pos, k) AS (VALUES {", ".join(f"({quoted(day)}, {at}, {k})" for at, (day, k) in enumerate(DAYS))}),
    snaps AS (SELECT day, pos, geography_id, date_id, indicator_id,
        (units + CASE WHEN {REVISED.replace("div", "//").format(k="k")} THEN 10000 * k ELSE 0 END) / 10000.0 AS value
        FROM trade_fact, days WHERE {IN_SNAPSHOT.replace("div", "//").format(k="k")}),
    runs AS (SELECT geography_id, date_id, indicator_id, value, min(pos) AS low, max(pos) AS high FROM (
            SELECT *, pos - row_number() OVER (PARTITION BY geography_id, date_id, indicator_id, value ORDER BY pos) AS run FROM snaps)
        GROUP BY geography_id, date_id, indicator_id, value, run)
"""


def snapshots(spark, folder):
    """A history of the trade facts: in even years figures are revised, dropped and put back."""
    root = fresh_folder(spark, "history")
    facts = trade_facts(spark, folder).select(*MONTHLY_KEY, "value")
    for day, k in DAYS:
        value = F.expr(f"cast(value + if({REVISED.format(k=k)}, {k}, 0) as decimal(12,4)) as value")
        history.add_snapshot(spark, root, day, facts.filter(IN_SNAPSHOT.format(k=k)).select(*MONTHLY_KEY, value), MONTHLY_KEY)
    return root


def doubles(rows, *names):
    return rows.withColumns({name: F.col(name).cast("double") for name in names})


@check(
    "X5_snapshot_changes",
    SNAPSHOTS_SQL
    + f"""SELECT geography_id, date_id, indicator_id,
        CASE WHEN b.value IS NULL THEN 'insert' WHEN a.value IS NULL THEN 'vanish' ELSE 'update' END AS change,
        b.value AS value_before, a.value AS value_after
    FROM (SELECT * FROM snaps WHERE day = {quoted(DAYS[1][0])}) b
    FULL OUTER JOIN (SELECT * FROM snaps WHERE day = {quoted(DAYS[3][0])}) a USING (geography_id, date_id, indicator_id)
    WHERE b.value IS DISTINCT FROM a.value""",
)
def snapshot_changes(spark, folder):
    rows = history.changes(spark, snapshots(spark, folder), DAYS[1][0], DAYS[3][0], MONTHLY_KEY)
    return doubles(rows, "value_before", "value_after")


@check(
    "X6_revisions",
    SNAPSHOTS_SQL
    + """SELECT geography_id, date_id, indicator_id, value, f.day AS known_from, t.day AS known_to
    FROM runs JOIN days f ON f.pos = low LEFT JOIN days t ON t.pos = high + 1""",
)
def revisions(spark, folder):
    return doubles(history.revisions(spark, snapshots(spark, folder), MONTHLY_KEY), "value")


@check(
    "X7_as_known",
    SNAPSHOTS_SQL + f"SELECT geography_id, date_id, indicator_id, value FROM snaps WHERE day = {quoted(DAYS[3][0])}",
)
def as_known(spark, folder):
    revised = history.revisions(spark, snapshots(spark, folder), MONTHLY_KEY)
    return doubles(history.as_known(revised, "2024-04-20"), "value")


LEFT, OTHERS = "Order value - 2-HIGH", {"Ship price - A": 2, "Order value - 5-LOW": 6}


def _other_sql(at: int, name: str, months: int) -> str:
    age = "(l.date_id // 100 * 12 + l.date_id % 100) - (d // 100 * 12 + d % 100)"
    return f"""o{at} AS (SELECT l.cma_name, l.date_id, CASE WHEN {age} <= {months} THEN v END AS value,
            CASE WHEN {age} <= {months} THEN d END AS other_date
        FROM (SELECT l.cma_name, l.date_id, max(r.date_id) AS d, arg_max(r.value, r.date_id) AS v
            FROM trade_series l LEFT JOIN trade_series r ON r.indicator_name = {quoted(name)} AND r.cma_name = l.cma_name
                AND r.date_id <= l.date_id
            WHERE l.indicator_name = {quoted(LEFT)} GROUP BY l.cma_name, l.date_id) l)"""


@check(
    "J14_side_by_side",
    ", "
    + ", ".join(_other_sql(at, name, months) for at, (name, months) in enumerate(OTHERS.items()))
    + " SELECT l.cma_name, l.date_id, l.value, "
    + ", ".join(f'o{at}.value AS "{name}", o{at}.other_date AS "{name} date"' for at, name in enumerate(OTHERS))
    + " FROM trade_series l "
    + " ".join(f"JOIN o{at} ON o{at}.cma_name = l.cma_name AND o{at}.date_id = l.date_id" for at in range(len(OTHERS)))
    + f" WHERE l.indicator_name = {quoted(LEFT)}",
)
def side_by_side(spark, folder):
    rows = questions.side_by_side(trade_mart(spark, folder), LEFT, OTHERS)
    return doubles(rows, "value", *OTHERS)


ISLANDS_SQL = """, held AS (
        SELECT DISTINCT indicator_name, source, cma_name, frequency, CASE frequency WHEN 'quarterly'
            THEN date_id // 100 * 4 + (date_id % 100 + 2) // 3 - 1 ELSE date_id // 100 * 12 + date_id % 100 - 1 END AS i
        FROM trade_series),
    marked AS (SELECT *, i - row_number() OVER w AS run, i - lag(i) OVER w - 1 AS gap FROM held
        WINDOW w AS (PARTITION BY indicator_name, source, cma_name ORDER BY i)),
    spans AS (SELECT indicator_name, source, cma_name, frequency, min(i) AS low, max(i) AS high, count(*) AS held,
        arg_min(gap, i) FILTER (gap IS NULL OR gap > 0) AS missing_before FROM marked
        GROUP BY indicator_name, source, cma_name, frequency, run),
    dated AS (SELECT *, CAST(CASE frequency WHEN 'quarterly' THEN low // 4 * 100 + (low % 4 + 1) * 3
            ELSE low // 12 * 100 + low % 12 + 1 END AS INTEGER) AS "first",
        CAST(CASE frequency WHEN 'quarterly' THEN high // 4 * 100 + (high % 4 + 1) * 3
            ELSE high // 12 * 100 + high % 12 + 1 END AS INTEGER) AS "last" FROM spans)
"""


@check(
    "A7_spans_held",
    ISLANDS_SQL + 'SELECT indicator_name, source, cma_name, "first", "last", held, CAST(missing_before AS INTEGER) AS missing_before FROM dated',
)
def spans_held(spark, folder):
    rows = availability.coverage(trade_mart(spark, folder), by_city=True)
    return rows.withColumn("missing_before", F.col("missing_before").cast("int"))


@check(
    "Q14_coverage_report",
    ISLANDS_SQL
    + """SELECT indicator_name, source, cma_name, CAST(coalesce(sum(missing_before), 0) AS BIGINT) AS missing,
        string_agg("first" || '–' || "last", ', ' ORDER BY "first")
            || CASE WHEN sum(missing_before) > 0 THEN ' (' || CAST(CAST(sum(missing_before) AS BIGINT) AS VARCHAR) || ' missing)' ELSE '' END AS line
    FROM dated GROUP BY indicator_name, source, cma_name""",
)
def coverage_report(spark, folder):
    return availability.coverage_report(trade_mart(spark, folder), by_city=True)
