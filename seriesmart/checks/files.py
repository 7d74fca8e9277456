"""Readers, writers and the incremental ingest (S, X).

Text, archives and workbooks are made from the given tables first, then read back.
"""

import io
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from seriesmart import fixed_values as fixed
from seriesmart.checks.base import (
    CHECKS,
    check,
    number,
    order_text,
    published,
    quoted,
    rate_grid,
    regional_raw,
    seeds,
    sql_list,
    staged,
)
from seriesmart.checks.dimensions import UPSERT_SQL, plain
from seriesmart.checks.transforms import SPECS, income_rows, target_and_batch
from seriesmart.functions import numbers, text
from seriesmart.operators import lookup
from seriesmart.operators.reshape import cell
from seriesmart.operators.upsert import as_layout, latest_per_key, union_all
from seriesmart.plans import availability, runs, series
from seriesmart.plans.grids import rate_records
from seriesmart.plans.loads import load
from seriesmart.plans.trade import table, trade_facts, trade_geography, trade_indicators
from seriesmart.schemas import FACT_MONTHLY, MONTHLY_KEY, RATE_RECORD, staging
from seriesmart.sources import archives, delimited, snapshots, tables, workbooks
from seriesmart.sources.scratch import fresh_folder
from seriesmart.sources.tasks import sent_by_value
from seriesmart.streaming.incremental import ingest_new_files

sent_by_value(__name__)

FULL_TEXT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def order_lines(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
    )


ORDER_LINES_SQL = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


def as_orders(rows):
    return rows.select(
        F.col("key").cast("bigint").alias("o_orderkey"),
        F.col("status").alias("o_orderstatus"),
        numbers.safe_double(F.col("price")).alias("o_totalprice"),
    )


@check(
    "S1_csv_scan",
    f"SELECT row_order, trim(GEO) AS place, {number('VALUE')} AS value FROM published",
)
def csv_scan(spark, folder):
    path = fresh_folder(spark, "published")
    published(spark, folder).write.options(**FULL_TEXT).option("header", True).csv(path)
    rows = delimited.read_text_table(spark, path, ["row_order", "GEO", "VALUE"])
    return rows.select(
        F.col("row_order").cast("bigint").alias("row_order"),
        text.trimmed(F.col("GEO")).alias("place"),
        numbers.safe_double(F.col("VALUE")).alias("value"),
    )


@check(
    "S13_quoted_line_ends",
    f"SELECT row_order, replace(trim(GEO), ' ', chr(10)) AS place, {number('VALUE')} AS value FROM published",
)
def quoted_line_ends(spark, folder):
    """Places with line ends in them, in parts that are read by a task each."""
    path = fresh_folder(spark, "quoted")
    rows = published(spark, folder).withColumn("GEO", F.translate(text.trimmed(F.col("GEO")), " ", "\n"))
    rows.write.options(**FULL_TEXT).option("header", True).csv(path)
    read = delimited.read_text_table(spark, path, ["row_order", "GEO", "VALUE"], quoted_line_ends=True)
    return read.select(
        F.col("row_order").cast("bigint").alias("row_order"),
        F.col("GEO").alias("place"),
        numbers.safe_double(F.col("VALUE")).alias("value"),
    )


@check("S2_optional_csv_scan", "SELECT CAST(year AS INTEGER) AS year, month, term, rate FROM rate_records")
def optional_csv_scan(spark, folder):
    path = fresh_folder(spark, "rates")
    delimited.export_csv(rate_records(rate_grid(spark, folder)), path)
    present = delimited.read_records(spark, path, RATE_RECORD)
    absent = delimited.read_records(spark, f"{path}-absent", RATE_RECORD)
    return union_all([present, absent])


def as_workbooks(rows):
    """One small workbook per batch of rows, as (path, content)."""
    kinds = pa.schema([("path", pa.string()), ("content", pa.binary())])
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

    def encode(batches):
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            words = sorted(set(columns[1]))
            lines = ['<row r="1"><c r="A1" t="inlineStr"><is><t>Orders</t></is></c></row>']
            for at, (key, status, price) in enumerate(zip(*columns), start=2):
                lines.append(
                    f'<row r="{at}"><c r="A{at}"><v>{key}</v></c>'
                    f'<c r="C{at}" t="s"><v>{words.index(status)}</v></c><c r="E{at}"><v>{price}</v></c></row>'
                )
            parts = {
                "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets>'
                '<sheet name="Orders" sheetId="1" r:id="rId1"/></sheets></workbook>',
                "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="rId1" '
                'Target="worksheets/sheet1.xml"/></Relationships>',
                "xl/sharedStrings.xml": f'<sst xmlns="{main}">'
                + "".join(f"<si><t>{word}</t></si>" for word in words)
                + "</sst>",
                "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>'
                + "".join(lines)
                + "</sheetData></worksheet>",
            }
            yield _content(kinds, f"orders-{columns[0][0]}.xlsx", parts)

    return rows.mapInArrow(encode, "path STRING, content BINARY")


def as_archives(rows):
    """One archive per batch of rows, the data table after its description."""
    kinds = pa.schema([("path", pa.string()), ("content", pa.binary())])

    def encode(batches):
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            lines = ['"status","price","key"']
            lines += [f'"{status}",{price},"{key}"' for key, status, price in zip(*columns)]
            parts = {"7_MetaData.csv": "a,b\n1,2\n", "7.csv": "﻿" + "\n".join(lines) + "\n"}
            yield _content(kinds, f"orders-{columns[0][0]}.zip", parts)

    return rows.mapInArrow(encode, "path STRING, content BINARY")


def _content(kinds, path, parts):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in parts.items():
            archive.writestr(name, content)
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([held.getvalue()], pa.binary())], schema=kinds)


@check("S3_workbook_grid", ORDER_LINES_SQL)
def workbook_grid(spark, folder):
    grid = workbooks.workbook_grid(as_workbooks(order_lines(spark, folder)), ["Orders"])
    rows = grid.filter(F.col("row_idx") >= 2)
    return as_orders(rows.select(cell(0).alias("key"), cell(2).alias("status"), cell(4).alias("price")))


@check("S4_archive_scan", ORDER_LINES_SQL)
def archive_scan(spark, folder):
    rows = archives.archive_rows(as_archives(order_lines(spark, folder)), ["key", "status", "price"])
    return as_orders(rows)


@check("S5_latest_snapshot", ORDER_LINES_SQL)
def latest_snapshot(spark, folder):
    path = fresh_folder(spark, "snapshots")
    lines = order_lines(spark, folder)
    delimited.export_csv(lines.filter("status = 'F'"), f"{path}/b-first")
    delimited.export_csv(lines, f"{path}/a-second")
    newest = snapshots.one_path(snapshots.latest_by_time(snapshots.list_files(spark, f"{path}/*", "*.csv")))
    return as_orders(delimited.read_text_table(spark, snapshots.folder_of(newest)))


@check("S6_latest_by_name", ORDER_LINES_SQL)
def latest_by_name(spark, folder):
    path = fresh_folder(spark, "editions")
    lines = order_lines(spark, folder)
    delimited.export_csv(lines, f"{path}/rates-02-26-en")
    delimited.export_csv(lines.filter("status = 'F'"), f"{path}/rates-12-25-en")
    files = snapshots.list_files(spark, f"{path}/*", "*.csv")
    newest = snapshots.one_path(snapshots.latest_by_name(files, r"rates-(\d{2})-(\d{2})-en", [2, 1]))
    return as_orders(delimited.read_text_table(spark, snapshots.folder_of(newest)))


@check("S7_yearly_files", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS file_year FROM orders")
def yearly_files(spark, folder):
    path = fresh_folder(spark, "yearly")
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    named = orders.withColumn("survey", F.concat(F.col("year").cast("string"), F.lit("_rent"))).drop("year")
    named.write.partitionBy("survey").option("header", True).csv(path)
    layout = orders.select("o_orderkey").schema
    return delimited.read_yearly(spark, f"{path}/*", layout, r"/survey=(20\d{2}|19\d{2})_", "file_path")


@check("S8_csv_sink", "SELECT geography_id, date_id, indicator_id, units / 10000.0 AS value FROM trade_fact")
def csv_sink(spark, folder):
    path = fresh_folder(spark, "export")
    delimited.export_csv(trade_facts(spark, folder), path)
    return plain(delimited.read_staging(spark, path, staging(FACT_MONTHLY)))


@check(
    "S9_typed_staging",
    """SELECT CAST(row_order AS INTEGER) AS geography_id, CAST(replace(REF_DATE, '-', '') AS INTEGER) AS date_id,
        CAST(CASE WHEN row_order % 5 <> 0 THEN row_order % 7 END AS INTEGER) AS indicator_id,
        CAST(CAST(CASE WHEN row_order % 3 <> 0 THEN (row_order % 9999) || '.23455' END AS DECIMAL(12,4)) AS DOUBLE) AS value
    FROM order_text""",
)
def typed_staging(spark, folder):
    path = fresh_folder(spark, "staging")
    key = F.col("row_order")
    rows = order_text(spark, folder).select(
        key.cast("string").alias("geography_id"),
        F.replace(F.col("REF_DATE"), F.lit("-"), F.lit("")).alias("date_id"),
        F.when(key % 5 == 0, F.lit("   ")).otherwise((key % 7).cast("string")).alias("indicator_id"),
        F.when(key % 3 == 0, F.lit("")).otherwise(
            F.concat((key % 9999).cast("string"), F.lit(".23455"))
        ).alias("value"),
    )
    rows.write.options(**FULL_TEXT).option("header", True).csv(path)
    return plain(delimited.read_staging(spark, path, staging(FACT_MONTHLY)))


@check(
    "S10_dimension_lookup",
    "SELECT c_custkey, geography_id, cma_name FROM customer JOIN trade_geography ON geography_id = c_nationkey + 1",
)
def dimension_lookup(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_nationkey") + 1).cast("int").alias("geography_id")
    )
    places = trade_geography(spark, folder).select("geography_id", "cma_name")
    return lookup.lookup(customers, places, ["geography_id"])


@check(
    "S11_constant_table",
    "SELECT o_orderkey, indicator_id, unit FROM orders JOIN trade_indicator ON indicator_name = 'Order value - ' || o_orderpriority",
)
def constant_table(spark, folder):
    name = F.concat(F.lit("Order value - "), F.col("o_orderpriority")).alias("indicator_name")
    rows = table(spark, folder, "orders").select("o_orderkey", name)
    return lookup.lookup(rows, trade_indicators(spark), ["indicator_name"]).select(
        "o_orderkey", "indicator_id", "unit"
    )


@check("S12_typed_table", "SELECT geography_id, date_id, indicator_id, units / 10000.0 AS value FROM trade_fact")
def typed_table(spark, folder):
    root = fresh_folder(spark, "fact")
    tables.publish(spark, as_layout(trade_facts(spark, folder), FACT_MONTHLY), root)
    return plain(tables.read_published(spark, root))


# Published-style columns under the names that each downloaded table has.
DOWNLOADED = {
    "cpi_cma": {"product": series.CPI.label_column},
    "gasoline_prices": {"fuel": series.GASOLINE.label_column},
    "nhpi": {"house_index": series.HOUSE_PRICES.label_column},
}


def downloaded(spark, folder, root):
    """The published-style tables as files, each in the folder of its number."""
    rows = published(spark, folder)
    frames = {name: rows.withColumnsRenamed(renamed) for name, renamed in DOWNLOADED.items()}
    frames["food_prices"] = regional_raw(rows)
    frames["median_income"] = rows.drop("REF_DATE").withColumnRenamed("REF_YEAR", "REF_DATE").sort("row_order")
    for name, frame in frames.items():
        delimited.export_snapshot(frame, root, fixed.TABLE_NUMBERS[name], "2024-01-02")
    return list(frames)


REFRESHED_SQL = f"""
    SELECT geography_id, date_id, indicator_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY geography_id, date_id, indicator_id
            ORDER BY load_no DESC, value DESC) AS rn
        FROM (SELECT 0 AS load_no, geography_id, date_id, indicator_id, value FROM cpi
            UNION ALL SELECT 1, * FROM ({CHECKS["E2_gasoline_prices"].sql})
            UNION ALL SELECT 2, * FROM ({CHECKS["E3_food_prices"].sql})
            UNION ALL SELECT 3, geography_id, date_id, indicator_id, value FROM nhpi)
        WHERE date_id BETWEEN 199600 AND 199912) WHERE rn = 1"""


@check("X2_refresh_from_files", REFRESHED_SQL)
def refresh_from_files(spark, folder):
    """Files in, a published mart out, opened again; for a span of years."""
    base = fresh_folder(spark, "refresh")
    sources = downloaded(spark, folder, f"{base}/raw")
    runs.refresh(spark, f"{base}/raw", f"{base}/books", f"{base}/mart", sources=sources, years=(1996, 1999))
    return plain(runs.open_mart(spark, f"{base}/mart").monthly)


WHOLE_REFRESHED_SQL = REFRESHED_SQL.replace("\n        WHERE date_id BETWEEN 199600 AND 199912", "")
INCOME_COLUMNS = ["geography_id", "date_id", "income_source", "age_group", "sex", "median_income", "avg_income", "num_persons"]


def refreshed(spark, folder):
    """The mart after a refresh of whole tables."""
    base = fresh_folder(spark, "refresh")
    sources = downloaded(spark, folder, f"{base}/raw")
    runs.refresh(spark, f"{base}/raw", f"{base}/books", f"{base}/mart", sources=sources)
    return runs.open_mart(spark, f"{base}/mart")


@check("X3_refresh_whole_tables", WHOLE_REFRESHED_SQL)
def refresh_whole_tables(spark, folder):
    return plain(refreshed(spark, folder).monthly)


@check("X4_refresh_whole_income", f"SELECT {', '.join(INCOME_COLUMNS)} FROM income")
def refresh_whole_income(spark, folder):
    return refreshed(spark, folder).income.select(*INCOME_COLUMNS)


def _family_sql():
    named = " UNION ALL ".join(
        f"SELECT * FROM ({CHECKS[name].sql})"
        for name in CHECKS
        if name[0] == "E" and name not in ("E5_annual_income", "E7_income_by_tenure")
    )
    rows = []
    for family, title, names, month, grain in fixed.FAMILIES:
        holds = f"indicator_name LIKE {quoted(names)}" if isinstance(names, str) else f"list_contains({sql_list(names)}, indicator_name)"
        if month is not None:
            holds += f" AND date_id % 100 = {month}"
        rows.append(
            f"SELECT {quoted(family)} AS family, {quoted(title)} AS title, {quoted(grain)} AS grain, "
            f"min(date_id // 100) AS low, max(date_id // 100) AS high FROM named WHERE {holds}"
        )
    family, title, grain = map(quoted, fixed.INCOME_FAMILY)
    rows.append(f"SELECT {family}, {title}, {grain}, min(date_id // 100), max(date_id // 100) FROM income")
    return f""", named AS (SELECT indicator_name, date_id FROM ({named}) JOIN dim_indicator USING (indicator_id))
    SELECT family, coalesce(CAST(low AS VARCHAR), '(no data)') AS min_year,
        coalesce(CAST(high AS VARCHAR), '(no data)') AS max_year,
        title || ': ' || coalesce(CAST(low AS VARCHAR), '(no data)') || '–'
            || coalesce(CAST(high AS VARCHAR), '(no data)') || ' ' || grain AS line
    FROM ({" UNION ALL ".join(rows)})"""


def source_facts(spark, folder):
    """Source name to its facts, by the transforms of all sources; the published table that five of them read is made once."""
    rows, dims = staged(published(spark, folder), "published"), seeds(spark)
    return {
        "cpi_cma": series.city_series(rows, dims, SPECS["cpi"]),
        "gasoline_prices": series.city_series(rows, dims, SPECS["gasoline"]),
        "food_prices": series.regional_series(regional_raw(rows), dims, series.FOOD),
        "nhpi": series.city_series(rows, dims, SPECS["nhpi"]),
        "median_income": series.income_facts(income_rows(rows), dims, "row_order"),
        "rental_survey": CHECKS["E6_rental_survey"].run(spark, folder),
        "mortgage_rates": CHECKS["E8_mortgage_rates"].run(spark, folder),
        "credit_trends": CHECKS["E9_credit_trends"].run(spark, folder),
    }


def loaded_mart(spark, folder, *spans):
    """A mart with the transforms of all sources, loaded once for each span of dates.

    Each source is transformed once; several loads read its facts as written.
    """
    root = fresh_folder(spark, "mart")
    runs.stored_dims(spark, root)
    sources = source_facts(spark, folder)
    if len(spans) > 1:
        sources = {source: staged(facts, source) for source, facts in sources.items()}
    for span in spans:
        load(spark, root, [(source, facts.filter(span)) for source, facts in sources.items()])
    return runs.open_mart(spark, root)


@check("Q13_nine_families", _family_sql())
def nine_families(spark, folder):
    """The report over a mart that was loaded from the transforms of all sources."""
    return availability.mart_report(loaded_mart(spark, folder, "true"))


@check("Q15_families_after_upserts", _family_sql())
def families_after_upserts(spark, folder):
    """The same after a load of some years, which a second one replaces and adds to."""
    return availability.mart_report(loaded_mart(spark, folder, "date_id div 100 % 2 = 0", "date_id > 0"))


@check("X1_incremental_ingest", UPSERT_SQL)
def incremental_ingest(spark, folder):
    base = fresh_folder(spark, "ingest")
    target, batch = target_and_batch(spark, folder)
    drops = [target, latest_per_key(batch, MONTHLY_KEY, ["row_order"]).drop("row_order")]
    for drop in drops:
        rows = as_layout(drop, staging(FACT_MONTHLY))
        rows.write.mode("append").option("header", True).csv(f"{base}/drop")
        ingest_new_files(
            spark, f"{base}/drop", staging(FACT_MONTHLY), f"{base}/fact", MONTHLY_KEY, f"{base}/progress"
        )
    return plain(tables.read_published(spark, f"{base}/fact"))
