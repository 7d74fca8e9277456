"""Physical plans: what must stay true of them at any size."""

import pytest

from seriesmart import checks
from seriesmart.checks import aggregates
from seriesmart.plans import questions
from seriesmart.plans.trade import stored_trade_mart, table, trade_facts
from seriesmart.sources import tables

QUERIES = checks.all_queries()
# Queries whose call itself writes and reads files; their plans are only final reads.
LAZY = [name for name in QUERIES if name[0] not in "XL" and name != "Q13_nine_families"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_or_nested_loop_join(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_series_conform_without_a_shuffle_of_their_own(spark, folder):
    text = plan(QUERIES["E1_consumer_prices"](spark, folder))
    assert "Exchange hashpartitioning" not in text


def test_filters_and_columns_reach_the_scan(spark, folder, tmp_path):
    path = str(tmp_path / "fact")
    trade_facts(spark, folder).write.parquet(path)
    facts = spark.read.parquet(path)
    mart = questions.Mart(None, None, None, facts)
    text = plan(questions.only_years(mart, 1997, 1998).monthly.select("date_id"))
    assert "GreaterThanOrEqual(date_id,199700), LessThanOrEqual(date_id,199812)" in text
    assert "ReadSchema: struct<date_id:int>" in text

    tables.write_facts(facts, f"{path}-by-year")
    mart = questions.Mart(None, None, None, spark.read.parquet(f"{path}-by-year"))
    text = plan(questions.only_years(mart, 1997, 1998).monthly.select("value"))
    assert "PartitionFilters: [isnotnull(year" in text and "(year" in text.split("PartitionFilters")[1]


def test_coverage_reads_each_fact_source_once(spark, folder):
    df = aggregates.trade_years(spark, folder)
    scans = [line for line in plan(df).splitlines() if "FileScan" in line and "l_suppkey" in line]
    assert len(scans) == 1 and "l_extendedprice" not in scans[0]


def test_documents_are_read_once_and_never_paired_with_queries_in_rows(spark, folder):
    vectors = table(spark, folder, "embeddings")
    documents, queries = vectors.selectExpr("vec_id as doc_id", "embedding"), vectors.selectExpr("vec_id as query_id", "embedding")
    text = plan(questions.nearest_documents(documents, queries, 3))
    lines = text.splitlines()
    search = next(i for i, line in enumerate(lines) if "MapInArrow" in line)
    assert text.count("FileScan") == 1 and "Join" not in text
    assert not any("Exchange" in line or "Sort" in line for line in lines[search:])  # documents stay where they lie
    assert not any("explode(" in line and "embedding" in line.split("explode(")[1][:40] for line in lines)


def test_a_question_prunes_to_its_years(spark, folder, tmp_path):
    mart = stored_trade_mart(spark, folder, str(tmp_path))
    text = plan(questions.value_of(mart, "Order value - 2-HIGH", "NATION_7", 1998))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "1998" in filters


def test_latest_rows_are_reduced_before_the_shuffle(spark, folder):
    text = plan(QUERIES["W2_latest_per_key"](spark, folder))
    assert "partial_max(struct(row_order" in text and "Window" not in text


def test_large_lookups_are_shuffled_not_broadcast(spark, folder):
    """With broadcasting off no hint may force an unbounded table through one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(QUERIES["J7_star_join"](spark, folder))
        customers = [line for line in text.splitlines() if "c_custkey" in line and "BroadcastExchange" in line]
        assert not customers and "SortMergeJoin [owner" in text
        grid = plan(QUERIES["W1_forward_fill"](spark, folder))
        assert "Join" not in grid
        # The rows are shuffled once; the other two carry one row per block.
        assert grid.count("Exchange hashpartitioning(file") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_are_read_from_the_given_folder(spark, folder):
    assert table(spark, folder, "orders").inputFiles()[0].endswith("/orders.parquet")
