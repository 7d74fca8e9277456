"""The Z-order layout: its codes, what filters skip, and its commits."""

import pytest
from pyspark.sql import functions as F

from builders import as_tuples
from seriesmart import schemas
from seriesmart.operators.clustering import interleaved, rank_codes, with_z_order
from seriesmart.sources import tables
from seriesmart.sources.scratch import Scratch
from test_sources import facts


def test_bits_are_taken_in_turn(spark):
    rows = [(a, b, c) for a in (0, 1, 5, 7) for b in (0, 3, 6) for c in (0, 2, 7)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    for a, b, c, z in df.withColumn("z", interleaved([F.col("a"), F.col("b"), F.col("c")], bits=3)).collect():
        text = "".join(x for bits in zip(*(f"{v:03b}" for v in (a, b, c))) for x in bits)
        assert z == int(text, 2)


def test_codes_follow_the_rows_of_values(spark):
    df = spark.createDataFrame([(1, v) for v in [5] * 6 + [7, 8, 9]] + [(2, None), (2, 4)], "year int, v int")
    got = {(r["year"], r["v"]): r["code"] for r in rank_codes(df, "v", "year", "code", bits=4).collect()}
    assert got == {(1, 5): 0, (1, 7): 16 * 6 // 9, (1, 8): 16 * 7 // 9, (1, 9): 16 * 8 // 9, (2, None): 0, (2, 4): 8}


def test_order_keeps_all_rows_nulls_and_ties(spark):
    rows = [(2020, None, 1), (2020, None, 1), (2020, 3, None), (None, 3, 2), (2021, 3, 2)]
    df = spark.createDataFrame(rows, "year int, a int, b int")
    got = with_z_order(df, ["a", "b"], "year")
    assert got.columns == ["year", "a", "b", "_z"]
    assert sorted(map(str, (tuple(r)[:3] for r in got.collect()))) == sorted(map(str, rows))
    assert with_z_order(df.limit(0), ["a"], "year").count() == 0
    with pytest.raises(ValueError, match="clustered"):
        with_z_order(df, list("abcdefg"), "year")


def rows_read(df):
    """The rows that the scan gives to the filter above it, after files, row groups and pages are skipped."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_filters_on_each_column_skip_most_rows(spark, tmp_path):
    # One city has a third of all rows.
    city = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(200))).cast("int")
    df = spark.range(400_000).select(
        city.alias("geography_id"),
        (202001 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(12))).cast("int").alias("date_id"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(100)).cast("int").alias("indicator_id"),
        F.rand(3).alias("value"),
    )
    by_date, clustered = str(tmp_path / "date"), str(tmp_path / "z")
    tables.write_facts(df, by_date)
    tables.write_clustered(df, clustered, row_group_bytes=32 << 10)
    for question in ("geography_id = 90", "indicator_id = 40", "date_id = 202005"):
        before = rows_read(spark.read.parquet(by_date).filter(question))
        after = rows_read(spark.read.parquet(clustered).filter(question))
        print(question, before, after)
        assert after < 400_000 / 2 and (after < before / 2 or "date" in question)
    assert spark.read.parquet(clustered).count() == 400_000


def monthly(years, value):
    return [(g, y * 100 + m, i, value) for y in years for g in range(4) for m in range(1, 13) for i in range(3)]


def folders(spark, root):
    return tables.held_tables(spark, root)[tables.ALONE]["folders"]


def test_only_years_that_changed_are_clustered_again(spark, tmp_path):
    root = str(tmp_path / "fact")
    tables.publish(spark, facts(spark, monthly([2020, 2021], 1.0)), root)
    assert tables.cluster_published(spark, root) == 2
    first = folders(spark, root)
    assert tables.cluster_published(spark, root) == 2  # nothing to do
    tables.upsert_published(spark, root, facts(spark, monthly([2021], 2.0)), schemas.MONTHLY_KEY)
    assert tables.unclustered_years(tables.held_tables(spark, root)[tables.ALONE]) == {"2021"}
    assert tables.cluster_published(spark, root) == 4
    assert folders(spark, root)["2020"] == first["2020"] != folders(spark, root)["2021"]
    got = tables.read_published(spark, root).select("geography_id", "date_id", "indicator_id", "value")
    want = facts(spark, monthly([2020], 1.0) + monthly([2021], 2.0)).select(*got.columns)
    assert as_tuples(got) == as_tuples(want)


def test_a_load_during_the_clustering_is_kept(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "fact")
    tables.publish(spark, facts(spark, monthly([2020, 2021], 1.0)), root)
    write = tables.write_clustered

    def late(*args):
        monkeypatch.setattr(tables, "write_clustered", write)
        tables.upsert_published(spark, root, facts(spark, monthly([2020], 5.0)), schemas.MONTHLY_KEY)
        write(*args)

    monkeypatch.setattr(tables, "write_clustered", late)
    tables.cluster_published(spark, root)
    got = tables.read_published(spark, root)
    assert got.filter("year = 2020 AND value = 5").count() == got.filter("year = 2020").count() == 144
    assert tables.unclustered_years(tables.held_tables(spark, root)[tables.ALONE]) == set()


def test_tables_without_years_are_not_clustered(spark, tmp_path):
    root = str(tmp_path / "dim")
    tables.publish(spark, spark.range(3), root, partition_by=[])
    with pytest.raises(ValueError, match="partitioned by year"):
        tables.cluster_published(spark, root)


def test_a_table_is_clustered_by_the_columns_it_has(spark, tmp_path):
    root = str(tmp_path / "income")
    rows = facts(spark, monthly([2020], 1.0)).groupBy("geography_id", "date_id").agg(F.sum("value").alias("avg_income"))
    tables.publish(spark, rows, root)
    tables.cluster_published(spark, root)
    assert "batch=by-geography_id-date_id-" in folders(spark, root)["2020"]
    assert tables.cluster_published(spark, root, by=["date_id"]) == 3
    assert tables.read_published(spark, root).count() == 48


def test_summaries_of_a_clustered_table_are_renewed_with_it(spark, tmp_path):
    mart = str(tmp_path / "mart")
    summary = tables.Summary("dates", "fact", lambda rows: rows.groupBy("date_id").agg(F.count("*").alias("n")))
    first = tables.upsert_edit(Scratch(spark, "x", str(tmp_path)), "fact", facts(spark, monthly([2020, 2021], 1.0)), schemas.MONTHLY_KEY)
    tables.commit(spark, mart, [first], [summary])
    tables.cluster_published(spark, f"{mart}/fact", derived=[summary])
    held = tables.held_tables(spark, mart)
    assert held["dates"]["made_from"] == held["fact"]["folders"] and not tables.unclustered_years(held["fact"])
    got = tables.read_published(spark, f"{mart}/dates")
    assert got.count() == 24 and got.agg(F.sum("n")).first()[0] == 288
