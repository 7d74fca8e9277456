from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from builders import as_tuples, grid, grid_rows
from seriesmart.operators import bitmaps, dims, lookup
from seriesmart.operators.fill import forward_fill
from seriesmart.operators.numbering import number_rows
from seriesmart.operators.reshape import outer_merge, pivot_first, unpivot_by_header, unpivot_positions
from seriesmart.operators.upsert import latest_per_key, matched, replay, upsert, without_matched

FEW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@FEW
@given(
    rows=st.lists(
        st.tuples(st.sampled_from("abc"), st.integers(0, 400), st.one_of(st.none(), st.integers(1, 9))),
        unique_by=lambda r: r[:2],
        min_size=1,
        max_size=60,
    ),
    block=st.integers(1, 50),
)
def test_forward_fill_is_a_fold_in_row_order(spark, rows, block):
    df = spark.createDataFrame(rows, "k STRING, row_idx LONG, v INT")
    got = forward_fill(df, "v", ["k"], "row_idx", "filled", rows_per_block=block)
    carried, want = {}, []
    for key, at, value in sorted(rows):
        carried[key] = value if value is not None else carried.get(key)
        want.append((key, at, carried[key]))
    assert sorted(tuple(r) for r in got.select("k", "row_idx", "filled").collect()) == want


def test_forward_fill_crosses_many_blocks_of_one_hot_sheet(spark):
    df = spark.range(0, 20_000).select(
        F.lit("hot").alias("k"),
        F.col("id").alias("row_idx"),
        F.when(F.col("id") % 5_000 == 7, F.col("id")).alias("v"),
    )
    got = forward_fill(df, "v", ["k"], "row_idx", "filled", rows_per_block=100)
    want = F.when(F.col("row_idx") >= 7, F.floor((F.col("row_idx") - 7) / 5_000) * 5_000 + 7)
    assert got.filter(~F.col("filled").eqNullSafe(want)).count() == 0
    assert got.count() == 20_000


keyed = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3), st.integers(-5, 5)), max_size=25)


@FEW
@given(target=keyed, batch=keyed)
def test_upsert_keeps_one_row_per_key_and_is_idempotent(spark, target, batch):
    first = {row[0]: row for row in target}
    t = spark.createDataFrame([(k, v) for k, _, v in first.values()], "k INT, value INT")
    b = spark.createDataFrame(batch, "k INT, at INT, value INT")
    once = upsert(t, b, ["k"], ["at"])
    want = {k: v for k, _, v in first.values()}
    want.update({k: max((r[1], r[2]) for r in batch if r[0] == k)[1] for k, _, _ in batch})
    assert dict(tuple(r) for r in once.collect()) == want
    assert as_tuples(upsert(once, b, ["k"], ["at"]), "k", "value") == as_tuples(once, "k", "value")


def test_upsert_stamps_new_rows_only(spark):
    old = spark.createDataFrame([(1, 10), (2, 20)], "k INT, value INT").withColumn(
        "loaded_at", F.lit("2000-01-01").cast("timestamp")
    )
    batch = spark.createDataFrame([(2, 21), (3, 30)], "k INT, value INT")
    rows = {r.k: r for r in upsert(old, batch, ["k"]).collect()}
    assert rows[1].loaded_at.year == 2000 and rows[2].loaded_at.year > 2000 and rows[3].value == 30


def test_delete_side_of_an_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k INT, v STRING")
    batch = spark.createDataFrame([(2, "x"), (2, "y"), (None, "z")], "k INT, v STRING")
    assert as_tuples(matched(target, batch, ["k"]), "v") == [("b",)]
    assert as_tuples(without_matched(target, batch, ["k"]), "v") == [("a",), ("c",)]


def test_latest_per_key_takes_the_last_and_breaks_ties_the_same_way(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d")], "k INT, at INT, v STRING")
    assert as_tuples(latest_per_key(df, ["k"], ["at"]), "k", "v") == [(1, "c"), (2, "d")]
    assert latest_per_key(df, ["k"], ["at"]).columns == df.columns


def test_replay_lets_the_later_load_win(spark):
    loads = [spark.createDataFrame([(1, v)], "k INT, v INT") for v in (9, 1)]
    assert as_tuples(latest_per_key(replay(loads), ["k"], ["load_no"]), "k", "v") == [(1, 1)]


def test_pivot_first_takes_the_first_figure_and_drops_empty_groups(spark):
    rows = [
        ("x", "Median", None, 1), ("x", "Median", 5.0, 2), ("x", "Median", 9.0, 3), ("x", "Count", 7.0, 9),
        ("y", "Median", None, 1), (None, "Median", 1.0, 1), ("z", "Other", 3.0, 1), ("w", "Count", 2.0, 4),
    ]
    df = spark.createDataFrame(rows, "k STRING, s STRING, v DOUBLE, at LONG")
    wide = pivot_first(df, ["k"], "s", "v", "at", {"Median": "median", "Count": "n", "Absent": "absent"})
    assert as_tuples(wide, "k", "median", "n", "absent") == [("w", None, 2.0, None), ("x", 5.0, 7.0, None)]


@FEW
@given(rows=st.dictionaries(st.integers(0, 20), st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=10))
def test_pivot_undoes_unpivot(spark, rows):
    grid = spark.createDataFrame([(k, [str(a), str(b)]) for k, (a, b) in rows.items()], "k INT, cells ARRAY<STRING>")
    long = unpivot_positions(grid, {0: "a", 1: "b"}, ["k"], "name", "v").withColumn("at", F.lit(1))
    wide = pivot_first(long, ["k"], "name", "v", "at", {"a": "a", "b": "b"})
    assert {r.k: (int(r.a), int(r.b)) for r in wide.collect()} == rows


def test_outer_merge_keeps_both_sides(spark):
    left = spark.createDataFrame([(1, "l1"), (2, "l2")], "k INT, l STRING")
    right = spark.createDataFrame([(2, "r2"), (3, "r3")], "k INT, r STRING")
    assert as_tuples(outer_merge(left, right, ["k"]), "k", "l", "r") == [
        (1, "l1", None), (2, "l2", "r2"), (3, None, "r3"),
    ]


def test_fan_out_makes_one_row_per_member(spark):
    members = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "region STRING, id INT")
    rows = spark.createDataFrame([(" A ", 10), ("B", 20), ("C", 30)], "GEO STRING, v INT")
    assert as_tuples(lookup.fan_out(rows, members, "GEO"), "id", "v") == [(1, 10), (2, 10), (3, 20)]


def test_missing_ids_drop_or_fail(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "name STRING, v INT")
    ids = spark.createDataFrame([("a", 7)], "name STRING, id INT")
    assert as_tuples(lookup.add_ids(rows, ids, ["name"], "id"), "id", "v") == [(7, 1)]
    with pytest.raises(Exception, match="no id for: b"):
        lookup.add_ids(rows, ids, ["name"], "id", on_missing="fail").collect()


def test_numbers_are_dense_and_stable(spark):
    names = spark.range(0, 5000).select(F.concat(F.lit("n"), "id").alias("name"))
    first = number_rows(names, ["name"], "id")
    assert sorted(r.id for r in first.collect()) == list(range(1, 5001))
    more = spark.range(4000, 6000).select(F.concat(F.lit("n"), "id").alias("name"))
    grown = dims.insert_absent(first, more, ["name"], "id")
    assert sorted(r.id for r in grown.collect()) == list(range(1, 6001))
    assert grown.join(first, ["name", "id"], "left_semi").count() == 5000


def test_insert_into_an_empty_dimension(spark):
    empty = spark.createDataFrame([], "id INT, name STRING, note STRING")
    new = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "x")], "name STRING, note STRING")
    assert sorted(r.id for r in dims.insert_absent(empty, new, ["name"], "id").collect()) == [1, 2]


def test_calendar(spark):
    days = dims.calendar(spark, 2015, 2030)
    assert days.count() == 208
    assert days.filter("is_annual").filter("month = 0 AND quarter IS NULL AND date_id % 100 = 0").count() == 16
    row = days.filter("date_id = 202011").first()
    assert (row.year, row.month, row.quarter, row.is_annual) == (2020, 11, 4, False)


def test_calendar_reaches_every_fact(spark):
    facts = spark.createDataFrame([(198101,), (200600,), (202512,)], "date_id INT")
    days = dims.calendar_for(facts)
    assert facts.join(days, "date_id", "left_anti").count() == 0
    assert dims.calendar_for(facts.filter("date_id < 0")).count() == 0


def test_seed_sizes(spark):
    assert dims.seed_geography(spark).count() == 17
    assert dims.seed_indicators(spark).count() == 35
    assert dims.seed_spellings(spark).count() == 47
    assert dims.seed_members(spark).count() == 16


def test_bitmaps_count_exactly_for_any_coarser_key(spark):
    rows = [("a", 2020, n) for n in (1, 2, 2, 32_768, 32_769, 200_000)] + [("a", 2021, n) for n in (2, 5)] + [("b", 2020, 1), ("b", 2020, None)]
    held = bitmaps.bitmaps(spark.createDataFrame(rows, "k STRING, y INT, n INT"), ["k", "y"], "n")
    assert as_tuples(bitmaps.distinct_counts(held, ["k", "y"]), "k", "y", "n") == [("a", 2020, 5), ("a", 2021, 2), ("b", 2020, 1)]
    assert as_tuples(bitmaps.distinct_counts(held, ["k"]), "k", "n") == [("a", 6), ("b", 1)]
    assert bitmaps.distinct_counts(held, []).first().n == 6
    assert bitmaps.distinct_counts(held.limit(0), ["k"]).count() == 0


def test_a_large_sheet_meets_its_header_in_blocks(spark):
    """Rows of one sheet spread over tasks, and find the header in whatever block they are."""
    rows = grid_rows("m.xlsx", "Renter", 8, [["Geography", "2006", "2011"], *([f"p{at}", str(at), "x"] for at in range(400))])
    rows += grid_rows("m.xlsx", "Owner", 8, [["Geography", "2016"], ["p", "7"]])
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in held.items():
        spark.conf.set(name, value)
    try:
        cells = unpivot_by_header(grid(spark, rows), 8, rows_per_block=10).withColumn("task", F.spark_partition_id())
        found = cells.collect()
    finally:
        for name in held:
            spark.conf.unset(name)
    assert {(r.sheet, r.label, r.year, r.text) for r in found} == {("Owner", "p", 2016, "7")} | {
        ("Renter", f"p{at}", year, text) for at in range(400) for year, text in ((2006, str(at)), (2011, "x"))
    }
    by_task = Counter(r.task for r in found)
    assert len(by_task) > 4 and max(by_task.values()) < len(found) / 2


def test_the_latest_of_one_value_is_found_without_sorting_rows(spark):
    rows = spark.createDataFrame([(1, 2.5), (1, None), (2, None), (None, 1.0), (None, 3.0)], "k INT, v DOUBLE")
    typed = rows.select("k", F.col("v").cast("decimal(12,4)"))
    latest = latest_per_key(typed, ["k"], [])
    assert as_tuples(latest.select("k", F.col("v").cast("double")), "k", "v") == [(1, 2.5), (2, None), (None, 3.0)]
    assert "SortAggregate" not in latest._jdf.queryExecution().executedPlan().toString()
