import random

import pytest
from builders import as_tuples
from pyspark.sql import functions as F

from seriesmart import schemas
from seriesmart.operators.blocks import islands, last_known
from seriesmart.plans import availability, questions
from seriesmart.sources import history
from seriesmart.sources.tables import VersionTaken

KEY = schemas.MONTHLY_KEY
LAYOUT = "geography_id INT, date_id INT, indicator_id INT, value STRING"


def facts(spark, rows):
    return spark.createDataFrame(rows, LAYOUT).withColumn("value", F.col("value").cast("decimal(12,4)"))


def snapshot_rows(seed):
    """Random snapshots: {day: {key: value}}; values repeat, keys come and go, some years stay as they are."""
    pick = random.Random(seed)
    keys = [(g, y * 100 + m, 1) for g in range(4) for y in (2019, 2020, 2021) for m in (1, 2)]
    held, out = {k: "1" for k in keys}, {}
    for at in range(7):
        for key in pick.sample(keys, 5 if at % 3 else 0):
            if pick.random() < 0.3:
                held.pop(key, None)
            else:
                held[key] = pick.choice(["1", "2", None])
        out[f"2024-{at + 1:02}-01"] = dict(held)
    return out


def stored(spark, root, snapshots):
    for day, rows in snapshots.items():
        history.add_snapshot(spark, root, day, facts(spark, [(*k, v) for k, v in rows.items()]), KEY)


def test_revisions_and_changes_by_definition(spark, tmp_path):
    snapshots = snapshot_rows(1)
    root, days = str(tmp_path / "h"), list(snapshots)
    stored(spark, root, snapshots)
    assert history.days(spark, root) == days
    wanted = []
    for key in {k for rows in snapshots.values() for k in rows}:
        run = None
        for at, day in enumerate([*days, None]):
            said = (snapshots[day][key],) if day and key in snapshots[day] else None
            if run and said != run[0]:
                wanted.append((*key, run[0][0], run[1], day))
                run = None
            if said and not run:
                run = (said, day)
    for width in (1, 2, 64):
        revised = history.revisions(spark, root, KEY, width)
        got = [(r[0], r[1], r[2], None if r[3] is None else str(int(r[3])), r[4], r[5]) for r in revised.collect()]
        assert sorted(map(str, got)) == sorted(map(str, wanted))
    for day in (days[0], days[3], "2024-04-15"):
        last = max(d for d in days if d <= day)
        known = {(r[0], r[1], r[2]): r[3] for r in history.as_known(revised, day).collect()}
        assert {k: None if v is None else str(int(v)) for k, v in known.items()} == snapshots[last]
    for before, after in ((days[0], days[-1]), (days[2], days[1]), (days[3], days[3])):
        old, new = snapshots[before], snapshots[after]
        expected = {k: "insert" if k not in old else "vanish" if k not in new else "update" for k in old.keys() | new.keys() if (k in old, old.get(k)) != (k in new, new.get(k))}
        found = {(r[0], r[1], r[2]): r.change for r in history.changes(spark, root, before, after, KEY).collect()}
        assert found == expected


def test_an_identical_snapshot_costs_and_reads_nothing(spark, tmp_path):
    root = str(tmp_path / "h")
    rows = [(1, 202001, 1, "1"), (1, 202101, 1, "2"), (2, 202101, 1, "3")]
    assert history.add_snapshot(spark, root, "2024-01-01", facts(spark, rows), KEY) == ["2020", "2021"]
    assert history.add_snapshot(spark, root, "2024-02-01", facts(spark, rows[::-1]).repartition(3), KEY) == []
    assert history.add_snapshot(spark, root, "2024-03-01", facts(spark, rows[:2]), KEY) == ["2021"]
    same = history.changes(spark, root, "2024-01-01", "2024-02-01", KEY)
    assert same.inputFiles() == [] and same.count() == 0
    some = history.changes(spark, root, "2024-02-01", "2024-03-01", KEY)
    assert some.inputFiles() and all("year=2021" in f for f in some.inputFiles())
    assert as_tuples(some, *KEY, "change") == [(2, 202101, 1, "vanish")]
    assert history.snapshot(spark, root, "2024-02-01").count() == 3
    history.add_snapshot(spark, root, "2024-03-01", facts(spark, rows), KEY)  # the same day again
    assert history.days(spark, root) == ["2024-01-01", "2024-02-01", "2024-03-01"]
    assert history.changes(spark, root, "2024-02-01", "2024-03-01", KEY).count() == 0
    with pytest.raises(ValueError, match="columns differ"):
        history.add_snapshot(spark, root, "2024-04-01", facts(spark, rows).withColumn("x", F.lit(1)), KEY)
    with pytest.raises(FileNotFoundError):
        history.days(spark, str(tmp_path / "none"))


def test_two_writers_of_snapshots(spark, tmp_path, monkeypatch):
    root, put = str(tmp_path / "h"), history.commits.put
    rows = facts(spark, [(1, 202001, 1, "1")])

    def beaten(*parts):
        monkeypatch.setattr(history.commits, "put", put)
        history.add_snapshot(spark, root, "2024-01-01", rows, KEY)
        raise VersionTaken

    monkeypatch.setattr(history.commits, "put", beaten)
    history.add_snapshot(spark, root, "2024-02-01", rows, KEY)
    assert history.days(spark, root) == ["2024-01-01", "2024-02-01"]


@pytest.mark.parametrize("width", [1, 3, 1000])
@pytest.mark.parametrize("strict", [False, True])
def test_last_known_by_definition(spark, width, strict):
    pick = random.Random(width)
    rows = [(k, at, pick.choice([None, None, "a", "b"])) for k in ("x", "hot", None) for at in pick.sample(range(60), 30 if k == "hot" else 9)]
    got = last_known(spark.createDataFrame(rows, "k STRING, at INT, v STRING"), {"seen": F.col("v")}, ["k"], ["at"], width, strict)
    for r in got.collect():
        before = [(at, v) for k, at, v in rows if k == r.k and v is not None and (at < r["at"] or at == r["at"] and not strict)]
        assert r.seen == (max(before)[1] if before else None)
    assert got.columns == ["k", "at", "v", "seen"] and got.count() == len(rows)


@pytest.mark.parametrize("width", [1, 4, 500])
def test_islands_by_definition(spark, width):
    rows = [("a", i) for i in (1, 2, 3, 7, 8, 20)] + [("b", 5)] + [("hot", i) for i in range(200) if i % 50]
    got = as_tuples(islands(spark.createDataFrame(rows, "k STRING, i INT"), ["k"], "i", width), "k", "first", "last", "held", "missing_before")
    hot = [("hot", 1, 49, 49, None), ("hot", 51, 99, 49, 1), ("hot", 101, 149, 49, 1), ("hot", 151, 199, 49, 1)]
    assert sorted(map(str, got)) == sorted(map(str, [("a", 1, 3, 3, None), ("a", 7, 8, 2, 3), ("a", 20, 20, 1, 11), ("b", 5, 5, 1, None), *hot]))


def small_mart(spark, rows):
    cities = spark.createDataFrame([(1, "Toronto", "ON", None), (2, "Calgary", "AB", None)], schemas.DIM_GEOGRAPHY)
    names = [(1, "Prices", "S", "x", "c", "monthly"), (2, "Rents", "S", "x", "c", "annual"), (3, "Credit", "S", "x", "c", "quarterly"), (4, "Income", "S", "x", "c", "annual")]
    return questions.Mart(cities, spark.createDataFrame(names, schemas.DIM_INDICATOR), None, facts(spark, rows))


def test_values_of_other_grains_stand_beside(spark):
    months = [(1, y * 100 + m, 1, str(m)) for y in (2019, 2020, 2021) for m in (1, 6, 12)]
    rows = [*months, (2, 202006, 1, "9"), (1, 201810, 2, "10"), (1, 201910, 2, "11"), (1, 202003, 3, "7"), (1, 202000, 4, "50"), (2, 202012, 2, "99")]
    for width in (13, 5, 1000):
        got = questions.side_by_side(small_mart(spark, rows), "Prices", {"Rents": 12, "Credit": 3, "Income": 11}, width=width)
        found = {(r.cma_name, r.date_id): tuple(None if x is None else int(x) for x in r[3:]) for r in got.collect()}
        assert found == {
            ("Toronto", 201901): (10, 201810, None, None, None, None),
            ("Toronto", 201906): (10, 201810, None, None, None, None),
            ("Toronto", 201912): (11, 201910, None, None, None, None),
            ("Toronto", 202001): (11, 201910, None, None, 50, 202000),
            ("Toronto", 202006): (11, 201910, 7, 202003, 50, 202000),
            ("Toronto", 202012): (None, None, None, None, None, None),
            ("Toronto", 202101): (None, None, None, None, None, None),
            ("Toronto", 202106): (None, None, None, None, None, None),
            ("Toronto", 202112): (None, None, None, None, None, None),
            ("Calgary", 202006): (None, None, None, None, None, None),
        }


def test_spans_are_counted_in_the_periods_of_an_indicator(spark):
    rows = [(1, 201911, 1, "1"), (1, 201912, 1, "1"), (1, 202001, 1, "1"), (2, 202004, 1, "1"), (1, 201910, 2, "1"), (1, 202010, 2, "1"), (1, 202310, 2, "1"), (1, 201912, 3, "1"), (1, 202003, 3, "1"), (1, 202009, 3, "1")]
    mart = small_mart(spark, rows)
    got = as_tuples(availability.coverage(mart), "indicator_name", "first", "last", "held", "missing_before")
    assert sorted(map(str, got)) == sorted(map(str, [
        ("Prices", 201911, 202001, 3, None), ("Prices", 202004, 202004, 1, 2), ("Rents", 201900, 202000, 2, None), ("Rents", 202300, 202300, 1, 2),
        ("Credit", 201912, 202003, 2, None), ("Credit", 202009, 202009, 1, 1),
    ]))
    lines = {r.indicator_name: (r.missing, r.line) for r in availability.coverage_report(mart).collect()}
    assert lines["Prices"] == (2, "201911–202001, 202004–202004 (2 missing)")
    cities = {(r.indicator_name, r.cma_name): r.line for r in availability.coverage_report(mart, by_city=True).collect()}
    assert cities["Prices", "Toronto"] == "201911–202001"
