import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from builders import archive_bytes, as_tuples, workbook_bytes
from seriesmart import schemas
from seriesmart.plans import grids
from seriesmart.sources import archives, delimited, snapshots, tables, workbooks
from seriesmart.sources import commits
from seriesmart.sources.scratch import Scratch, fresh_folder
from seriesmart.streaming.incremental import ingest_new_files

FACT = schemas.staging(schemas.FACT_MONTHLY)


def test_text_table_with_byte_order_mark_and_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('﻿"REF_DATE","GEO, place",VALUE\n2020-01,"a ""b"", c",1.0\n2020-02,x,\n')
    df = delimited.read_text_table(spark, str(tmp_path), ["REF_DATE", "GEO, place", "VALUE"])
    assert {t for _, t in df.dtypes} == {"string"}
    assert as_tuples(df, *(f"`{c}`" for c in df.columns)) == [
        ("2020-01", 'a "b", c', "1.0"), ("2020-02", "x", None),
    ]


def test_absent_records_are_no_rows(spark, tmp_path):
    df = delimited.read_records(spark, str(tmp_path / "none"), schemas.RATE_RECORD)
    assert df.count() == 0 and df.schema == schemas.RATE_RECORD


def test_staging_blanks_and_types(spark, tmp_path):
    (tmp_path / "f.csv").write_text("geography_id,date_id,indicator_id,value\n1,202001,  ,1.23455\n2,202002,5,\n")
    df = delimited.read_staging(spark, str(tmp_path), FACT)
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in FACT.fields]
    rows = [tuple(None if v is None else str(v) for v in r) for r in df.orderBy("geography_id").collect()]
    assert rows == [("1", "202001", None, "1.2346"), ("2", "202002", "5", None)]


def test_yearly_files(spark, tmp_path):
    for name, year in (("2019_rent.csv", 1), ("2020_rent.csv", 2)):
        (tmp_path / name).write_text(f"year,month,term,rate\n{year},1,a,2.0\n")
    df = delimited.read_yearly(spark, str(tmp_path), schemas.RATE_RECORD)
    assert as_tuples(df, "year", "file_year") == [(1, 2019), (2, 2020)]


def test_archive_takes_the_data_table(spark, tmp_path):
    parts = {"9_MetaData.csv": "x\n", "notes.txt": "x", "9.csv": '﻿"GEO",VALUE,extra\n"a, b",1,z\n\nc,,z\n', "later.csv": "GEO,VALUE\nno,9\n"}
    (tmp_path / "9.zip").write_bytes(archive_bytes(parts))
    df = archives.read_archives(spark, str(tmp_path), ["VALUE", "GEO"])
    assert as_tuples(df, "GEO", "VALUE") == [("a, b", "1"), ("c", None)]


QUOTED = 'k,GEO,v\n1,"Tor\nonto",1.5\n2,"say ""x""",\n3,Calgary,2.5\n'


def read_both_ways(spark, path, text, name="t"):
    """(plain, plain with quoted line ends, zipped, zipped and spread) rows of one text."""
    path.mkdir()
    (path / f"{name}.csv").write_bytes(b"\xef\xbb\xbf" + text.encode())
    (path / "z").mkdir()
    (path / "z" / f"{name}.zip").write_bytes(archive_bytes({f"{name}.csv": "\ufeff" + text}))
    columns = ["v", "k", "GEO"]

    def tried(df):
        try:
            return as_tuples(df, *columns)
        except Exception as problem:  # noqa: BLE001 - compared below
            return type(problem).__name__

    return [
        tried(delimited.read_text_table(spark, str(path / f"{name}.csv"), columns)),
        tried(delimited.read_text_table(spark, str(path / f"{name}.csv"), columns, quoted_line_ends=True)),
        tried(archives.read_archives(spark, str(path / "z"), columns)),
        tried(archives.read_archives(spark, str(path / "z"), columns, spread=True)),
    ]


def test_plain_and_zipped_text_give_the_same_rows_or_fail(spark, tmp_path):
    rows = [("1.5", "1", "Tor\nonto"), ("2.5", "3", "Calgary"), (None, "2", 'say "x"')]
    plain, whole, zipped, spread = read_both_ways(spark, tmp_path / "quoted", QUOTED)
    assert isinstance(plain, str)  # a record cut at a line end in quotes fails
    assert sorted(whole, key=str) == sorted(zipped, key=str) == sorted(spread, key=str) == sorted(rows, key=str)
    good = "k,GEO,v\n1,A,1\n\n2,,\n"
    same = [("1", "1", "A"), (None, "2", None)]
    assert all(sorted(found, key=str) == sorted(same, key=str) for found in read_both_ways(spark, tmp_path / "good", good))
    for name, text in (("short", "k,GEO,v\n1,A\n"), ("long", "k,GEO,v\n1,A,1,1\n"), ("open", 'k,GEO,v\n1,"A,1\n2,B,2\n')):
        found = read_both_ways(spark, tmp_path / name, text)
        assert all(isinstance(rows, str) for rows in (found if name != "open" else [found[0], *found[2:]])), (name, found)


def test_parts_with_another_header_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("GEO,REF_DATE,VALUE\nToronto,2020-01,1.5\n")
    (tmp_path / "b.csv").write_text("VALUE,GEO,REF_DATE\n1.5,Toronto,2020-01\n")
    with pytest.raises(Exception, match="header"):
        delimited.read_text_table(spark, str(tmp_path), ["GEO", "REF_DATE", "VALUE"]).collect()


def test_long_archives_are_parsed_in_pieces(spark, tmp_path, monkeypatch):
    text = "k,v\n" + "".join(f'{i},"a\n{"b" * (i % 50)}""{i}"\n' for i in range(3000))
    (tmp_path / "big.zip").write_bytes(archive_bytes({"big.csv": text}))
    monkeypatch.setattr(archives, "CHUNK_BYTES", 700)
    rows = archives.read_archives(spark, str(tmp_path), ["k", "v"], spread=True)
    got = [(r.k, r.v) for r in rows.orderBy("row_order").collect()]
    assert got == [(str(i), f'a\n{"b" * (i % 50)}"{i}') for i in range(3000)]
    assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_sheets_of_one_workbook_are_decoded_by_several_tasks(spark, tmp_path):
    sheets = {f"S{n}": {at: [f"{n}-{at}", at] for at in range(1, 40)} for n in range(12)}
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(sheets))
    grid = workbooks.read_workbooks(spark, str(tmp_path))
    assert grid.count() == 12 * 39 and grid.select(F.spark_partition_id()).distinct().count() > 1
    assert grid.select("sheet", F.spark_partition_id().alias("p")).distinct().groupBy("sheet").count().filter("count > 1").count() == 0
    one = workbooks.read_workbooks(spark, str(tmp_path), sheets=["S7"]).orderBy("row_idx").collect()
    assert [r.cells for r in one] == [[f"7-{at}", str(at)] for at in range(1, 40)]


def test_archive_without_a_table_fails(spark, tmp_path):
    (tmp_path / "9.zip").write_bytes(archive_bytes({"9_MetaData.csv": "x\n"}))
    with pytest.raises(Exception, match="no data table"):
        archives.read_archives(spark, str(tmp_path), ["VALUE"]).collect()


def test_long_archive_arrives_whole_and_in_order(spark, tmp_path):
    lines = "k,v\n" + "".join(f"{i},{i * 2}\n" for i in range(30_000))
    (tmp_path / "big.zip").write_bytes(archive_bytes({"big.csv": lines}))
    df = archives.read_archives(spark, str(tmp_path), ["k", "v"]).withColumn("n", F.monotonically_increasing_id())
    total = df.agg(F.count("*"), F.sum(F.col("v").cast("long"))).first()
    assert tuple(total) == (30_000, 30_000 * 29_999)
    assert df.filter(F.col("k").cast("long") != F.col("n")).count() == 0


def test_workbook_grid(spark, tmp_path):
    book = {
        "First & last": {1: ["title", None, 3], 4: [None, 2021, "x", 1.5]},
        "Other": {2: ["only"], 5000: ["far"]},
    }
    (tmp_path / "book.xlsx").write_bytes(workbook_bytes(book))
    (tmp_path / "skip-me.xlsx").write_bytes(workbook_bytes({"S": {1: ["no"]}}))
    grid = workbooks.read_workbooks(spark, str(tmp_path), skip_names=[r"/skip-"])
    assert grid.schema == schemas.CELL_GRID
    rows = [(r.file, r.sheet_idx, r.sheet, r.row_idx, r.cells) for r in grid.orderBy("sheet_idx", "row_idx").collect()]
    assert rows == [
        ("book.xlsx", 0, "First & last", 1, ["title", None, "3"]),
        ("book.xlsx", 0, "First & last", 4, [None, "2021", "x", "1.5"]),
        ("book.xlsx", 1, "Other", 2, ["only"]),
        ("book.xlsx", 1, "Other", 5000, ["far"]),
    ]
    with pytest.raises(ValueError, match="expected sheets not found"):
        workbooks.require_sheets(grid, ["Other", "Third"])


def test_latest_by_time_and_by_name(spark, tmp_path):
    for at, name in enumerate(["rates-02-26-en.xlsx", "rates-12-25-en.xlsx", "other.xlsx"]):
        path = tmp_path / name
        path.write_bytes(b"x")
        os.utime(path, (1_600_000_000 + at, 1_600_000_000 + at))
    files = snapshots.list_files(spark, str(tmp_path), "*.xlsx")
    assert snapshots.one_path(snapshots.latest_by_time(files)).endswith("other.xlsx")
    by_name = snapshots.latest_by_name(files, r"rates-(\d{2})-(\d{2})", [2, 1])
    assert snapshots.one_path(by_name).endswith("rates-02-26-en.xlsx")
    with pytest.raises(FileNotFoundError):
        snapshots.one_path(snapshots.latest_by_name(files, r"credit-(\d+)", [1]))


def facts(spark, rows):
    return spark.createDataFrame(rows, "geography_id INT, date_id INT, indicator_id INT, value DOUBLE").withColumn(
        "value", F.col("value").cast("decimal(12,4)")
    )


def test_published_versions(spark, tmp_path):
    root = str(tmp_path / "mart")
    with pytest.raises(FileNotFoundError):
        tables.read_published(spark, root)
    first = facts(spark, [(1, 202001, 1, 1.0), (1, 202101, 1, 2.0)])
    assert tables.upsert_published(spark, root, first, schemas.MONTHLY_KEY) == 1
    before = tables.read_published(spark, root)
    again = facts(spark, [(1, 202101, 1, 3.0), (2, 202201, 1, 4.0)])
    assert tables.upsert_published(spark, root, again, schemas.MONTHLY_KEY) == 2
    assert [float(r.value) for r in before.orderBy("date_id").collect()] == [1.0, 2.0]  # old readers undisturbed
    now = tables.read_published(spark, root)
    assert [(r.date_id, float(r.value)) for r in now.orderBy("date_id").collect()] == [
        (202001, 1.0), (202101, 3.0), (202201, 4.0),
    ]
    assert now.filter("loaded_at IS NULL").count() == 0


def test_unpublished_leftovers_are_not_read(spark, tmp_path):
    root = str(tmp_path / "mart")
    tables.publish(spark, facts(spark, [(1, 202001, 1, 1.0)]), root)
    tables._write_years(facts(spark, [(9, 202001, 9, 9.0)]), root)  # a run that died before its manifest
    assert [r.geography_id for r in tables.read_published(spark, root).collect()] == [1]
    tables.publish(spark, facts(spark, [(2, 202001, 1, 1.0)]), root)
    assert [r.geography_id for r in tables.read_published(spark, root).collect()] == [2]


def files_below(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_an_upsert_rewrites_only_the_years_it_touches(spark, tmp_path):
    root = str(tmp_path / "fact")
    start = facts(spark, [(1, 202001, 1, 1.0), (1, 202101, 1, 2.0), (2, 202101, 1, 2.5)])
    tables.upsert_published(spark, root, start, schemas.MONTHLY_KEY)
    first = files_below(root)
    batch = facts(spark, [(1, 202101, 1, 9.0), (1, 202205, 1, 3.0)])
    tables.upsert_published(spark, root, batch, schemas.MONTHLY_KEY)
    rows = tables.read_published(spark, root).orderBy("date_id", "geography_id").collect()
    assert [(r.geography_id, r.date_id, float(r.value)) for r in rows] == [
        (1, 202001, 1.0), (1, 202101, 9.0), (2, 202101, 2.5), (1, 202205, 3.0),
    ]
    fresh = files_below(root) - first
    assert fresh and all("year=2021" in f or "year=2022" in f for f in fresh)
    tables.upsert_published(spark, root, facts(spark, [(1, 202205, 1, 4.0)]), schemas.MONTHLY_KEY)
    held = files_below(root)
    assert not any(f in held for f in first if "year=2021" in f)  # two versions back, and not named any more
    assert any(f in held for f in first if "year=2020" in f)
    assert tables.versions(spark, root) == [2, 3]


def overtaken_by(monkeypatch, rival):
    """Lets another writer finish while this one writes its rows for the first time."""
    own = tables._write_years

    def late(df, where):
        monkeypatch.setattr(tables, "_write_years", own)
        rival()
        return own(df, where)

    monkeypatch.setattr(tables, "_write_years", late)


@pytest.mark.parametrize("theirs", [202001, 202101, 202202])
def test_of_two_writers_none_loses_rows(spark, tmp_path, monkeypatch, theirs):
    root = str(tmp_path / "fact")
    key = schemas.MONTHLY_KEY
    tables.upsert_published(spark, root, facts(spark, [(1, 202001, 1, 1.0), (1, 202101, 1, 1.0)]), key)
    overtaken_by(monkeypatch, lambda: tables.upsert_published(spark, root, facts(spark, [(2, theirs, 1, 2.0)]), key))
    before = files_below(root)
    tables.upsert_published(spark, root, facts(spark, [(3, 202001, 1, 3.0), (1, 202001, 1, 9.0)]), key)
    rows = {(r.geography_id, r.date_id): float(r.value) for r in tables.read_published(spark, root).collect()}
    assert rows == {(1, 202001): 9.0, (1, 202101): 1.0, (2, theirs): 2.0, (3, 202001): 3.0}
    # Years that the other one left alone are written once; its own years are merged again.
    written = [f for f in files_below(root) - before if "year=2020" in f]
    assert len({f.split("batch=")[1][:32] for f in written}) == (2 if theirs == 202001 else 1) + (theirs == 202001)
    assert tables.versions(spark, root) == [2, 3]


def test_many_writers_at_once(spark, tmp_path):
    root = str(tmp_path / "fact")
    problems = []

    def write(at):
        try:
            own = spark.newSession()
            rows = [(at, 202001 + 100 * (at % 2), 1, 1.0), (100 + at, 202301, 1, 2.0)]
            tables.upsert_published(own, root, facts(own, rows), schemas.MONTHLY_KEY)
        except Exception as problem:  # noqa: BLE001 - shown below
            problems.append(problem)

    threads = [threading.Thread(target=write, args=(at,)) for at in range(5)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert problems == []
    ids = [r.geography_id for r in tables.read_published(spark, root).collect()]
    assert sorted(ids) == [*range(5), *range(100, 105)]
    assert tables.published_version(spark, root) == 5


def test_an_edit_that_read_the_old_rows_is_made_again(spark, tmp_path):
    mart = str(tmp_path / "mart")
    one, two = spark.range(1).toDF("x"), spark.range(2).toDF("x")
    tables.commit(spark, mart, [tables.Edit("a", lambda held: one)])
    made = []

    def grow(held):
        made.append(held.count())
        if len(made) == 1:  # meanwhile
            tables.commit(spark, mart, [tables.Edit("a", lambda held: two), tables.Edit("b", lambda held: one)])
        return held.union(one)

    assert tables.commit(spark, mart, [tables.Edit("a", grow)]) == {"a": 3}
    assert made == [1, 2] and tables.read_published(spark, f"{mart}/a").count() == 3
    assert tables.commit(spark, mart, [tables.Edit("a", lambda held: None)]) == {}
    assert tables.read_published(spark, f"{mart}/b").count() == 1


def test_a_half_written_manifest_is_no_version(spark, tmp_path):
    root = str(tmp_path / "fact")
    tables.upsert_published(spark, root, facts(spark, [(1, 202001, 1, 1.0)]), schemas.MONTHLY_KEY)
    for name, text in (("2.json", ""), ("3.json", '{"tables": '), ("notes.txt", "x")):
        (tmp_path / "fact" / "published" / name).write_text(text)
    assert [r.geography_id for r in tables.read_published(spark, root).collect()] == [1]
    tables.upsert_published(spark, root, facts(spark, [(2, 202001, 1, 1.0)]), schemas.MONTHLY_KEY)
    assert sorted(r.geography_id for r in tables.read_published(spark, root).collect()) == [1, 2]
    assert commits.numbers(spark, root) == [1, 2, 3, 4]


@pytest.mark.parametrize("step", ["_write", "rename", "link"])
def test_a_writer_that_dies_leaves_the_mart_readable(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "fact")
    tables.upsert_published(spark, root, facts(spark, [(1, 202001, 1, 1.0)]), schemas.MONTHLY_KEY)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if step == "link":
            patch.setattr(commits.os, "link", dies)
        elif step == "_write":
            patch.setattr(commits, "_link", lambda final, text: commits._write(*commits.files_of(spark, f"{root}/published/_writing/x"), text[:9]) or dies())
        else:
            patch.setattr(tables.commits, "put", dies)
        with pytest.raises(KeyboardInterrupt):
            tables.upsert_published(spark, root, facts(spark, [(2, 202001, 1, 2.0)]), schemas.MONTHLY_KEY)
    assert [r.geography_id for r in tables.read_published(spark, root).collect()] == [1]
    tables.upsert_published(spark, root, facts(spark, [(3, 202001, 1, 3.0)]), schemas.MONTHLY_KEY)
    assert sorted(r.geography_id for r in tables.read_published(spark, root).collect()) == [1, 3]
    named = files_below(root)
    tables.remove_unreferenced(spark, root, keep=1, stray_age=-60)
    assert files_below(root) < named  # what the dead writer left is gone, after its time
    assert sorted(r.geography_id for r in tables.read_published(spark, root).collect()) == [1, 3]
    assert os.listdir(f"{root}/published/_writing") == []


def test_a_number_is_given_once_by_link_and_by_rename(spark, tmp_path):
    root = str(tmp_path)
    commits.put(spark, root, 1, {"tables": {}})
    with pytest.raises(commits.VersionTaken):
        commits.put(spark, root, 1, {"tables": {"x": 1}})
    commits._rename(spark, root, f"{root}/published/2.json", b'{"tables": {"y": 2}}')
    with pytest.raises(commits.VersionTaken):
        commits._rename(spark, root, f"{root}/published/2.json", b"{}")
    assert commits.content(spark, root, 1) == {"tables": {}}
    assert commits.newest(spark, root) == (2, {"tables": {"y": 2}})


def test_impossible_dates_fail(spark, tmp_path):
    for date_id in (20, None, 999_901):
        with pytest.raises(ValueError, match="dates of the batch"):
            tables.upsert_published(spark, str(tmp_path / "x"), facts(spark, [(1, date_id, 1, 1.0)]), schemas.MONTHLY_KEY)


def test_scratch_is_removed(spark, tmp_path):
    with Scratch(spark, "run", str(tmp_path)) as scratch:
        assert scratch.stage(spark.range(3), "rows").count() == 3
        assert os.listdir(tmp_path)
    assert os.listdir(tmp_path) == []


def test_finer_partitions_are_pruned_by_indicator(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(g, 202001 + m, i, 1.0) for g in range(3) for m in range(5) for i in range(4)]
    tables.write_facts(facts(spark, rows), path, partition_by=["indicator_id", "year"])
    one = spark.read.parquet(path).filter("indicator_id = 2 AND year = 2020")
    assert one.count() == 15 and len(one.inputFiles()) > 0
    assert "PartitionFilters: [isnotnull(indicator_id" in one._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert fresh_folder(spark, "x").startswith(named)
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_incremental_ingest_loads_each_file_once(spark, tmp_path):
    drop, root, progress = tmp_path / "drop", str(tmp_path / "mart"), str(tmp_path / "progress")
    drop.mkdir()

    def run():
        return ingest_new_files(spark, str(drop), FACT, root, schemas.MONTHLY_KEY, progress, files_per_batch=1)

    (drop / "a.csv").write_text("geography_id,date_id,indicator_id,value\n1,202001,1,1.0\n2,202001,1,2.0\n")
    assert run() == 1
    assert run() == 0
    time.sleep(0.05)
    (drop / "b.csv").write_text("geography_id,date_id,indicator_id,value\n2,202001,1,5.0\n3,202001,1,3.0\n")
    assert run() == 1

    def held():
        rows = tables.read_published(spark, root).orderBy("geography_id").collect()
        return [(r.geography_id, float(r.value)) for r in rows]

    assert held() == [(1, 1.0), (2, 5.0), (3, 3.0)]
    time.sleep(0.05)
    for bad in (
        "geography_id,date_id,indicator_id,value\n2,202001,1,oops\n",
        "date_id,geography_id,indicator_id,value\n202001,2,1,7.0\n",
    ):
        (drop / "c.csv").write_text(bad)
        with pytest.raises(Exception):
            run()
        assert held() == [(1, 1.0), (2, 5.0), (3, 3.0)]


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "2020_a.csv").write_text("month,rate,year,term\n3,1.5,2021,1 year\n")
    records = delimited.read_records(spark, str(tmp_path), schemas.RATE_RECORD).first()
    assert (records.year, records.month, records.term, records.rate) == (2021, 3, "1 year", 1.5)
    row = delimited.read_yearly(spark, str(tmp_path), schemas.RATE_RECORD).first()
    assert (row.year, row.month, row.rate, row.file_year) == (2021, 3, 1.5, 2020)
    (tmp_path / "2021_b.csv").write_text("year,month,term,rate\n2022,4,2 year,2.5\n")
    with pytest.raises(Exception):
        delimited.read_records(spark, str(tmp_path), schemas.RATE_RECORD).collect()


def test_the_newest_snapshot_is_read_whole(spark, tmp_path):
    old = spark.createDataFrame([(i, "old") for i in range(4)], "k INT, v STRING")
    new = spark.createDataFrame([(i, "new") for i in range(9)], "k INT, v STRING").repartition(3)
    delimited.export_snapshot(old, str(tmp_path), "cpi", "2024-01-01")
    time.sleep(0.05)
    path = delimited.export_snapshot(new, str(tmp_path), "cpi", "2024-02-01")
    found = snapshots.newest_snapshot(spark, f"{tmp_path}/cpi")
    assert found.endswith("cpi/2024-02-01") and path.endswith("cpi/2024-02-01")
    assert delimited.read_text_table(spark, found, ["v"]).distinct().collect()[0].v == "new"
    assert delimited.read_text_table(spark, found).count() == 9


def test_only_wanted_sheets_are_decoded(spark):
    sheets = {"Notes": {1: ["n"]}, "CSD 1": {1: ["a"]}, "CSD 2": {1: ["b"]}}
    books = spark.createDataFrame([("x/a.xlsx", workbook_bytes(sheets))], "path STRING, content BINARY")
    assert [r.sheet for r in workbooks.workbook_grid(books, ["CSD 2"]).collect()] == ["CSD 2"]
    chosen = workbooks.workbook_grid(books, choose=grids.survey_choice).collect()
    assert [(r.sheet, r.sheet_idx) for r in chosen] == [("CSD 1", 1)]
