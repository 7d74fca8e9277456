"""A whole refresh: downloaded files in, published fact tables out."""

import os
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from builders import archive_bytes, as_tuples, workbook_bytes
from seriesmart import fixed_values as fixed
from seriesmart.checks import files
from seriesmart.plans import availability, questions, runs
from seriesmart.plans.loads import LoadProblems, load
from seriesmart.sources import commits
from seriesmart.sources.scratch import Scratch
from seriesmart.sources.tables import publish, read_published, versions


def put(path, content, at):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    raw, books = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("books")
    number = fixed.TABLE_NUMBERS
    head = "REF_DATE,GEO,UOM,Products and product groups,VALUE\n"
    put(raw / number["cpi_cma"] / "2024-01-01.csv", head + '2020-01,"Toronto, Ontario",2002=100,Shelter,1\n', 0)
    put(raw / number["cpi_cma"] / "2024-02-01.csv", "﻿" + head + '2020-01,"Toronto, Ontario",2002=100,Shelter,120.25\n', 9)
    fuel = next(iter(fixed.FUEL_LABELS))
    put(
        raw / number["gasoline_prices"] / "gas.zip",
        archive_bytes({"x_MetaData.csv": "a\n", "x.csv": f'REF_DATE,GEO,"Type of fuel",VALUE\n2020-02,Halifax,{fuel},99.5\n'}),
        0,
    )
    put(raw / number["food_prices"] / "f.csv", 'REF_DATE,GEO,Products,VALUE\n2020-01,Alberta,"Eggs, 1 dozen",3.5\n', 0)
    put(raw / number["nhpi"] / "n.csv", "REF_DATE,GEO,New housing price indexes,VALUE\n1981-01,Regina,Land only,40\n", 0)
    rows = "".join(
        f"2019,Toronto,Wages,All,Both,{name},{value}\n"
        for name, value in zip(fixed.INCOME_STATISTICS, ("50000", "60000", "1200"))
    )
    put(raw / number["median_income"] / "i.csv", f"REF_DATE,GEO,Income source,Age group,Sex,Statistics,VALUE\n{rows}", 0)

    survey = {"CSD": {1: ["Vacancy rates"], 4: ["ON", "Toronto", "Total", "Total", 1.5]}}
    put(books / "2023_vacancy.xlsx", workbook_bytes(survey), 0)
    for edition, rate, at in (("12-25", 9.0, 5), ("02-26", 4.5, 0)):
        sheet = {"Table K1": {3: [2025, "JAN", rate, None, 5.5], 4: [None, "FEB", rate], 5: ["Source"]}}
        put(books / f"mortgage-rates-{edition}-en.xlsx", workbook_bytes(sheet), at)
    trends = {
        "DATA_1": {4: ["2025Q4", 0.2, 0.3]}, "DATA_7": {4: ["2025Q4", 9, 1]},
        "DATA_13": {4: ["2025Q4", 700]}, "DATA_25": {4: ["2025Q4", 1500, 1900]},
    }
    put(books / "mortgage-consumer-credit-trends-canada-2025-q4-en.xlsx", workbook_bytes(trends), 0)
    for name, value in (("real-median-household-income-after-tax-tenure", 70000), ("average-household-after-tax-income-by-tenure", 80000)):
        sheet = {8: ["Geography", "2006", "q"], 9: ["Toronto", value, "A"]}
        put(books / f"{name}-2006-2023-en.xlsx", workbook_bytes(dict.fromkeys(fixed.TENURE_SHEETS, sheet)), 0)
    return str(raw), str(books)


def test_refresh_from_files(spark, folders, tmp_path):
    raw, books = folders
    mart = str(tmp_path / "mart")
    versions = runs.refresh(spark, raw, books, mart)
    assert versions == {"fact_monthly": 1, "fact_annual_income": 1, "fact_annual_income_tenure": 1}
    dims = runs.published_dims(spark)
    monthly = read_published(spark, f"{mart}/fact_monthly").withColumn("value", F.col("value").cast("double"))
    names = monthly.join(dims.geography, "geography_id").join(dims.indicators, "indicator_id")
    assert as_tuples(names, "cma_name", "date_id", "indicator_name", "value") == [
        ("Calgary", 202001, "Food price - Eggs (per dozen)", 3.5),
        ("Canada", 202501, "Mortgage rate - 1 year", 4.5),
        ("Canada", 202501, "Mortgage rate - 5 year", 5.5),
        ("Canada", 202502, "Mortgage rate - 1 year", 4.5),
        ("Canada", 202512, "Avg credit score - Without mortgage", 700.0),
        ("Canada", 202512, "Avg monthly mortgage payment - Existing", 1500.0),
        ("Canada", 202512, "Avg monthly mortgage payment - New", 1900.0),
        ("Canada", 202512, "HELOC delinquency rate", 1.0),
        ("Canada", 202512, "Mortgage delinquency rate", 0.2),
        ("Edmonton", 202001, "Food price - Eggs (per dozen)", 3.5),
        ("Halifax", 202002, "Gasoline price (per litre)", 99.5),
        ("Montreal", 202512, "Mortgage delinquency rate", 0.3),
        ("Regina", 198101, "NHPI - Land only", 40.0),
        ("Toronto", 202001, "CPI - Shelter", 120.25),
        ("Toronto", 202310, "Vacancy rate - Bachelor", 1.5),
    ]
    income = read_published(spark, f"{mart}/fact_annual_income").first()
    assert (float(income.median_income), float(income.avg_income), income.num_persons) == (50000.0, 60000.0, 1200)
    tenure = read_published(spark, f"{mart}/fact_annual_income_tenure")
    assert tenure.count() == 3 and float(tenure.first().avg_income) == 80000.0

    opened = runs.open_mart(spark, mart)
    rate = questions.value_of(opened, "Mortgage rate - 5 year", "Canada", 2025).collect()
    assert [(r.year, r.month, r.unit, float(r.value)) for r in rate] == [(2025, 1, "Percent", 5.5)]
    assert opened.calendar.agg(F.min("year"), F.max("year")).first()[:] == (1981, 2025)

    again = runs.refresh(spark, raw, books, mart, sources=["cpi_cma", "mortgage_rates"])
    assert again == {"fact_monthly": 2}
    assert read_published(spark, f"{mart}/fact_monthly").count() == 15


def test_stored_dimensions_keep_their_ids(spark, tmp_path):
    root = str(tmp_path)
    seed = runs.stored_dims(spark, root).geography
    ids = {r.cma_name: r.geography_id for r in seed.collect()}
    fewer = seed.filter("cma_name <> 'Calgary'")
    publish(spark, fewer, f"{root}/dim_geography", partition_by=[])
    grown = {r.cma_name: r.geography_id for r in runs.stored_dims(spark, root).geography.collect()}
    assert grown.pop("Calgary") == 18  # a fresh number, after the highest given
    ids.pop("Calgary")
    assert grown == ids


def test_refresh_loads_what_it_can_and_reports_the_rest(spark, folders, tmp_path):
    raw, books = folders
    mart = str(tmp_path / "mart")
    with pytest.raises(ExceptionGroup) as raised:
        runs.refresh(spark, str(tmp_path), books, mart, sources=["nhpi", "rental_survey"])
    assert "nhpi failed" in str(raised.value.exceptions[0])
    assert read_published(spark, f"{mart}/fact_monthly").count() == 1


def test_a_lazily_failing_source_does_not_stop_its_table(spark, tmp_path):
    layout = "geography_id INT, date_id INT, indicator_id INT, value STRING"
    good = spark.createDataFrame([(1, 202001, 1, "1.5")], layout)
    bad = good.withColumn("value", F.raise_error(F.lit("no such place")).cast("string"))
    with pytest.raises(LoadProblems) as raised:
        load(spark, str(tmp_path), [("cpi_cma", good), ("credit_trends", bad)])
    assert raised.value.versions == {"fact_monthly": 1} and "credit_trends failed" in str(raised.value.exceptions[0])
    assert read_published(spark, f"{tmp_path}/fact_monthly").count() == 1


def test_an_unknown_workbook_does_not_stop_the_known_ones(spark, folders, tmp_path):
    raw, books = folders
    mixed, mart = tmp_path / "books", str(tmp_path / "mart")
    survey = {"CSD": {1: ["Vacancy rates"], 4: ["ON", "Toronto", "Total", "Total", 1.5]}}
    put(mixed / "2023_vacancy.xlsx", workbook_bytes(survey), 0)
    put(mixed / "2023_other.xlsx", workbook_bytes({"Notes": {1: ["nothing"]}}), 0)
    with pytest.raises(ExceptionGroup, match="some sources failed") as raised:
        runs.refresh(spark, raw, str(mixed), mart, sources=["rental_survey"])
    assert "2023_other.xlsx" in str(raised.value.exceptions[0])
    assert read_published(spark, f"{mart}/fact_monthly").count() == 1


def test_years_exports_scratch_and_given_dimensions(spark, folders, tmp_path):
    raw, books = folders
    mart, exports, scratch = (str(tmp_path / name) for name in ("mart", "exports", "scratch"))
    runs.refresh(
        spark, raw, books, mart, dims=runs.published_dims(spark), sources=["nhpi", "mortgage_rates", "median_income"],
        years=(2000, 2030), exports=exports, day="2024-05-06", scratch_root=scratch,
    )
    opened = runs.open_mart(spark, mart)
    assert opened.monthly.agg(F.min("date_id")).first()[0] == 202501  # the prices of 1981 are left out
    income = questions.annual_rows(opened.income, opened, ["Toronto"], income_source="Wages").first()
    assert (income.year, float(income.median_income)) == (2019, 50000.0)
    ranked = questions.rank_incomes(opened.income, opened, "avg_income", 3, income_source="Wages").collect()
    assert [(r.position, r.cma_name, float(r.value)) for r in ranked] == [(1, "Toronto", 60000.0)]
    assert opened.tenure.count() == 0
    assert sorted(os.listdir(exports)) == ["median_income", "mortgage_rates", "nhpi"]
    assert os.listdir(f"{exports}/nhpi") == ["2024-05-06"]
    assert not os.path.exists(scratch) or os.listdir(scratch) == []
    assert versions(spark, f"{mart}/fact_monthly") == [1]


def test_a_failing_table_does_not_stop_the_others(spark, tmp_path):
    bad = spark.createDataFrame([(1, 202001, 1, "1e99")], "geography_id INT, date_id INT, indicator_id INT, value STRING")
    tenure = spark.createDataFrame([(1, 202000, "Owner", 1.0, 2.0)], "geography_id INT, date_id INT, tenure STRING, median_income DOUBLE, avg_income DOUBLE")
    with pytest.raises(ExceptionGroup):
        load(spark, str(tmp_path), [("cpi_cma", bad), ("income_tenure", tenure)])
    assert read_published(spark, f"{tmp_path}/fact_annual_income_tenure").count() == 1


def test_facts_and_calendar_appear_as_one_version(spark, tmp_path, monkeypatch):
    layout = "geography_id INT, date_id INT, indicator_id INT, value STRING"
    root = str(tmp_path)
    runs.stored_dims(spark, root)
    load(spark, root, [("cpi_cma", spark.createDataFrame([(1, 202001, 1, "1.5")], layout))])
    opened, seen = runs.open_mart(spark, root), []

    def years(mart):
        return {r.year for r in mart.calendar.select("year").distinct().collect()}

    def watched(*parts):
        now = runs.open_mart(spark, root)
        held = {r.y for r in now.monthly.select((F.col("date_id") / 100).cast("int").alias("y")).distinct().collect()}
        seen.append(held <= years(now))
        return put(*parts)

    put = commits.put
    monkeypatch.setattr(commits, "put", watched)
    load(spark, root, [("cpi_cma", spark.createDataFrame([(1, 203501, 1, "2.5")], layout))])
    now = runs.open_mart(spark, root)
    assert seen == [True] and years(now) == set(range(2020, 2036)) and now.monthly.count() == 2
    assert years(opened) == {2020} and opened.monthly.count() == 1  # an open mart stays as it was
    numbers = commits.numbers(spark, root)
    load(spark, root, [("cpi_cma", spark.createDataFrame([(2, 202501, 1, "3.5")], layout))])
    assert commits.numbers(spark, root)[-1] == numbers[-1] + 1
    assert versions(spark, f"{root}/dim_date") == [2]  # its years did not change
    runs.publish_calendar(spark, root)
    assert commits.numbers(spark, root)[-1] == numbers[-1] + 1


def test_the_report_comes_from_kept_dates(spark, tmp_path):
    layout = "geography_id INT, date_id INT, indicator_id INT, value STRING"
    root = str(tmp_path)
    names = {r.indicator_name: r.indicator_id for r in runs.stored_dims(spark, root).indicators.collect()}
    shelter = names["CPI - Shelter"]
    first = [(1, 202001, shelter, "1"), (2, 202001, shelter, "1"), (1, 201901, shelter, "1")]
    load(spark, root, [("cpi_cma", spark.createDataFrame(first, layout))])
    load(spark, root, [("cpi_cma", spark.createDataFrame([(1, 202001, shelter, "5"), (1, 202105, shelter, "2")], layout))])
    mart = runs.open_mart(spark, root)
    assert as_tuples(mart.dates, "indicator_id", "date_id", "facts") == [(shelter, 201901, 1), (shelter, 202001, 2), (shelter, 202105, 1)]
    report = availability.mart_report(mart)
    scanned = availability.mart_report(replace(mart, dates=None, income_dates=None))
    assert sorted(report.collect()) == sorted(scanned.collect())
    assert not any("/fact_monthly/" in f or "/fact_annual_income/" in f for f in report.inputFiles())
    assert any("/fact_monthly_dates/" in f for f in report.inputFiles())
    before = {f for f in mart.dates.inputFiles()}
    load(spark, root, [("cpi_cma", spark.createDataFrame([(3, 202106, shelter, "2")], layout))])
    kept = before & set(runs.open_mart(spark, root).dates.inputFiles())
    assert kept and not any("year=2021" in f for f in kept)  # only the years of the load are counted again


def test_a_load_writes_one_row_per_key_of_each_source(spark, tmp_path, monkeypatch):
    written, stage = {}, Scratch.stage

    def counted(self, df, name, *more):
        held = stage(self, df, name, *more)
        written[name] = held.count()
        return held

    monkeypatch.setattr(Scratch, "stage", counted)
    rows = [(1, 202001, 1, float(at)) for at in range(50)] + [(2, 202001, 1, 7.0)]
    facts = spark.createDataFrame(rows, "geography_id INT, date_id INT, indicator_id INT, value DOUBLE")
    load(spark, str(tmp_path), [("cpi_cma", facts), ("nhpi", facts.filter("value < 3"))])
    assert written["0-cpi_cma"] == 2 and written["1-nhpi"] == 1
    found = read_published(spark, f"{tmp_path}/fact_monthly")
    assert {(r.geography_id, float(r.value)) for r in found.collect()} == {(1, 2.0), (2, 7.0)}


def test_two_loads_of_a_mart_transform_each_source_once(spark, folder, monkeypatch):
    calls = Counter()

    def counted(name, run):
        return lambda *given: calls.update([name]) or run(*given)

    for name in ("E6_rental_survey", "E8_mortgage_rates", "E9_credit_trends"):
        monkeypatch.setitem(files.CHECKS, name, files.CHECKS[name].__class__(counted(name, files.CHECKS[name].run), None))
    monkeypatch.setattr(files, "published", counted("published", files.published))
    monkeypatch.setattr(files, "load", lambda *given: None)
    monkeypatch.setattr(files.runs, "open_mart", lambda *given: None)
    files.loaded_mart(spark, folder, "date_id > 199600", "date_id > 0")
    assert calls == {"published": 1, "E6_rental_survey": 1, "E8_mortgage_rates": 1, "E9_credit_trends": 1}
