"""The transforms on small tables laid out like the published ones."""

import pytest
from pyspark.sql import functions as F

from builders import as_tuples, grid, grid_rows
from seriesmart import fixed_values as fixed
from seriesmart.plans import availability, grids, questions, series
from seriesmart.plans.runs import published_dims
from seriesmart.operators.dims import calendar_for


@pytest.fixture(scope="module")
def dims(spark):
    return published_dims(spark)


def named(facts, dims, *columns):
    rows = facts.join(dims.geography, "geography_id")
    if "indicator_id" in facts.columns:
        rows = rows.join(dims.indicators, "indicator_id")
    return as_tuples(rows, *columns)


def raw(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` STRING" for c in columns))


def test_consumer_prices(spark, dims):
    table = raw(
        spark,
        ["REF_DATE", "GEO", "UOM", "Products and product groups", "VALUE"],
        [
            ("2020-01", " Toronto, Ontario ", "2002=100", "Shelter", "120.5"),
            ("2020-01", "Toronto, Ontario", "1992=100", "Shelter", "150.0"),
            ("2020-02", "Montréal, Quebec", "2002=100", " All-items ", "110"),
            ("2020-02", "Lethbridge, Alberta", "2002=100", "Shelter", "1"),
            ("2020-02", "Calgary, Alberta", "2002=100", "Clothing", "1"),
            ("2020-02", "Calgary, Alberta", "2002=100", "Food", ""),
            ("2020-02", "Calgary, Alberta", "2002=100", "Food", None),
            ("2020-02", "Calgary, Alberta", "2002=100", "Food", ".."),
            ("2020-03", "Thunder Bay, Ontario", "2002=100", "Energy", "99.9"),
        ],
    )
    facts = series.city_series(table, dims, series.CPI)
    assert named(facts, dims, "cma_name", "date_id", "indicator_name", "value") == [
        ("Montreal", 202002, "CPI - All-items", 110.0),
        ("Thunder Bay", 202003, "CPI - Energy", 99.9),
        ("Toronto", 202001, "CPI - Shelter", 120.5),
    ]


def test_gasoline(spark, dims):
    fuel = next(iter(fixed.FUEL_LABELS))
    table = raw(
        spark,
        ["REF_DATE", "GEO", "Type of fuel", "VALUE"],
        [
            ("2020-01", "Ottawa-Gatineau, Ontario part, Ontario/Quebec", fuel, "101.1"),
            ("2020-01", "Ottawa", fuel, "102.2"),
            ("2020-01", "Ottawa", "Diesel", "5"),
        ],
    )
    facts = series.city_series(table, dims, series.GASOLINE)
    assert named(facts, dims, "cma_name", "indicator_name", "value") == [
        ("Ottawa-Gatineau", "Gasoline price (per litre)", 101.1),
        ("Ottawa-Gatineau", "Gasoline price (per litre)", 102.2),
    ]


def test_food_goes_to_every_city_of_the_province(spark, dims):
    table = raw(
        spark,
        ["REF_DATE", "GEO", "Products", "VALUE"],
        [
            ("2020-01", " Ontario ", "Eggs, 1 dozen", "3.5"),
            ("2020-01", "Manitoba", "Milk, 2 litres", "4.5"),
            ("2020-01", "Canada", "Milk, 2 litres", "9"),
            ("2020-01", "Manitoba", "Butter", "9"),
        ],
    )
    facts = series.regional_series(table, dims, series.FOOD)
    eggs, milk = "Food price - Eggs (per dozen)", "Food price - Milk (per 2L)"
    assert named(facts, dims, "cma_name", "date_id", "indicator_name", "value") == [
        ("Ottawa-Gatineau", 202001, eggs, 3.5),
        ("Thunder Bay", 202001, eggs, 3.5),
        ("Toronto", 202001, eggs, 3.5),
        ("Winnipeg", 202001, milk, 4.5),
    ]


def test_house_prices_before_the_seeded_calendar(spark, dims):
    table = raw(
        spark,
        ["REF_DATE", "GEO", "New housing price indexes", "VALUE"],
        [("1981-01", "Halifax, Nova Scotia", "Land only", "40.1"), ("2020-01", "Halifax", "House only", "100")],
    )
    facts = series.city_series(table, dims, series.HOUSE_PRICES)
    assert named(facts, dims, "date_id", "indicator_name") == [
        (198101, "NHPI - Land only"), (202001, "NHPI - House only"),
    ]
    assert calendar_for(facts).filter("date_id = 198101").count() == 1


def test_income(spark, dims):
    median, average, persons = fixed.INCOME_STATISTICS
    rows = [
        ("2019", "Toronto, Ontario", "Wages", "All", "Both", median, "50000"),
        ("2019", "Toronto", " Wages ", "All", "Both", median, "1"),
        ("2019", "Toronto", "Wages", "All", "Both", average, "60000.5"),
        ("2019", "Toronto", "Wages", "All", "Both", persons, "1200"),
        ("2020", "Regina", "Wages", "All", "Both", median, "x"),
        ("2021", "Regina", "Wages", "All", "Both", average, "7"),
        ("2021", "Regina", "Wages", "All", "Both", "Other statistic", "7"),
        ("2021", "Lethbridge", "Wages", "All", "Both", average, "7"),
    ]
    names = ["REF_DATE", "GEO", "Income source", "Age group", "Sex", "Statistics", "VALUE"]
    table = raw(spark, names, rows).coalesce(1).withColumn("at", F.monotonically_increasing_id())
    facts = series.income_facts(table, dims, "at")
    assert named(facts, dims, "cma_name", "date_id", "income_source", "median_income", "avg_income", "num_persons") == [
        ("Regina", 202100, "Wages", None, 7.0, None),
        ("Toronto", 201900, "Wages", 50000.0, 60000.5, 1200),
    ]


def survey(file, title, rows, sheet="CSD - SDR", first_row=4):
    return grid_rows(file, sheet, 1, [[title]]) + grid_rows(file, sheet, first_row, rows)


def test_rental_survey(spark, dims):
    total = ["Total", "Total"]
    vacancy = survey(
        "2023_vacancy.xlsx",
        "Rental Vacancy Rates",
        [
            ["ON", " Toronto CMA ", *total, "1.2%", "a", "--", "b", "**", "c", "", "d", "$1,234"],
            ["ON", "Toronto", "Ajax", "Total", "9"],
            ["ON", "Total", *total, "9"],
            ["ON", None, *total, "9"],
            ["AB", "Calgary", *total, "n/a", "a", "2.5"],
            ["AB", "Lethbridge", *total, "9"],
        ],
    )
    rents = survey("rents-2022.xlsx", "Average Rent", [["AB", "Calgary", *total, "1,000"]])
    gap = [None] * 4
    occupied = survey(
        "2020.xlsx",
        "Vacancy mentioned here does not matter",
        [
            ["Calgary CMA", "2019", "x", "y", "1,100", *gap, "$5", *gap, "1300"],
            ["Remainder of CMA", "2019", "x", "y", "9"],
            ["Quebec - CMA", None, "x", "y", "700"],
            ["Calgary", "2019", "x", "y", "9"],
        ],
        sheet="ARent_Vac_Occ",
        first_row=11,
    )
    other_sheet = grid_rows("2020.xlsx", "CSD", 1, [["Vacancy"]], sheet_idx=1)
    records = grids.rental_records(grid(spark, vacancy + rents + occupied + other_sheet), dims.spellings)
    assert as_tuples(records, "year", "centre", "bedroom_type", "value", "data_type") == [
        (2019, "Calgary", "2 Bedroom", 1300.0, "rent"),
        (2019, "Calgary", "Bachelor", 1100.0, "rent"),
        (2020, "Quebec City", "Bachelor", 700.0, "rent"),
        (2022, "Calgary", "Bachelor", 1000.0, "rent"),
        (2023, "Calgary", "1 Bedroom", 2.5, "vacancy"),
        (2023, "Toronto", "Bachelor", 1.2, "vacancy"),
        (2023, "Toronto", "Total", 1234.0, "vacancy"),
    ]
    facts = grids.rental_facts(records, dims)
    assert ("Toronto", 202310, "Vacancy rate - Total", 1234.0) in named(
        facts, dims, "cma_name", "date_id", "indicator_name", "value"
    )


def test_unknown_survey_files_fail(spark, dims):
    assert grids.unrecognised(grid(spark, survey("2021.xlsx", "Starts", [["x"]]))) == ["2021.xlsx"]
    rows = survey("rents.xlsx", "Average Rent", [["AB", "Calgary", "Total", "Total", "1"]])
    with pytest.raises(Exception, match="no year in file name"):
        grids.rental_records(grid(spark, rows), dims.spellings).collect()


def test_income_by_tenure(spark, dims):
    header = ["Geography", "2006", "q", " 2011 ", "q", "1999", "q", "text"]
    median = [
        *grid_rows("m.xlsx", "Renter", 8, [header, ["Toronto", "30000", "A", "31000", "A", "1", "A"]]),
        *grid_rows("m.xlsx", "Owner", 8, [["Geography", "q", "2016"], [" Calgary CMA ", "A", "90000"], ["Calgary", "A", "95000"]]),
        *grid_rows("m.xlsx", "Notes", 8, [header, ["Toronto", "1"]]),
    ]
    average = [
        *grid_rows(
            "a.xlsx",
            "Renter",
            8,
            [header, ["Toronto", None, "A", "33000"], ["Halifax", "x", "A"], ["Geography", "5"], ["End of worksheet", "5"], [None, "5"]],
        )
    ]
    medians = grids.tenure_records(grid(spark, median), dims.spellings, "median_income")
    averages = grids.tenure_records(grid(spark, average), dims.spellings, "avg_income")
    facts = grids.tenure_facts(medians, averages, dims)
    assert named(facts, dims, "cma_name", "date_id", "tenure", "median_income", "avg_income") == [
        ("Calgary", 201600, "Owner", 95000.0, None),
        ("Toronto", 200600, "Renter", 30000.0, None),
        ("Toronto", 201100, "Renter", 31000.0, 33000.0),
    ]


def rates(rows, file="rates.xlsx", sheet="Table K1"):
    return grid_rows(file, sheet, 3, rows)


def test_mortgage_rates(spark, dims):
    rows = rates(
        [
            ["2021", "Jan", "1.5", "2.25555", None],
            [None, " feb ", "1.6", "x", "3"],
            ["Source: lenders", "MAR", "9", "9", "9"],
            [None, "APR", "1.7"],
            [None, "Average", "9"],
            ["2022", "JAN", "2"],
        ]
    )
    early = rates([[None, "DEC", "7"], ["2020", "DEC", "8"]], file="other.xlsx")
    records = grids.rate_records(grid(spark, rows + early + rates([["2021", "JAN", "5"]], sheet="Notes")))
    assert as_tuples(records, "year", "month", "term", "rate") == [
        (2020, 12, "1 year", 8.0),
        (2021, 1, "1 year", 1.5),
        (2021, 1, "3 year", 2.2556),
        (2021, 2, "1 year", 1.6),
        (2021, 2, "5 year", 3.0),
        (2021, 4, "1 year", 1.7),
        (2022, 1, "1 year", 2.0),
    ]
    facts = named(grids.rate_facts(records, dims), dims, "cma_name", "date_id", "indicator_name", "value")
    assert ("Canada", 202102, "Mortgage rate - 5 year", 3.0) in facts and len(facts) == 7


def test_rates_fail_without_their_dimension_rows(spark, dims):
    records = grids.rate_records(grid(spark, rates([["2021", "Jan", "1.5"]])))
    no_nation = series.Dims(dims.geography.filter("cma_name <> 'Canada'"), dims.indicators)
    with pytest.raises(Exception, match="no geography_id for: Canada"):
        grids.rate_facts(records, no_nation).collect()
    no_series = series.Dims(dims.geography, dims.indicators.filter("category <> 'Mortgage'"))
    with pytest.raises(Exception, match="no indicator_id for: Mortgage rate - 1 year"):
        grids.rate_facts(records, no_series).collect()


def test_credit_trends(spark, dims):
    first = ["Q1", "0.1"], ["2021Q4", "0.2", "0.3", "x", "0.5"], ["Note"], ["Q1", "0.6"], ["2023Q5", "0.9"], ["Q2", None, "0.7"]
    rows = [
        *grid_rows("t.xlsx", "DATA_1", 4, first),
        *grid_rows("t.xlsx", "DATA_7", 4, [["2021Q4", "9", "1", "2", "3", "4"]]),
        *grid_rows("t.xlsx", "DATA_13", 4, [["2021Q4", "700", "720", "740"]]),
        *grid_rows("t.xlsx", "DATA_25", 4, [["2021Q4", "1500", "1900"], ["Q1", "1600", "2000"]]),
        *grid_rows("t.xlsx", "DATA_1", 1, [["2020Q1", "9"]]),
    ]
    records = grids.credit_records(grid(spark, rows))
    assert as_tuples(records.filter("indicator_name = 'Mortgage delinquency rate'"), "year", "quarter", "geography", "value") == [
        (2021, 1, "Canada", 0.6),  # a short label takes the year of the last full one
        (2021, 4, "Canada", 0.2),
        (2021, 4, "Montreal", 0.3),
        (2021, 4, "Vancouver", 0.5),
        (2023, 2, "Montreal", 0.7),
        (2023, 5, "Canada", 0.9),
    ]
    facts = grids.credit_facts(records, dims)
    got = named(facts, dims, "cma_name", "date_id", "indicator_name", "value")
    assert ("Canada", 202112, "Avg monthly mortgage payment - New", 1900.0) in got
    assert not [row for row in got if row[3] in (1600.0, 2000.0, 0.9)]  # short label there, and a fifth quarter
    strange = records.withColumn("geography", F.lit("Nowhere"))
    with pytest.raises(Exception, match="no geography_id for: Nowhere"):
        grids.credit_facts(strange, dims).collect()


@pytest.fixture(scope="module")
def mart(spark, dims):
    rows = [
        ("Toronto", "Vacancy rate - Total", 202210, 1.7), ("Toronto", "Vacancy rate - Total", 202310, 1.4),
        ("Calgary", "Vacancy rate - Total", 202310, 3.1), ("Halifax", "Vacancy rate - Total", 202210, 1.4),
        ("Toronto", "Avg rent - 2 Bedroom", 202310, 1900.0), ("Calgary", "Avg rent - 2 Bedroom", 202310, 1500.0),
        ("Toronto", "CPI - All-items", 202311, 160.0), ("Toronto", "CPI - Shelter", 202301, 170.0),
        ("Canada", "Mortgage delinquency rate", 202312, 0.6), ("Toronto", "Avg rent - Total", 202305, 5.0),
    ]
    named_rows = spark.createDataFrame(rows, "cma_name STRING, indicator_name STRING, date_id INT, value DOUBLE")
    facts = (
        named_rows.join(dims.geography, "cma_name")
        .join(dims.indicators, "indicator_name")
        .select("geography_id", "date_id", "indicator_id", F.col("value").cast("decimal(12,4)").alias("value"))
    )
    return questions.Mart(dims.geography, dims.indicators, calendar_for(facts), facts)


def test_questions(mart):
    one = questions.value_of(mart, "Avg rent - 2 Bedroom", "Calgary", 2023).collect()
    assert [(r.source, r.unit, r.frequency, r.date_id, float(r.value)) for r in one] == [
        ("CMHC", "CAD/month", "annual", 202310, 1500.0)
    ]
    table = questions.compare_cities(mart, "Vacancy rate - Total", ["Toronto", "Calgary", "Regina"], 2022, 2024)
    assert [(r.date_id, r.Toronto and float(r.Toronto), r.Calgary and float(r.Calgary), r.Regina) for r in table.orderBy("date_id").collect()] == [
        (202210, 1.7, None, None), (202310, 1.4, 3.1, None),
    ]
    ranked = questions.rank_cities(mart, "Vacancy rate - Total", 2).orderBy("position").collect()
    assert [(r.position, r.cma_name, float(r.value)) for r in ranked] == [(1, "Halifax", 1.4), (2, "Toronto", 1.4)]
    best = questions.rank_affordability(mart, "Avg rent - 2 Bedroom", "CPI - All-items", 85_000, 5).orderBy("position")
    assert [(r.cma_name, r.rent_share, r.price_index and float(r.price_index)) for r in best.collect()] == [
        ("Calgary", 0.211765, None), ("Toronto", 0.268235, 160.0),
    ]
    marks = questions.threshold_marks(questions.series(mart)).filter("mark IS NOT NULL")
    assert as_tuples(marks, "cma_name", "date_id", "mark") == [
        ("Canada", 202312, "elevated"), ("Halifax", 202210, "tight"),
        ("Toronto", 202210, "tight"), ("Toronto", 202310, "tight"),
    ]


def test_availability(spark, mart):
    income = spark.createDataFrame([(200600,), (202100,)], "date_id INT")
    years = availability.family_years(mart.monthly, mart.indicators, mart.calendar, availability.PUBLISHED_FAMILIES)
    years = years.unionByName(availability.annual_years(income, *fixed.INCOME_FAMILY))
    report = {r.family: (r.min_year, r.max_year, r.line) for r in availability.availability_report(years).collect()}
    assert len(report) == 9
    assert report["vacancy"] == ("2022", "2023", "Vacancy rates: 2022–2023 annual")
    assert report["rent"][:2] == ("2023", "2023")  # the figure of May is not an October survey
    assert report["nhpi"] == ("(no data)", "(no data)", "NHPI: (no data)–(no data) monthly")
    assert report["income"][:2] == ("2006", "2021")
    asked = spark.createDataFrame([("CPI - Shelter", 2023), ("CPI - Shelter", 2030), ("Unknown", 2020)], "indicator_name STRING, year INT")
    held = availability.indicator_years(mart.monthly, mart.indicators)
    assert as_tuples(availability.what_is_available(asked, held), "indicator_name", "year", "in_range", "min_year") == [
        ("CPI - Shelter", 2023, True, "2023"), ("CPI - Shelter", 2030, False, "2023"), ("Unknown", 2020, False, "(no data)"),
    ]


def test_nearest_documents(spark):
    docs = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 2.0]), (4, [0.0, 0.0]), (5, [3.0, 0.0])], "doc_id LONG, embedding ARRAY<FLOAT>"
    )
    asked = spark.createDataFrame([("a", [2.0, 0.0]), ("b", [0.0, 1.0])], "query_id STRING, embedding ARRAY<FLOAT>")
    want = [("a", 1, 1, 1.0), ("a", 2, 5, 1.0), ("b", 1, 3, 1.0), ("b", 2, 2, 0.707107)]
    odd = spark.createDataFrame([(6, None), (7, [1.0, None]), (8, [1.0])], docs.schema)
    got = questions.nearest_documents(docs.unionByName(odd), asked, 2)
    assert as_tuples(got, "query_id", "position", "doc_id", "score") == want


def test_bridge_to_years(spark):
    monthly = spark.createDataFrame(
        [(1, 202001, 1, "1.0"), (1, 202002, 1, "2.0"), (1, 202000, 1, "9.0"), (2, 202001, 1, "4.0")],
        "geography_id INT, date_id INT, indicator_id INT, value STRING",
    ).withColumn("value", F.col("value").cast("decimal(12,4)"))
    annual = spark.createDataFrame([(1, 202000, 50.0), (3, 202000, 60.0)], "geography_id INT, date_id INT, income DOUBLE")
    rows = questions.bridge_to_years(monthly, annual).collect()
    assert [(r.geography_id, r.year, float(r.value), r.months, r.income) for r in rows] == [(1, 2020, 1.5, 2, 50.0)]
