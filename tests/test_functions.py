import pytest
from pyspark.sql import functions as F

from seriesmart.functions import numbers, periods, text


def evaluate(spark, make, values, kind="string"):
    rows = spark.createDataFrame([(at, v) for at, v in enumerate(values)], f"at INT, v {kind}")
    return [r[0] for r in rows.orderBy("at").select(make(F.col("v"))).collect()]


def test_safe_double_takes_plain_decimal_text_only(spark):
    texts = ["1", " 2.5 ", "-.5", "3.", "1e3", "", "..", "nan", "inf", "1d", "0x1p3", "1,5", None, "0e100", " 7", "1E+005", "1e100", "2e-300"]
    assert evaluate(spark, numbers.safe_double, texts) == [
        1.0, 2.5, -0.5, 3.0, 1000.0, None, None, None, None, None, None, None, None, 0.0, 7.0, 100000.0, 1e100, 2e-300,
    ]


def test_cleaned_double_drops_only_the_given_signs(spark):
    assert evaluate(spark, numbers.cleaned_double, ["1.2%", "$1,234", "--"]) == [1.2, 1234.0, None]
    only_commas = evaluate(spark, lambda c: numbers.cleaned_double(c, ","), ["1,234.5", "1.2%"])
    assert only_commas == [1234.5, None]


def test_safe_int(spark):
    assert evaluate(spark, numbers.safe_int, ["2021", " 7 ", "2021.0", "x", None, "99999999999"]) == [
        2021, 7, None, None, None, None,
    ]


def test_rounding(spark):
    assert evaluate(spark, numbers.rounded_rate, [1.23456, 2.5], "double") == [1.2346, 2.5]
    assert evaluate(spark, numbers.whole_count, [2.5, 1200.0], "double") == [3, 1200]
    assert [str(v) for v in evaluate(spark, numbers.fact_value, ["1.23455", "2"])] == ["1.2346", "2.0000"]


def test_trimmed_drops_all_kinds_of_blanks(spark):
    assert evaluate(spark, text.trimmed, ["  a b\t", " x\n", "", None]) == ["a b", "x", "", None]


def test_marked_empty(spark):
    marks = evaluate(spark, text.is_marked_empty, [None, "--", "**", "", "0", " -- "])
    assert marks == [True, True, True, True, False, False]


def test_city_zones(spark):
    zones = ["Calgary CMA", "Remainder of CMA", "Calgary", "Quebec - CMA", "TorontoCMA"]
    assert evaluate(spark, text.is_city_zone, zones) == [True, False, False, True, True]
    assert evaluate(spark, text.without_city_suffix, zones[:1] + zones[3:]) == ["Calgary", "Quebec -", "TorontoCMA"]


def test_period_ids(spark):
    assert evaluate(spark, periods.month_id_from_text, ["2020-03", "bad", None]) == [202003, None, None]
    assert evaluate(spark, periods.annual_id, [2006], "int") == [200600]
    assert evaluate(spark, periods.october_id, [2019], "int") == [201910]
    assert evaluate(spark, periods.quarter_end_month, [1, 2, 3, 4, 5, 0], "int") == [3, 6, 9, 12, None, None]
    assert evaluate(spark, periods.quarter_of_month, [0, 1, 3, 4, 12], "int") == [None, 1, 1, 2, 4]
    assert evaluate(spark, periods.year_of, [202003, 200600], "int") == [2020, 2006]
    assert evaluate(spark, periods.month_of, [202003, 200600], "int") == [3, 0]
    assert evaluate(spark, periods.monthly, [202000, 202001, 202012], "int") == [False, True, True]


def test_month_names(spark):
    assert evaluate(spark, periods.month_number, ["JAN", " dec ", "Sept", None]) == [1, 12, None, None]


@pytest.mark.parametrize(
    "label, year, quarter",
    [
        ("2021Q4", 2021, 4),
        (" 2021Q4 (p)", 2021, 4),
        ("Q2", None, 2),
        ("Q2 note", None, None),
        ("2021Q9", 2021, 9),
        ("Source", None, None),
        (None, None, None),
    ],
)
def test_period_labels(spark, label, year, quarter):
    assert evaluate(spark, periods.label_year, [label]) == [year]
    assert evaluate(spark, periods.label_quarter, [label]) == [quarter]


def test_year_in_text(spark):
    names = ["2023_vacancy.xlsx", "rents-2019.xlsx", "rents.xlsx", "1999.xlsx"]
    assert evaluate(spark, periods.year_in_text, names) == [2023, 2019, None, None]


def test_report_text(spark):
    assert evaluate(spark, text.or_no_data, [2015, None], "int") == ["2015", "(no data)"]
