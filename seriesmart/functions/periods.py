"""Periods as INT ids: YYYYMM for a month, YYYY00 for a year."""

from pyspark.sql import Column, functions as F

from seriesmart.fixed_values import MONTHS
from seriesmart.functions.numbers import safe_int
from seriesmart.functions.text import trimmed


def month_id_from_text(ref_date: Column) -> Column:
    """"2020-03" as 202003."""
    return safe_int(F.replace(ref_date, F.lit("-"), F.lit("")))


def month_id(year: Column, month: Column) -> Column:
    return (year * 100 + month).cast("int")


def annual_id(year: Column) -> Column:
    return (year * 100).cast("int")


def october_id(year: Column) -> Column:
    """The id of the yearly October survey."""
    return (year * 100 + 10).cast("int")


def quarter_end_month(quarter: Column) -> Column:
    """1..4 as 3, 6, 9, 12; any other digit as NULL."""
    return F.when(quarter.between(1, 4), quarter * 3).cast("int")


def quarter_of_month(month: Column) -> Column:
    return F.when(month.between(1, 12), F.ceil(month / 3)).cast("int")


def month_number(name: Column) -> Column:
    """"jan" as 1, in any case; anything else as NULL."""
    found = F.array_position(F.array(*map(F.lit, MONTHS)), F.upper(trimmed(name)))
    return F.nullif(found, F.lit(0)).cast("int")


def year_in_text(text: Column, pattern: str = r"(20\d{2})") -> Column:
    """The first year written in a file name or key."""
    return safe_int(F.regexp_extract(text, pattern, 1))


def label_year(label: Column) -> Column:
    """The year of a full period label such as "2021Q4"; NULL for "Q1" and notes."""
    return safe_int(F.regexp_extract(trimmed(label), r"^(\d{4})Q\d", 1))


def label_quarter(label: Column) -> Column:
    """The quarter digit of a full or short period label."""
    plain = trimmed(label)
    return safe_int(
        F.coalesce(
            F.nullif(F.regexp_extract(plain, r"^\d{4}Q(\d)", 1), F.lit("")),
            F.nullif(F.regexp_extract(plain, r"^Q(\d)$", 1), F.lit("")),
        )
    )


def year_of(date_id: Column) -> Column:
    return F.floor(date_id / 100).cast("int")


def month_of(date_id: Column) -> Column:
    return (date_id % 100).cast("int")


def is_annual(date_id: Column) -> Column:
    return date_id % 100 == 0


def monthly(date_id: Column) -> Column:
    return month_of(date_id).between(1, 12)


def october(date_id: Column) -> Column:
    return month_of(date_id) == 10


def quarter_ends(date_id: Column) -> Column:
    return month_of(date_id).isin(3, 6, 9, 12)


def in_years(date_id: Column, first: int, last: int) -> Column:
    """A range on the id itself, so that it can reach the scan."""
    return date_id.between(first * 100, last * 100 + 12)


def loaded_now() -> Column:
    return F.current_timestamp()
