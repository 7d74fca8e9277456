"""Text expressions and row predicates."""

from pyspark.sql import Column, functions as F

from seriesmart.fixed_values import EMPTY_MARKS, NO_DATA, OCCUPIED_SHEET

BLANKS = " \t\n\r\x0b\x0c\u00a0\u2003"


def trimmed(text: Column) -> Column:
    """Text without leading or trailing white space of any kind."""
    return F.btrim(text, F.lit(BLANKS))


def has_text(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def is_marked_empty(text: Column) -> Column:
    """True for a missing cell and for the marks publishers use for "no figure"."""
    return text.isNull() | text.isin(EMPTY_MARKS)


def is_city_zone(zone: Column) -> Column:
    """A whole-city row: the zone ends in CMA and is not the remainder of one."""
    return zone.endswith("CMA") & ~zone.contains("Remainder")


def without_city_suffix(zone: Column) -> Column:
    return F.regexp_replace(zone, r"\s+CMA$", "")


def is_total_row(cells: Column) -> Column:
    """A whole-centre row of the survey sheet: all subdivisions, all dwellings."""
    centre = trimmed(F.get(cells, F.lit(1)))
    return (
        (F.get(cells, F.lit(2)) == "Total")
        & (F.get(cells, F.lit(3)) == "Total")
        & has_text(centre)
        & (centre != "Total")
    )


def survey_kind(sheet: Column, title_has_vacancy: Column, title_has_rent: Column) -> Column:
    """What a rental sheet holds, from its name and from words in its title."""
    return (
        F.when(sheet == OCCUPIED_SHEET, F.lit("occupied_rent"))
        .when(sheet.startswith("CSD") & title_has_vacancy, F.lit("vacancy"))
        .when(sheet.startswith("CSD") & title_has_rent, F.lit("rent"))
    )


def or_no_data(value: Column) -> Column:
    """A report figure as text; an absent one reads "(no data)"."""
    return F.coalesce(value.cast("string"), F.lit(NO_DATA))


def availability_line(title: Column, low: Column, high: Column, grain: Column) -> Column:
    return F.format_string("%s: %s–%s %s", title, low, high, grain)
