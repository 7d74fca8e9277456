"""Number parsing and rounding. Bad text becomes NULL, never an error."""

from pyspark.sql import Column, functions as F

from seriesmart.functions.text import trimmed

# Decimal notation only: the JVM would also take "1d" or hexadecimal floats. What is too
# large for a figure column is a number here, and fails the typed load.
DECIMAL_NOTATION = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def safe_double(text: Column) -> Column:
    """Text as a double, or NULL."""
    plain = trimmed(text)
    return F.when(plain.rlike(DECIMAL_NOTATION), plain.try_cast("double"))


def safe_int(text: Column) -> Column:
    """Text as a whole number, or NULL."""
    plain = trimmed(text)
    return F.when(plain.rlike(r"^[+-]?\d+$"), plain.try_cast("int"))


def cleaned_double(text: Column, drop: str = "%$,") -> Column:
    """A figure written with signs such as "1.2%" or "$1,234"."""
    return safe_double(F.translate(text, drop, ""))


def rounded_rate(value: Column) -> Column:
    """Four decimals, halves away from zero."""
    return F.round(value, 4)


def fact_value(value: Column) -> Column:
    return value.cast("decimal(12,4)")


def fact_money(value: Column) -> Column:
    return value.cast("decimal(12,2)")


def whole_count(value: Column) -> Column:
    return F.round(value).cast("bigint")
