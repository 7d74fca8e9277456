"""Typed layouts of the cell grid, the normalised records and the star schema."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _layout(*fields):
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


CELL_GRID = _layout(
    ("file", StringType(), True),
    ("sheet_idx", IntegerType(), True),
    ("sheet", StringType(), True),
    ("row_idx", LongType(), True),
    ("cells", ArrayType(StringType()), True),
)

DIM_GEOGRAPHY = _layout(
    ("geography_id", IntegerType(), False),
    ("cma_name", StringType(), False),
    ("province", StringType(), False),
    ("cma_code", StringType(), True),
)
DIM_DATE = _layout(
    ("date_id", IntegerType(), False),
    ("year", ShortType(), False),
    ("month", ShortType(), False),
    ("quarter", ShortType(), True),
    ("is_annual", BooleanType(), False),
)
DIM_INDICATOR = _layout(
    ("indicator_id", IntegerType(), False),
    ("indicator_name", StringType(), False),
    ("source", StringType(), False),
    ("unit", StringType(), False),
    ("category", StringType(), False),
    ("frequency", StringType(), False),
)

FACT_MONTHLY = _layout(
    ("geography_id", IntegerType(), False),
    ("date_id", IntegerType(), False),
    ("indicator_id", IntegerType(), False),
    ("value", DecimalType(12, 4), True),
    ("loaded_at", TimestampType(), True),
)
FACT_ANNUAL_INCOME = _layout(
    ("geography_id", IntegerType(), False),
    ("date_id", IntegerType(), False),
    ("income_source", StringType(), False),
    ("age_group", StringType(), False),
    ("sex", StringType(), False),
    ("median_income", DecimalType(12, 2), True),
    ("avg_income", DecimalType(12, 2), True),
    ("num_persons", LongType(), True),
    ("loaded_at", TimestampType(), True),
)
FACT_ANNUAL_INCOME_TENURE = _layout(
    ("geography_id", IntegerType(), False),
    ("date_id", IntegerType(), False),
    ("tenure", StringType(), False),
    ("median_income", DecimalType(12, 2), True),
    ("avg_income", DecimalType(12, 2), True),
    ("loaded_at", TimestampType(), True),
)

MONTHLY_KEY = ["geography_id", "date_id", "indicator_id"]
INCOME_KEY = ["geography_id", "date_id", "income_source", "age_group", "sex"]
TENURE_KEY = ["geography_id", "date_id", "tenure"]

RENTAL_RECORD = _layout(
    ("year", IntegerType(), True),
    ("centre", StringType(), True),
    ("bedroom_type", StringType(), True),
    ("value", DoubleType(), True),
    ("data_type", StringType(), True),
)
RATE_RECORD = _layout(
    ("year", IntegerType(), True),
    ("month", IntegerType(), True),
    ("term", StringType(), True),
    ("rate", DoubleType(), True),
)
CREDIT_RECORD = _layout(
    ("year", IntegerType(), True),
    ("quarter", IntegerType(), True),
    ("indicator_name", StringType(), True),
    ("geography", StringType(), True),
    ("value", DoubleType(), True),
)


def staging(fact):
    """The load layout of a fact table: the same columns without the load time."""
    return StructType([field for field in fact.fields if field.name != "loaded_at"])
