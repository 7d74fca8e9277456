"""Runs registered queries beside their SQL and compares the rows, whatever their order."""

import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder):
    database = duckdb.connect()
    for name in TABLES:
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return database


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def spark_rows(df):
    names = sorted(df.columns)
    return names, _sorted([tuple(_plain(row[name]) for name in names) for row in df.collect()])


def sql_rows(database, sql):
    result = database.execute(sql)
    columns = [column[0] for column in result.description]
    names = sorted(columns)
    places = [columns.index(name) for name in names]
    return names, _sorted([tuple(_plain(row[at]) for at in places) for row in result.fetchall()])
