"""Dated snapshots of a table: what changed between two, and what was known when.

A history is a folder with the rows of all snapshots by year, and one manifest
that names, for each day, the folder and the digest of each of its years. A year whose rows are those of an earlier
snapshot is not kept twice, so a snapshot costs what it changes, and two snapshots are compared by
their digests first.
"""

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from seriesmart.functions.periods import year_of
from seriesmart.operators.blocks import last_known
from seriesmart.operators.upsert import latest_per_key
from seriesmart.sources import commits
from seriesmart.sources.commits import VersionTaken
from seriesmart.sources.scratch import Scratch
from seriesmart.sources.tables import MOST_TRIES, _read, _write_years, touched_years

DAYS_PER_BLOCK = 64
KEPT_MANIFESTS = 2


def digests(rows: DataFrame, columns: list[str]) -> dict[str, str]:
    """For each year of the rows, a digest that does not depend on their order.

    The count and two sums of 64-bit hashes, as exact decimals: copies of a row count, and what
    meets are a few numbers per year.
    """
    hashes = [F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)") for seed in (1, 2)]
    sums = [F.sum(column).cast("string") for column in hashes]
    text = F.concat_ws(":", F.count("*").cast("string"), *sums).alias("digest")
    found = rows.groupBy(year_of(F.col("date_id")).alias("year")).agg(text).collect()  # years are few
    return {str(row["year"]): row["digest"] for row in found}


def add_snapshot(
    spark: SparkSession, root: str, day: str, rows: DataFrame, keys: list[str], scratch: str | None = None
) -> list[str]:
    """Keeps the rows of a day (one per key); the years that no earlier snapshot has as they are.

    The rows are written to a scratch folder first; what is new goes from there to the history. The same
    day again takes the place of the first one. Two writers of different days both succeed.
    """
    with Scratch(spark, "snapshot", scratch) as run:
        fresh = run.stage(latest_per_key(rows, keys, []), "rows")
        touched_years(fresh)
        own = digests(fresh, sorted(fresh.columns))
        written: dict[str, str] = {}
        for _ in range(MOST_TRIES):
            number, held = commits.newest(spark, root)
            days = held.get("days", {})
            if held and StructType.fromJson(json.loads(held["schema"])).names != fresh.columns:
                raise ValueError(f"columns differ from those of {root}: {fresh.columns}")
            kept = {(y, e["digest"]): e["folder"] for other in days.values() for y, e in other.items()}
            new = sorted(year for year, digest in own.items() if (year, digest) not in kept)
            if missing := [year for year in new if year not in written]:
                some = fresh.filter(year_of(F.col("date_id")).isin(list(map(int, missing))))
                written |= _write_years(some, root)
            entry = {
                year: {"digest": digest, "folder": kept.get((year, digest)) or written[year]} for year, digest in own.items()
            }
            manifest = {"schema": held.get("schema") or fresh.schema.json(), "days": dict(sorted((days | {day: entry}).items()))}
            if commits.newest(spark, root)[0] != number:
                continue
            try:
                commits.put(spark, root, max([0, *commits.numbers(spark, root)]) + 1, manifest)
            except VersionTaken:
                continue
            for old in commits.numbers(spark, root)[:-KEPT_MANIFESTS]:
                commits.drop(spark, root, old)
            return new
    raise VersionTaken(f"{root}: {MOST_TRIES} other writers were faster")


def _held(spark: SparkSession, root: str) -> dict:
    held = commits.newest(spark, root)[1]
    if not held:
        raise FileNotFoundError(f"no snapshots under {root}")
    return held


def days(spark: SparkSession, root: str) -> list[str]:
    return list(_held(spark, root)["days"])


def _rows(spark: SparkSession, root: str, held: dict, entry: dict[str, dict]) -> DataFrame:
    folders = {year: of["folder"] for year, of in entry.items()}
    return _read(spark, root, {"schema": held["schema"], "folders": folders}).drop("year")


def snapshot(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The rows of one day."""
    held = _held(spark, root)
    return _rows(spark, root, held, held["days"][day])


def _values(columns: list[str], keys: list[str]) -> list[str]:
    return [name for name in columns if name not in keys]


def changes(spark: SparkSession, root: str, before: str, after: str, keys: list[str]) -> DataFrame:
    """``keys, change`` and each value before and after: rows that a snapshot inserts, updates or lacks.

    Only years whose digests differ are read, and joined by key; if none does, no row is. An
    update is a key with any value that differs; null equals null.
    """
    held = _held(spark, root)
    old, new = held["days"][before], held["days"][after]
    differ = {year for year in old.keys() | new.keys() if old.get(year, {}).get("digest") != new.get(year, {}).get("digest")}
    sides = [_rows(spark, root, held, {y: e for y, e in entry.items() if y in differ}) for entry in (old, new)]
    values = _values(sides[0].columns, keys)
    left, right = (
        side.select(*keys, F.struct(*values).alias(name)) for side, name in zip(sides, ("_before", "_after"))
    )
    change = (
        F.when(F.col("_before").isNull(), "insert").when(F.col("_after").isNull(), "vanish").otherwise("update")
    )
    both = left.join(right, keys, "full_outer").filter(~F.col("_before").eqNullSafe(F.col("_after")))
    return both.select(
        *keys,
        change.alias("change"),
        *(F.col(f"_{side}.{name}").alias(f"{name}_{side}") for name in values for side in ("before", "after")),
    )


def revisions(spark: SparkSession, root: str, keys: list[str], width: int = DAYS_PER_BLOCK) -> DataFrame:
    """``keys``, values, ``known_from, known_to``: what each key was said to be, and from which day until which.

    ``known_to`` is the day of the snapshot that said otherwise or left the key out, null if none
    did. Every folder of a year is read once, for all successive snapshots that share it; then runs of
    equal values are joined, in blocks of ``width`` snapshots of a key.
    """
    held = _held(spark, root)
    order = list(held["days"])
    spans: list[list] = []
    last: dict[str, list] = {}
    for at, day in enumerate(order):
        for year, entry in held["days"][day].items():
            span = last.get(year)
            if span and span[1] == entry["folder"] and span[3] == at - 1:
                span[3] = at
            else:
                spans.append([int(year), entry["folder"], at, at])
                last[year] = spans[-1]
    batch = [(folder.partition("/")[0].removeprefix("batch="), year, a, b) for year, folder, a, b in spans]
    shared = spark.createDataFrame(batch, "batch string, year int, _from int, _to int")
    every = _batches(spark, root, held, {folder for _, folder, *_ in spans})
    values = _values(StructType.fromJson(json.loads(held["schema"])).names, keys)
    said = every.join(shared, ["batch", "year"]).select(*keys, F.struct(*values).alias("_said"), "_from", "_to")
    back = last_known(said, {"_prior": F.struct("_to", "_said")}, keys, ["_from"], width, strict=True)
    goes_on = (F.col("_prior._to") + 1 == F.col("_from")) & F.col("_prior._said").eqNullSafe(F.col("_said"))
    starts = F.when(~F.coalesce(goes_on, F.lit(False)), F.struct(F.col("_from").alias("at"), F.col("_said").alias("said")))
    runs = last_known(back, {"_run": starts}, keys, ["_from"], width).groupBy(*keys, "_run").agg(F.max("_to").alias("_to"))
    day = F.array(*map(F.lit, [*order, None]))
    return runs.select(
        *keys,
        *(F.col(f"_run.said.{name}") for name in values),
        _day(day, F.col("_run.at")).alias("known_from"),
        _day(day, F.col("_to") + 1).alias("known_to"),
    )


def _day(named: Column, at: Column) -> Column:
    return F.element_at(named, (at + 1).cast("int"))


def _batches(spark: SparkSession, root: str, held: dict, folders: set[str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(held["schema"])).add("batch", StringType()).add("year", IntegerType())
    if not folders:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/data/{folder}" for folder in sorted(folders)]
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*paths)


def as_known(revised: DataFrame, day: str) -> DataFrame:
    """What the newest snapshot up to a day said."""
    until = F.col("known_to").isNull() | (F.col("known_to") > day)
    return revised.filter((F.col("known_from") <= day) & until).drop("known_from", "known_to")
