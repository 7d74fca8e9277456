"""Tables at rest: yearly partitions, versions that cover several tables, upserts.

A mart is a folder with a folder of ``data`` for each table, and ``published``. A version is one small
manifest, ``published/<number>.json``, which names for every table its schema and the folder of
each year. A new version names new folders for the years that its edits touch and the old ones for the
rest, so it appears at once for all tables, leaves its readers' files alone, and never rewrites a
table. A table may also stand alone: then it is a mart of one table without a name.

Writers do not wait for each other. One that finds its version taken looks what the winner
changed: years that it did not touch itself it takes over as they are; for others it merges its rows
again, with those of the winner.
"""

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from seriesmart.functions.periods import year_of
from seriesmart.operators.clustering import with_z_order
from seriesmart.operators.upsert import latest_per_key, without_matched
from seriesmart.sources import commits
from seriesmart.sources.commits import VersionTaken
from seriesmart.sources.scratch import Scratch

PARTITIONED_BY = ["year"]
SORTED_BY = ["date_id", "geography_id"]
CLUSTERED_BY = ["geography_id", "indicator_id", "date_id"]
ROW_GROUP_BYTES = 16 << 20  # of clustered files, whose row groups are what a filter skips
ALL = ""  # stands for the years of a table that is not partitioned
ALONE = ""  # the name of a table that is no part of a mart
KEPT_VERSIONS = 2
STRAY_AGE = 7 * 24 * 3600  # seconds after which what no version names is a dead writer's
FIRST_YEAR, LAST_YEAR = 1800, 2200
MOST_TRIES = 100


def write_facts(
    df: DataFrame,
    path: str,
    partition_by: list[str] = PARTITIONED_BY,
    sort_by: list[str] = SORTED_BY,
) -> None:
    """Write a fact table partitioned by the year of its date ids, or more finely.

    The rebalance hint gathers each partition into few files and splits one that
    is too large for a task; sorting lets row groups be skipped by date. With
    ``partition_by=["indicator_id", "year"]`` a question about one indicator
    prunes whole partitions; that pays once a partition holds many files.
    """
    yearly = df.withColumn("year", year_of(F.col("date_id")))
    gathered = yearly.hint("rebalance", *(F.col(name) for name in partition_by))
    writer = gathered.sortWithinPartitions(*partition_by, *sort_by).write.partitionBy(*partition_by)
    writer.mode("overwrite").parquet(path)


def write_clustered(
    df: DataFrame, path: str, by: list[str] = CLUSTERED_BY, row_group_bytes: int = ROW_GROUP_BYTES
) -> None:
    """Write a fact table by year, in Z-order of ``by`` inside each year.

    A filter on any of these columns then skips most files and row groups by their least and greatest
    values, where an order by date serves dates only. Files are ranges of the order; rows with one code
    are split between files by the columns themselves, so a city with a third of all rows is many files.
    """
    coded = with_z_order(df.withColumn("year", year_of(F.col("date_id"))), by, "year")
    order = ["year", "_z", *by]
    ranged = coded.repartitionByRange(*order).sortWithinPartitions(*order).drop("_z")
    ranged.write.option("parquet.block.size", row_group_bytes).partitionBy("year").mode("overwrite").parquet(path)


def _place(spark: SparkSession, root: str) -> tuple[str, str]:
    """The mart that a table's folder belongs to, and the table's name in it."""
    mart, _, name = root.rstrip("/").rpartition("/")
    if not commits.numbers(spark, root) and commits.numbers(spark, mart):
        return mart, name
    return root, ALONE


def _root(mart: str, name: str) -> str:
    """The folder of a table; its rows lie in ``data`` below it."""
    return f"{mart}/{name}" if name else mart


def _tables(content: dict) -> dict[str, dict]:
    """Table name to its entry; a manifest without names is of a table alone."""
    return content["tables"] if "tables" in content else {ALONE: content} if content else {}


def held_tables(spark: SparkSession, mart: str) -> dict[str, dict]:
    """The entries of the newest version of a mart."""
    return _tables(commits.newest(spark, mart)[1])


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions of a table that are still held."""
    mart, name = _place(spark, root)
    found = ((number, commits.content(spark, mart, number)) for number in commits.numbers(spark, mart))
    entries = ((number, _tables(content).get(name)) for number, content in found if content is not None)
    return sorted({entry.get("version", number) for number, entry in entries if entry})


def published_version(spark: SparkSession, root: str) -> int:
    """The newest version of a table; 0 if there is none."""
    mart, name = _place(spark, root)
    number, content = commits.newest(spark, mart)
    entry = _tables(content).get(name)
    return entry.get("version", number) if entry else 0


def _mark(by: list[str]) -> str:
    """What the folders of years clustered by these columns begin with."""
    return f"batch=by-{'-'.join(by)}-"


def _years_of(spark: SparkSession, root: str, batch: str) -> dict[str, str]:
    names = commits.names_in(spark, f"{root}/data/{batch}")
    return {name.removeprefix("year="): f"{batch}/{name}" for name in names if name.startswith("year=")}


def _write_years(df: DataFrame, root: str) -> dict[str, str]:
    """Write the rows to a new folder; the folder of each of their years."""
    batch = f"batch={uuid.uuid4().hex}"
    write_facts(df, f"{root}/data/{batch}", sort_by=[name for name in SORTED_BY if name in df.columns])
    return _years_of(df.sparkSession, root, batch)


def _write_clustered_years(df: DataFrame, root: str, by: list[str]) -> dict[str, str]:
    batch = f"{_mark(by)}{uuid.uuid4().hex}"
    write_clustered(df, f"{root}/data/{batch}", by)
    return _years_of(df.sparkSession, root, batch)


def _write_whole(df: DataFrame, root: str) -> dict[str, str]:
    folders = {ALL: f"batch={uuid.uuid4().hex}"}
    df.write.parquet(f"{root}/data/{folders[ALL]}")
    return folders


def _read(spark: SparkSession, root: str, entry: dict, years: set[str] | None = None) -> DataFrame:
    data = f"{root}/data"
    schema = StructType.fromJson(json.loads(entry["schema"]))
    if ALL in entry["folders"]:
        return spark.read.schema(schema).parquet(f"{data}/{entry['folders'][ALL]}")
    wanted = [path for year, path in sorted(entry["folders"].items()) if years is None or year in years]
    yearly = StructType([*schema.fields, StructField("batch", StringType()), StructField("year", IntegerType())])
    if not wanted:
        return spark.createDataFrame([], yearly).drop("batch")
    paths = [f"{data}/{path}" for path in wanted]
    return spark.read.schema(yearly).option("basePath", data).parquet(*paths).drop("batch")


def read_version(spark: SparkSession, mart: str, names: list[str]) -> dict[str, DataFrame]:
    """Several tables as one version of the mart has them; those that it lacks are left out."""
    held = held_tables(spark, mart)
    return {name: _read(spark, _root(mart, name), held[name]) for name in names if name in held}


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The published version of one table; in facts a filter on ``year`` prunes partitions."""
    mart, name = _place(spark, root)
    found = read_version(spark, mart, [name])
    if not found:
        raise FileNotFoundError(f"nothing published under {root}")
    return found[name]


@dataclass
class Edit:
    """A change of one table, from what its years hold.

    ``make`` gets the rows of ``years`` as the base version has them (None if it lacks the table; all rows if
    ``years`` is None) and gives their new rows, or None to leave the table as it is. With
    ``years`` the table is partitioned by them and the others stay; else it is replaced whole.
    An edit whose ``blind`` is set does not look at the rows, so nothing can make it outdated.
    With ``clustered_by`` the years are written in Z-order.
    """

    table: str
    make: Callable[[DataFrame | None], DataFrame | None]
    years: set[str] | None = None
    partitioned: bool = False
    blind: bool = False
    clustered_by: list[str] | None = None
    made: dict | None = field(default=None, repr=False)  # folders and schema, once written
    seen: object = field(default=None, repr=False)  # what the base had for them

    def base(self, entry: dict | None):
        """What the edit depends on, of the table's entry in some version."""
        if self.blind:
            return ()
        folders = entry["folders"] if entry else {}
        return tuple(sorted((y, p) for y, p in folders.items() if self.years is None or y in self.years))

    def prepare(self, spark: SparkSession, mart: str, entry: dict | None) -> None:
        """Writes the new rows, unless that was done on the same base."""
        if self.seen == self.base(entry):
            return
        root = _root(mart, self.table)
        before = None if self.blind or entry is None else _read(spark, root, entry, self.years)
        rows = self.make(before)
        self.made = None
        if rows is not None:
            rows = rows.drop("year") if self.partitioned else rows
            self.made = {"schema": rows.schema.json(), "folders": self.written(rows, root)}
        self.seen = self.base(entry)

    def written(self, rows: DataFrame, root: str) -> dict[str, str]:
        if self.clustered_by:
            return _write_clustered_years(rows, root, self.clustered_by)
        return _write_years(rows, root) if self.partitioned else _write_whole(rows, root)

    def applied(self, entry: dict | None) -> dict | None:
        """The table's entry in the new version; None if it does not change."""
        if self.made is None:
            return None
        version = entry["version"] + 1 if entry else 1
        if entry and self.years is not None:
            return {"schema": entry["schema"], "folders": entry["folders"] | self.made["folders"], "version": version}
        return self.made | {"version": version}


@dataclass(frozen=True)
class Derived:
    """A table made from what a version says of its tables; written again when ``token`` changes."""

    table: str
    token: Callable[[dict[str, dict]], str | None]
    make: Callable[[str], DataFrame]


    def renewed(self, spark: SparkSession, mart: str, tables: dict[str, dict], kept: dict) -> dict | None:
        """The table's entry, if it must change."""
        token, held = self.token(tables), tables.get(self.table)
        if token is None or (held and held.get("token") == token):
            return None
        if (self.table, token) not in kept:
            rows = self.make(token)
            folders = _write_whole(rows, _root(mart, self.table))
            kept[self.table, token] = {"schema": rows.schema.json(), "folders": folders, "token": token}
        return kept[self.table, token]


@dataclass(frozen=True)
class Summary:
    """A table made from another one, year by year; only the years whose folders changed are made again.

    ``make`` gets the rows of these years; what it gives has a ``date_id`` of the same year.
    """

    table: str
    source: str
    make: Callable[[DataFrame], DataFrame]

    def renewed(self, spark: SparkSession, mart: str, tables: dict[str, dict], kept: dict) -> dict | None:
        source, held = tables.get(self.source), tables.get(self.table, {})
        if source is None:
            return None
        made_from = held.get("made_from", {})
        stale = {year: path for year, path in source["folders"].items() if made_from.get(year) != path}
        if not stale:
            return None
        key = (self.table, tuple(sorted(stale.items())))
        if key not in kept:
            rows = self.make(_read(spark, _root(mart, self.source), source, set(stale)).drop("year"))
            kept[key] = {"schema": rows.schema.json(), "folders": _write_years(rows, _root(mart, self.table))}
        folders = held.get("folders", {}) | kept[key]["folders"]
        return {"schema": kept[key]["schema"], "folders": folders, "made_from": source["folders"]}


def commit(
    spark: SparkSession,
    mart: str,
    edits: list[Edit],
    derived: list[Derived | Summary] = (),
    problems: list[Exception] | None = None,
) -> dict[str, int]:
    """Publishes all edits as one version; the new version of each table that changed.

    If another writer was faster, edits of years that it left alone are taken over as written; the
    others are made again on what it published. With ``problems``, an edit that fails is left out
    and reported there, and the others are published.
    """
    left = list(edits)
    kept: dict[tuple, dict] = {}  # what was made for derived tables
    for _ in range(MOST_TRIES):
        number, content = commits.newest(spark, mart)
        before = {name: {"version": number} | entry for name, entry in _tables(content).items()}
        after, changed = dict(before), {}
        for edit in list(left):
            try:
                edit.prepare(spark, mart, after.get(edit.table))
            except Exception as problem:
                if commits.newest(spark, mart)[0] != number:
                    break  # what it read may be gone
                if problems is None:
                    raise
                problems.append(ExceptionGroup(f"load of {edit.table} failed", [problem]))
                left.remove(edit)
                continue
            entry = edit.applied(after.get(edit.table))
            if entry:
                after[edit.table], changed[edit.table] = entry, entry["version"]
        else:
            for table in derived:
                entry, held = table.renewed(spark, mart, after, kept), after.get(table.table)
                if entry:
                    after[table.table] = entry | {"version": held["version"] + 1 if held else 1}
            if after == before:
                return {}
            try:
                next_number = max([0, *commits.numbers(spark, mart)]) + 1
                if commits.newest(spark, mart)[0] != number:
                    continue
                commits.put(spark, mart, next_number, {"tables": after})
            except VersionTaken:
                continue
            remove_unreferenced(spark, mart)
            return changed
    raise VersionTaken(f"{mart}: {MOST_TRIES} other writers were faster")


def publish(spark: SparkSession, df: DataFrame, root: str, partition_by: list[str] = PARTITIONED_BY) -> int:
    """Write ``df`` as a whole new version of a table.

    Facts are partitioned by year; a dimension is given ``partition_by=[]``. A failed attempt leaves
    at most a folder that no manifest names.
    """
    mart, name = _place(spark, root)
    edit = Edit(name, lambda _: df, partitioned=bool(partition_by), blind=True)
    return commit(spark, mart, [edit])[name]


def _clustered_by(entry: dict, by: list[str] | None) -> list[str]:
    held = StructType.fromJson(json.loads(entry["schema"])).fieldNames()
    return by or [name for name in CLUSTERED_BY if name in held]


def unclustered_years(entry: dict, by: list[str] | None = None) -> set[str]:
    """The years of a table that are not in Z-order of these columns."""
    mark = _mark(_clustered_by(entry, by))
    return {year for year, path in entry["folders"].items() if not path.startswith(mark)}


def cluster_published(
    spark: SparkSession, root: str, by: list[str] | None = None, derived: list[Derived | Summary] = ()
) -> int:
    """Puts the years of a table into Z-order that are not yet; the table's version then.

    Without ``by`` the order is that of the columns of CLUSTERED_BY that the table has. An upsert writes the years it
    touches in order of date again, so only these are read and written by the next call. Like every edit this
    is one commit, made again for a year that another writer changes meanwhile. ``derived`` tables are
    renewed in the same commit; else the next load does that for the years that were written.
    """
    mart, name = _place(spark, root)
    entry = held_tables(spark, mart).get(name)
    if entry is None or ALL in entry["folders"]:
        raise ValueError(f"{root} is no table partitioned by year")
    own, years = _clustered_by(entry, by), unclustered_years(entry, by)
    if years:
        edit = Edit(name, lambda rows: rows, years=years, partitioned=True, clustered_by=own)
        commit(spark, mart, [edit], derived)
    return published_version(spark, root)


def touched_years(batch: DataFrame) -> set[str]:
    """The years of a batch; a date outside of FIRST_YEAR to LAST_YEAR fails, so they are few."""
    year = year_of(F.col("date_id"))
    span = batch.agg(F.min(year), F.max(year), F.count("*"), F.count("date_id")).first()
    if span[2] != span[3] or (span[2] and not FIRST_YEAR <= span[0] <= span[1] <= LAST_YEAR):
        raise ValueError(f"dates of the batch are missing or lie outside of {FIRST_YEAR} to {LAST_YEAR}: {span[:2]}")
    return {str(row[0]) for row in batch.select(year).distinct().collect()}


def upsert_edit(
    run: Scratch, table: str, batch: DataFrame, keys: list[str], order: list[str] | None = None
) -> Edit:
    """The upsert of a batch as an edit; only the years it touches are read and written.

    The batch is reduced to one row per key and written once to the scratch folder ``run``, as it is read more than once.
    """
    fresh = latest_per_key(batch, keys, order or []).drop(*(order or []))
    fresh = run.stage(fresh.withColumn("loaded_at", F.current_timestamp()), f"batch-{table}")

    def merged(base: DataFrame | None) -> DataFrame:
        if base is None:
            return fresh
        own = fresh.select(*(name for name in fresh.columns if name in base.columns))
        return without_matched(base.drop("year"), own, keys).unionByName(own)

    return Edit(table, merged, years=touched_years(fresh), partitioned=True)


def upsert_published(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
    scratch: str | None = None,
) -> int:
    """Upsert a batch into one table and publish the outcome; the table's new version."""
    mart, name = _place(spark, root)
    with Scratch(spark, "upsert", scratch) as run:
        return commit(spark, mart, [upsert_edit(run, name, batch, keys, order)]).get(name, 0)


def _folders(content: dict) -> set[tuple[str, str]]:
    return {(name, path) for name, entry in _tables(content).items() for path in entry["folders"].values()}


def remove_unreferenced(
    spark: SparkSession, mart: str, keep: int = KEPT_VERSIONS, stray_age: int = STRAY_AGE
) -> None:
    """Drop manifests but the newest ones, and the years' folders that these do not name.

    Folders that no manifest has named stay, as a writer may be at work, until they
    are ``stray_age`` seconds old.
    """
    every = commits.numbers(spark, mart)
    contents = {number: commits.content(spark, mart, number) for number in every}
    whole = [number for number in every if contents[number] is not None]
    held = {named for number in whole[-keep:] for named in _folders(contents[number])}
    for number in whole[:-keep]:
        for name, path in _folders(contents[number]) - held:
            files, where = commits.files_of(spark, f"{_root(mart, name)}/data/{path}")
            files.delete(where, True)
        commits.drop(spark, mart, number)
    old = int((time.time() - stray_age) * 1000)
    for name in {name for name, _ in held}:
        batches = {path.partition("/")[0] for own, path in held if own == name}
        commits.drop_old(spark, f"{_root(mart, name)}/data", batches, old)
    commits.drop_old(spark, f"{mart}/{commits.FOLDER}/{commits.ASIDE}", set(), old)


def reload_staging(df: DataFrame, path: str) -> DataFrame:
    """Truncate-and-reload: the folder holds exactly this batch afterwards."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
