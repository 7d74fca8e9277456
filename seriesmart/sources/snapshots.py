"""Which file is the latest: by modification time, or by the period in its name."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart.functions.numbers import safe_int


def list_files(spark: SparkSession, path: str, name_glob: str = "*") -> DataFrame:
    """(path, modificationTime) of the files; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_glob)
    return files.load(path).select("path", "modificationTime")


def latest_by_time(files: DataFrame, series: list[str] | None = None) -> DataFrame:
    """The newest path, per series when columns are given; ties go to the higher name."""
    newest = F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    return files.groupBy(*(series or [])).agg(newest)


def latest_by_name(files: DataFrame, pattern: str, order: list[int]) -> DataFrame:
    """The path with the latest period in its name.

    ``pattern`` has groups for the parts of the period and ``order`` lists them
    from the most significant on, so "12-25" comes before "02-26".
    """
    parts = [safe_int(F.regexp_extract("path", pattern, group)) for group in order]
    fitting = files.filter(F.col("path").rlike(pattern))
    return fitting.agg(F.max_by("path", F.struct(*parts, F.col("path"))).alias("path"))


def folder_of(path: str) -> str:
    """The snapshot folder a file lies in, for snapshots written as folders of parts."""
    return path.rpartition("/")[0]


def one_path(latest: DataFrame) -> str:
    row = latest.first()
    if row is None or row["path"] is None:
        raise FileNotFoundError("no file found; run the ingest first")
    return row["path"]


def newest_snapshot(spark: SparkSession, root: str, name_glob: str = "*.csv") -> str:
    """The newest snapshot under a folder: a file, or a folder whose parts Spark wrote.

    Parts lie in the folder itself or in one below it, such as a dated one.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_glob).option("recursiveFileLookup", True)
    newest = one_path(latest_by_time(files.load(root).select("path", "modificationTime")))
    return folder_of(newest) if newest.rpartition("/")[2].startswith("part-") else newest
