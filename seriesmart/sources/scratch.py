"""Written intermediate tables in a folder that the driver and all executors share.

The folder is the one a caller names, else the session's ``spark.checkpoint.dir``,
else a folder under ``spark.sql.warehouse.dir``. It is only ever touched through
Spark's file system, so it may be local, HDFS or an object store.
"""

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Fails on a cluster where neither setting names a folder that its machines share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    where = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    scheme = where.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/_scratch"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of the queries that run inside are removed when each query ends."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """The written tables of one run, under one folder of its own.

    As a context manager it deletes them at the end.
    """

    def __init__(self, spark: SparkSession, name: str, root: str | None = None):
        self.spark = spark
        self.path = f"{root or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *problem) -> None:
        self.remove()

    def stage(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        """Write a table once and read it from there.

        For rows that are costly to make and read more than once. Unlike a cache, the
        written table outlives the executors that made it.
        """
        with shuffles_removed(self.spark):
            df.write.option("compression", codec).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def remove(self, name: str = "") -> None:
        """Delete one table, or all of the run."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
