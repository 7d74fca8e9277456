"""Python code that runs inside Spark tasks."""

import sys

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def sent_by_value(module: str) -> None:
    """Send the functions of a module to the executors along with the plan.

    The executors then need no copy of this package (such as --py-files gives).
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def tasks_of_a_shuffle(spark: SparkSession) -> int:
    """For rows that are few and small but slow to decode: one task each, not merged for their size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
