"""Latest row per key, delete-matched, and upsert by key."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in ``order``, ties broken by the other columns.

    An aggregation rather than a ranked window: copies of a hot key are reduced
    before the shuffle instead of being sorted together in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    if not order and len(rest) == 1:  # without a struct the greatest is kept in a hash table, unsorted
        return df.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0])).select(df.columns)
    newest = F.max(F.struct(*order, *rest)).alias("_newest")
    picked = df.groupBy(*keys).agg(newest)
    return picked.select(*(c if c in keys else F.col(f"_newest.{c}") for c in df.columns))


def without_matched(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key does not occur in the batch."""
    return target.join(batch.select(*keys), keys, "left_anti")


def matched(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows that the batch replaces."""
    return target.join(batch.select(*keys), keys, "left_semi")


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """The target with the batch's rows put in place of those with the same key.

    A key may occur many times in the batch; the last in ``order`` wins.
    Running the same batch twice gives the same result.
    """
    fresh = latest_per_key(batch, keys, order or [])
    fresh = fresh.select(*(c for c in fresh.columns if c in target.columns))
    if "loaded_at" in target.columns and "loaded_at" not in fresh.columns:
        fresh = fresh.withColumn("loaded_at", F.current_timestamp())
    return without_matched(target, fresh, keys).unionByName(fresh)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def replay(frames: list[DataFrame]) -> DataFrame:
    """Several loads as one batch, numbered so that a later load wins its keys."""
    numbered = [frame.withColumn("load_no", F.lit(at)) for at, frame in enumerate(frames)]
    return union_all(numbered)


def as_layout(df: DataFrame, layout: StructType) -> DataFrame:
    """Columns in the order and types of a table; absent ones become NULL."""
    return df.select(
        *(
            (F.col(field.name) if field.name in df.columns else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in layout.fields
        )
    )
