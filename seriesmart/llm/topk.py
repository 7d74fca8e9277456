"""Exact top-k search by inner product over vectors bucketed by length."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesmart.sources.scratch import Scratch

BUCKET_VECTORS = 1024
QUERY_BLOCK = 256
SLAB_VECTORS = 16 * BUCKET_VECTORS
GROUP_QUERIES = 16 * QUERY_BLOCK
LEVELS_PER_DOUBLING = 8  # of length, where query groups meet slabs
FOCUS = 3  # coordinates that prune
DENSE = 0.1  # share of a block's pairs from which all are multiplied
PACKED = "part int, first long, n int, high double, low double, dims int, ids binary, vectors binary, least binary"
FOUND = "query_id long, vec_id long, score long"
EXACT_FLOAT, EXACT_LONG = 2.0**53, 2.0**62
NO_BOUND = -(1 << 63)
SLACK = 1e-9


class Pack(NamedTuple):
    """Vectors as one matrix, shorter ones filled up with zeros."""

    ids: np.ndarray
    dims: int
    vectors: np.ndarray


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``v`` (floor of scale times each component) and its length.

    Rows whose vector is null or holds a null, NaN or infinite component are left out. A component that
    is too large for a whole number of 64 bits fails.
    """
    value = F.col("embedding")
    too_large = F.raise_error(F.lit("a component times the scale exceeds 64 bits")).cast("long")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.filter(value.isNotNull() & ~bad)
        .select(
            F.col("vec_id").cast("long"),
            F.transform(
                value,
                lambda x: F.when(F.abs(x.cast("double") * scale) < 2.0**63, F.floor(x.cast("double") * scale).cast("long")).otherwise(too_large),
            ).alias("v"),
        )
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))
    )


def _stacked(vectors: list[np.ndarray]) -> np.ndarray:
    matrix = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for at, vector in enumerate(vectors):
        matrix[at, : len(vector)] = vector
    return matrix


def _packed(rows: DataFrame, by: str, size: int) -> DataFrame:
    """Rows of ``size`` vectors at most, in the order in which they come, as matrices.

    ``part`` and ``first`` say where the first of them stands; ``high`` and ``low`` are the ends of
    the column ``by``.
    """

    def run(batches):
        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                rows = batch.slice(start, size)
                matrix = _stacked([x.values.to_numpy() for x in rows.column("v")])
                ids = rows.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
                key = rows.column(by).to_numpy(zero_copy_only=False)
                least = rows.column("least").to_numpy(zero_copy_only=False).astype(np.int64)
                values = [part, first, len(ids), key.max(), key.min(), matrix.shape[1], ids.tobytes(), matrix.tobytes(), least.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value], field.type) for value, field in zip(values, schema)], schema=schema
                )
                first += len(ids)

    schema = pa.schema(
        [("part", pa.int32()), ("first", pa.int64()), ("n", pa.int32()), ("high", pa.float64()), ("low", pa.float64())]
        + [("dims", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("least", pa.binary())]
    )
    return rows.mapInArrow(run, PACKED)


def _dealt(packs: DataFrame, size: int, name: str) -> DataFrame:
    """Packs with the number of the run of ``size`` successive vectors that they begin in.

    Only the sizes of the written partitions, one row for each, are added up in one task.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = packs.groupBy("part").agg(F.sum("n").alias("rows"))
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return packs.join(starts, "part").withColumn(name, F.expr(f"(start + first) div {size}")).drop("start")


def _matrix(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, np.int64) if len(row.ids) else np.zeros(0, np.int64)
    values = np.frombuffer(row.vectors, np.int64) if row.dims else np.zeros(0, np.int64)
    return ids, values.reshape(len(ids), row.dims)


def _recut(rows: pd.DataFrame, size: int) -> Iterator[tuple[Pack, np.ndarray]]:
    """The vectors of several packs, in their order, in packs of ``size``, with the bounds of each vector."""
    rows = rows.sort_values(["part", "first"])
    parts = [_matrix(row) for row in rows.itertuples()]
    dims = max(vectors.shape[1] for _, vectors in parts)
    ids = np.concatenate([ids for ids, _ in parts])
    vectors = np.zeros((len(ids), dims), np.int64)
    start = 0
    for own, matrix in parts:
        vectors[start : start + len(own), : matrix.shape[1]] = matrix
        start += len(own)
    least = np.frombuffer(b"".join(rows["least"]), np.int64)
    for start in range(0, len(ids), size):
        cut = slice(start, start + size)
        yield Pack(ids[cut], dims, vectors[cut]), least[cut]


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products: as floats while they stay below 2**53, as integers, or as long ones.

    A product that 64 bits cannot hold fails.
    """
    dims = min(queries.shape[1], vectors.shape[1])
    if not dims or not len(vectors) or not len(queries):
        return np.zeros((len(queries), len(vectors)), np.int64)
    most = np.abs(queries.astype(float)).max() * np.abs(vectors.astype(float)).max() * dims
    kind = np.float64 if most < EXACT_FLOAT else np.int64 if most < EXACT_LONG else object
    found = queries[:, :dims].astype(kind) @ vectors[:, :dims].astype(kind).T
    if kind is object and any(abs(int(x)) >= 1 << 63 for x in found.flat):
        raise OverflowError("an inner product exceeds 64 bits")
    return found.astype(np.int64)


class Queries:
    """A block of queries with the score that each of their products must reach."""

    def __init__(self, pack, least: np.ndarray):
        self.ids, self.vectors = _matrix(pack)
        self.norms = np.sqrt((self.vectors.astype(float) ** 2).sum(axis=1))
        self.least = least


class Bucket:
    """Vectors of about one length, with what pruning needs."""

    def __init__(self, row):
        self.ids, self.vectors = _matrix(row)
        self.norms = np.sqrt((self.vectors.astype(float) ** 2).sum(axis=1))
        self.longest = float(self.norms.max())
        with np.errstate(divide="ignore", invalid="ignore"):
            self.directions = np.nan_to_num(self.vectors / self.norms[:, None]).T.copy()

    def reached(self, queries: np.ndarray, norms: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which products of queries (rows) and vectors (columns) may reach each query's ``least``.

        The local cosine threshold is ``least / (norm * longest)``. Above 1 nothing can reach
        it. From 0.3 on the query's largest coordinates prune, each with the interval in
        which a vector with that cosine must lie; below, only the vectors' lengths do.
        """
        keep = np.zeros((len(queries), len(self.ids)), bool)
        least = least.astype(float)
        loose = (least <= 0) | (norms == 0) | (self.longest == 0)
        keep[loose] = True
        local = np.where(loose, 0.0, least / np.where(loose, 1.0, norms * self.longest))
        by_length = ~loose & (local < 0.3)
        keep[by_length] = self.norms * norms[by_length, None] >= least[by_length, None] * (1 - SLACK)
        rows = np.flatnonzero(~loose & (local >= 0.3) & (local <= 1 + SLACK))
        if not len(rows):
            return keep
        asked, cosine = queries[rows], np.minimum(local[rows], 1.0)
        inside = np.ones((len(rows), len(self.ids)), bool)
        for focus in np.argsort(-np.abs(asked.astype(float)), axis=1)[:, :FOCUS].T:
            known = focus < len(self.directions)
            q = asked[np.arange(len(rows)), focus] / norms[rows]
            spread = np.sqrt(np.maximum(0.0, (1 - cosine * cosine) * (1 - q * q)))
            low = np.where(known & (q > -cosine), q * cosine - spread, -1.0) - SLACK
            high = np.where(known & (q < cosine), q * cosine + spread, 1.0) + SLACK
            if len(self.directions):
                values = self.directions[np.where(known, focus, 0)]
                inside &= (values >= low[:, None]) & (values <= high[:, None])
        keep[rows] = inside
        return keep

    def candidates(self, query: np.ndarray, norm: float, least: float) -> np.ndarray:
        """Places of all vectors whose product with one query may reach ``least``."""
        return np.flatnonzero(self.reached(query[None], np.array([norm]), np.array([least]))[0])


def _verified(queries: Queries, bucket: Bucket, keep: np.ndarray, bound: np.ndarray):
    """Query places, vector places and exact products of the kept pairs that reach their bound."""
    asked, held = np.flatnonzero(keep.any(axis=1)), np.flatnonzero(keep.any(axis=0))
    if not len(asked):
        return (np.zeros(0, np.int64),) * 3
    kept = keep[np.ix_(asked, held)]
    if kept.mean() >= DENSE:
        products = _products(queries.vectors[asked], bucket.vectors[held])
        q, v = np.nonzero(kept & (products >= bound[asked, None]))
        return asked[q], held[v], products[q, v]
    found = []
    for q in asked:
        v = np.flatnonzero(keep[q])
        products = _products(queries.vectors[q : q + 1], bucket.vectors[v])[0]
        good = products >= bound[q]
        found.append((np.full(good.sum(), q), v[good], products[good]))
    return tuple(np.concatenate(column) for column in zip(*found))


def _best(queries: Queries, buckets: list[Bucket], k: int):
    """Places, ids and scores of each query's k best products that reach its bound; ties by smaller id."""
    at = ids = scores = np.zeros(0, np.int64)
    bound = queries.least.copy()
    for bucket in buckets:
        keep = bucket.reached(queries.vectors, queries.norms, bound) & (queries.ids[:, None] != bucket.ids)
        q, v, products = _verified(queries, bucket, keep, bound)
        if not len(q):
            continue
        at, ids, scores = np.concatenate([at, q]), np.concatenate([ids, bucket.ids[v]]), np.concatenate([scores, products])
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        last = place == k - 1
        bound[at[last]] = scores[last]
        at, ids, scores = at[place < k], ids[place < k], scores[place < k]
    return at, ids, scores


def _bounded(asked: DataFrame, head: Pack, k: int) -> DataFrame:
    """Queries with ``least``, their k-th best product with the longest vectors, and ``reach``: the length
    that a vector needs for it. Without k such products, or where none is positive, every length will do."""

    def run(batches):
        bucket = Bucket(head)
        for batch in batches:
            bounds = []
            for start in range(0, batch.num_rows, QUERY_BLOCK):
                rows = batch.slice(start, QUERY_BLOCK)
                vectors = _stacked([x.values.to_numpy() for x in rows.column("v")])
                ids = rows.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
                block = Queries(Pack(ids, vectors.shape[1], vectors), np.full(len(ids), NO_BOUND))
                at, _, scores = _best(block, [bucket], k)
                last = np.arange(len(at)) - np.searchsorted(at, at) == k - 1
                least = block.least.copy()
                least[at[last]] = scores[last]
                bounds.append(least)
            if not bounds:
                continue
            least = np.concatenate(bounds)
            norm = batch.column("norm").to_numpy(zero_copy_only=False)
            reach = np.where(least > 0, least / np.where(norm > 0, norm, 1.0), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(least), pa.array(reach)], names=[*batch.schema.names, "least", "reach"]
            )

    return asked.mapInArrow(run, "vec_id long, v array<long>, norm double, least long, reach double")


def _level(length: Column) -> Column:
    """A whole number that grows with the length; -1 for none."""
    return F.when(length >= 1, F.floor(F.log2(length) * LEVELS_PER_DOUBLING).cast("int")).otherwise(-1)


def tiles(slabs: DataFrame, groups: DataFrame) -> DataFrame:
    """``slab, group`` where the longest vector of the slab may reach the threshold of a query of the group.

    ``slabs`` has ``slab, longest``, ``groups`` has ``group, reach``. Groups stand at every level of length from that of
    their reach to that of the longest vector (some 600 at most), slabs at their own, so they meet by equality.
    """
    reach = F.col("reach") * (1 - SLACK)
    top = slabs.agg(_level(F.max("longest"))).first()[0]
    if top is None:
        top = -1
    at_levels = groups.filter(_level(reach) <= top).withColumn("level", F.explode(F.sequence(_level(reach), F.lit(top))))
    met = slabs.withColumn("level", _level(F.col("longest"))).join(at_levels, "level")
    return met.filter(F.col("longest") >= reach).select("slab", "group")


def top_products(vectors: DataFrame, is_query: Column, k: int = 5, root: str | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products of each query.

    Queries are the rows of ``vectors`` for which ``is_query`` holds; candidates are all rows
    but those with the query's own id. Equal scores go to the smaller vec_id; with fewer than
    k candidates all are returned. Vectors that are null or hold null, NaN or infinite
    components take no part; shorter vectors count as filled up with zeros; rows with a null
    id are left out; an id that occurs twice is a query once for each row. Other columns are
    not read. Without rows the result is empty. Products are exact whatever the components; one that 64 bits cannot hold fails.

    All vectors are sorted by length over the cluster, so a slab of 16,384 successive ones, 16 buckets, has
    about one length. A first pass multiplies each query with the bucket of the longest vectors, 1024 of them, which
    every task gets; the k-th best product says how long a vector must be to do better. Queries are sorted by that
    length into groups of 4096, and a group is sent only to the slabs whose longest vector has it. A task has
    one slab and one group, which bounds its memory; there buckets prune by coordinates or length, and what remains is
    verified with exact integers. Tasks return k rows a query.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk", root)
    rows = quantised(vectors).filter("vec_id IS NOT NULL")
    asked = quantised(vectors.filter(is_query)).filter("vec_id IS NOT NULL").select("vec_id", "v", "norm")
    by_length = rows.withColumn("least", F.lit(NO_BOUND)).sort(F.desc("norm"), "vec_id")
    packs = scratch.stage(_packed(by_length, "norm", BUCKET_VECTORS), "buckets")
    longest = _dealt(packs, BUCKET_VECTORS, "bucket").filter("bucket = 0").toPandas()
    if not len(longest):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    head, _ = next(_recut(longest, BUCKET_VECTORS))
    by_reach = _bounded(asked, head, k).sort(F.desc("reach"), "vec_id")
    blocks = scratch.stage(_packed(by_reach, "reach", QUERY_BLOCK), "blocks")
    slabs, groups = _dealt(packs, SLAB_VECTORS, "slab"), _dealt(blocks, GROUP_QUERIES, "group")
    met = scratch.stage(
        tiles(
            slabs.groupBy("slab").agg(F.max("high").alias("longest")),
            groups.groupBy("group").agg(F.min("low").alias("reach")),
        ),
        "tiles",
    )

    def search(blocks: pd.DataFrame, slab: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(slab) and len(blocks):
            buckets = [Bucket(pack) for pack, _ in _recut(slab, BUCKET_VECTORS)]
            for pack, least in _recut(blocks, QUERY_BLOCK):
                at, ids, scores = _best(Queries(pack, least), buckets, k)
                found.append((pack.ids[at], ids, scores))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], columns))).astype("int64")

    left, right = groups.join(met, "group"), slabs.join(met, "slab")
    best = left.groupBy("slab", "group").cogroup(right.groupBy("slab", "group"))
    found = best.applyInPandas(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""
