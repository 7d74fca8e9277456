"""Vectors at rest in cells around centres, searched by the nearest cells or exactly.

The centres are fitted on a bounded sample; every vector is written to the partition of its nearest
centre. Each cell knows its centre and its radius, the widest angle to it, which bounds what a query can
find there. So the nearest cells give most of the best documents, and from the scores found
there the bounds tell which other cells must be read to have them all.
"""

from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from seriesmart.operators import nearest
from seriesmart.sources.scratch import Scratch

SAMPLE_VECTORS = 16_384  # fit the centres
MOST_CELLS = 4_096
ROUNDS = 12
VECTORS_PER_PART = 1 << 16  # of a cell, for one task
QUERIES_PER_BLOCK = 1 << 12
SLACK = 1e-5  # scores have six digits; angles of equal vectors are inexact


@dataclass(frozen=True)
class Cells:
    """The index under a folder: ``vectors`` by cell, and the cells themselves."""

    spark: SparkSession
    root: str
    centres: np.ndarray
    radii: np.ndarray
    counts: np.ndarray

    def vectors(self, cells: list[int]) -> DataFrame:
        """``doc_id, v, cell`` of some cells; the others' partitions are not listed."""
        layout = "doc_id long, v array<double>, cell int"
        if not cells:
            return self.spark.createDataFrame([], layout)
        paths = [f"{self.root}/vectors/cell={cell}" for cell in cells]
        return self.spark.read.schema(layout).option("basePath", f"{self.root}/vectors").parquet(*paths)


def fitted(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of length 1 by spherical k-means; those of empty cells start again from the worst fitting vectors."""
    pick = np.random.default_rng(5)
    centres = sample[np.sort(pick.choice(len(sample), min(cells, len(sample)), replace=False))].copy()
    for _ in range(ROUNDS):
        near = sample @ centres.T
        own = near.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        empty = np.bincount(own, minlength=len(centres)) == 0
        if empty.any():
            sums[empty] = sample[np.argsort(near.max(axis=1))[: empty.sum()]]
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def build(documents: DataFrame, root: str, cells: int | None = None, sample: int = SAMPLE_VECTORS) -> Cells:
    """Writes an index of all usable ``documents`` (doc_id, embedding) below ``root``, which must be new.

    All vectors have the number of components of most; others, and those that are null, hold null or
    non-finite components, or have length 0, have no direction and are left out. The centres come from the
    ``sample`` vectors with the lowest hashes; there are as many cells as the root of the number of vectors,
    at most MOST_CELLS. Cells hold their vectors in files of bounded size, whatever their number.
    """
    spark = documents.sparkSession
    rows = nearest.usable(documents, F.col("embedding"), F.col("doc_id").cast("long").alias("doc_id"))
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = rows.filter((length > 0) & (length < float("inf")))
    sizes = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "dims").first()
    if most is None:
        return _stored(spark, root, np.zeros((0, 0)), [])
    rows = rows.filter(F.size("v") == most["dims"])
    chosen = rows.orderBy(F.xxhash64("doc_id"), F.xxhash64("v")).limit(sample).toArrow().column("v").combine_chunks()
    held = nearest.unit(chosen.flatten().to_numpy().reshape(-1, most["dims"]))
    centres = fitted(held, cells or min(MOST_CELLS, ceil(sqrt(most["n"]))))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                own = nearest.unit(batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1))
                near = own @ shared.value.T
                cell = near.argmax(axis=1)
                cosine = near[np.arange(len(cell)), cell]
                columns = [*batch.columns, pa.array(cosine), pa.array(cell.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "v", "cosine", "cell"])

    dealt = rows.mapInArrow(assign, "doc_id long, v array<double>, cosine double, cell int")
    dealt.hint("rebalance", F.col("cell")).write.partitionBy("cell").parquet(f"{root}/vectors")
    written = spark.read.parquet(f"{root}/vectors").groupBy("cell").agg(F.min("cosine"), F.count("*"))
    return _stored(spark, root, centres, [tuple(row) for row in written.collect()])


def _stored(spark: SparkSession, root: str, centres: np.ndarray, found: list[tuple[int, float, int]]) -> Cells:
    rows = [(cell, centres[cell].tolist(), float(np.arccos(np.clip(least, -1, 1))), n) for cell, least, n in found]
    layout = "cell int, centre array<double>, radius double, n long"
    spark.createDataFrame(rows, layout).coalesce(1).write.parquet(f"{root}/cells")
    return opened(spark, root)


def opened(spark: SparkSession, root: str) -> Cells:
    rows = sorted(spark.read.parquet(f"{root}/cells").collect())
    width = max((row["cell"] for row in rows), default=-1) + 1
    centres = np.full((width, len(rows[0]["centre"]) if rows else 0), np.nan)
    radii, counts = np.zeros(width), np.zeros(width, np.int64)
    for row in rows:
        centres[row["cell"]], radii[row["cell"]], counts[row["cell"]] = row["centre"], row["radius"], row["n"]
    return Cells(spark, root, centres, radii, counts)


def _wanted(index: Cells, queries: DataFrame, probes: int, least: DataFrame | None) -> DataFrame:
    """``query_id, v, cell``: the cells that a query reads.

    The ``probes`` whose centres are nearest; or, given what each query has found in these as its k-th
    score, all others whose bound reaches that.
    """
    shared = index.spark.sparkContext.broadcast((index.centres, index.radii, index.counts > 0))
    asked = queries.withColumn("least", F.lit(None).cast("double")) if least is None else queries.join(least, "query_id", "left")
    further = least is not None

    def run(batches):
        centres, radii, held = shared.value
        for batch in batches:
            ids, vectors, reach = (batch.column(name) for name in ("query_id", "v", "least"))
            for places, own, matrix in nearest.by_size(ids, vectors):
                if matrix.shape[1] != centres.shape[1] or not held.any():
                    continue
                cosines = np.where(held, np.nan_to_num(nearest.unit(matrix) @ np.nan_to_num(centres).T, nan=-2.0), -3.0)
                order = np.argsort(-cosines, axis=1, kind="stable")
                first = np.zeros(cosines.shape, bool)
                np.put_along_axis(first, order[:, :probes], True, axis=1)
                chosen = first & held
                if further:
                    angle = np.maximum(0, np.arccos(np.clip(cosines, -1, 1)) - radii)
                    floor = reach.take(pa.array(places)).fill_null(-2.0).to_numpy()
                    chosen = (np.cos(angle) + SLACK >= floor[:, None]) & held & ~first
                at, cell = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(at)), vectors.take(pa.array(places[at])), pa.array(cell.astype(np.int32))],
                    names=["query_id", "v", "cell"],
                )

    return asked.select("query_id", "v", "least").mapInArrow(run, "query_id string, v array<double>, cell int")


def _searched(index: Cells, wanted: DataFrame, k: int) -> DataFrame:
    """The best of each part of each cell, for blocks of the queries that read it."""
    asking = {row["cell"]: row["count"] for row in wanted.groupBy("cell").count().collect()}  # at most MOST_CELLS
    sizes = [(cell, ceil(int(index.counts[cell]) / VECTORS_PER_PART), ceil(n / QUERIES_PER_BLOCK)) for cell, n in asking.items()]
    dealt = index.spark.createDataFrame(sizes, "cell int, parts long, blocks long")
    of = lambda column, n: F.pmod(F.xxhash64(column), F.col(n))
    every = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1)"))
    none = F.lit(None)
    left = wanted.join(dealt, "cell").select(
        "cell", every("parts").alias("part"), of("query_id", "blocks").alias("block"),
        F.lit(0).alias("side"), "query_id", none.cast("long").alias("doc_id"), "v",
    )
    right = index.vectors(list(asking)).join(dealt, "cell").select(
        "cell", of("doc_id", "parts").alias("part"), every("blocks").alias("block"),
        F.lit(1).alias("side"), none.cast("string").alias("query_id"), "doc_id", "v",
    )
    group = ["cell", "part", "block"]

    def run(batches):
        held, asked, best, done = None, [], None, []
        for batch in batches:
            keys = np.stack([batch.column(name).to_numpy().astype(np.int64) for name in (*group, "side")], axis=1)
            starts = np.flatnonzero((np.diff(keys, axis=0, prepend=keys[:1] - 1) != 0).any(axis=1))
            for start, end in zip(starts, [*starts[1:], len(keys)]):
                *own, side = keys[start].tolist()
                part = batch.slice(start, end - start)
                if own != held:
                    done += [row for one in (best or {}).values() for row in one.rows()]
                    held, asked, best = own, [], None
                if side == 0:
                    asked.append(part.select(["query_id", "v"]))
                    continue
                if best is None:
                    best = nearest.asked(pa.Table.from_batches(asked), k) if asked else {}
                for _, ids, matrix in nearest.by_size(part.column("doc_id"), part.column("v")):
                    if matrix.shape[1] in best:
                        best[matrix.shape[1]].see(ids.to_numpy(zero_copy_only=False), matrix)
            yield nearest.as_batch(done)
            done = []
        yield nearest.as_batch([row for one in (best or {}).values() for row in one.rows()])

    return left.unionByName(right).repartition(*group).sortWithinPartitions(*group, "side").mapInArrow(run, nearest.FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return found.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= k)


def search(
    index: Cells, queries: DataFrame, k: int, probes: int, exact: bool = False, scratch: str | None = None
) -> DataFrame:
    """``query_id, position, doc_id, score``: the k best by cosine, of the ``probes`` nearest cells or exactly.

    ``queries`` has (query_id, embedding), ids told apart; scores have six digits, ties go to the smaller doc_id. With ``exact``
    a second step reads the cells whose bound reaches the k-th score that the first step found, so the outcome
    is that of comparing everything. A cell of any size is dealt in parts of bounded size, and so are its queries.
    """
    kind = queries.schema["query_id"].dataType
    with_vectors = nearest.usable(queries, F.col("embedding"), F.col("query_id").cast("string").alias("query_id"))
    run = Scratch(index.spark, "vector-search", scratch)
    asked = run.stage(with_vectors, "queries")
    first = run.stage(_searched(index, run.stage(_wanted(index, asked, probes, None), "first-cells"), k), "first")
    found = first
    if exact:
        best = _ranked(first, k).groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
        least = best.filter(F.col("n") == k).select("query_id", "least")
        further = run.stage(_wanted(index, asked, probes, least), "further-cells")
        found = first.unionByName(_searched(index, further, k))
    return _ranked(found, k).select(F.col("query_id").cast(kind).alias("query_id"), "position", "doc_id", "score")
