"""The best documents for a block of queries, kept while batches of documents pass."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

DIGITS = 6
FOUND = "query_id string, doc_id long, score double"


def usable(df: DataFrame, vector: Column, *columns: Column) -> DataFrame:
    """The columns and ``v``, as doubles, of the rows whose vector is not null, holds no null and is not empty."""
    wanted = df.select(*columns, vector.cast("array<double>").alias("v"))
    return wanted.filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull()))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; one of length 0 becomes NaN, which no score survives."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def by_size(ids: pa.Array, vectors: pa.Array):
    """(places, ids, matrix) of the vectors of each number of components."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        yield places, ids.take(pa.array(places)), values[starts[places][:, None] + np.arange(size)]


class Best:
    """The ``k`` best scores of some queries of one size; ties go to the smaller id."""

    def __init__(self, ids: list, matrix: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, unit(matrix), k
        self.scores = np.full((len(ids), k), -np.inf)
        self.docs = np.zeros((len(ids), k), np.int64)

    def see(self, docs: np.ndarray, matrix: np.ndarray) -> None:
        """One product for all; only queries for which something reaches their k-th are looked at."""
        scores = np.round(self.queries @ unit(matrix).T, DIGITS)
        scores[np.isnan(scores)] = -np.inf
        reached = (scores >= self.scores[:, -1:]) & (scores > -np.inf)
        for at in np.flatnonzero(reached.any(axis=1)):
            new = np.flatnonzero(reached[at])
            own = np.concatenate([self.scores[at], scores[at, new]])
            doc = np.concatenate([self.docs[at], docs[new]])
            order = np.lexsort((doc, -own))[: self.k]
            self.scores[at], self.docs[at] = own[order], doc[order]

    def rows(self):
        """(query id, doc id, score) of what was found."""
        for at, query_id in enumerate(self.ids):
            for doc, score in zip(self.docs[at], self.scores[at]):
                if score > -np.inf:
                    yield query_id, int(doc), float(score)


def asked(block: pa.Table, k: int) -> dict[int, Best]:
    """Queries (query_id, v) by their number of components."""
    found = {}
    if block.num_rows:
        table = block.combine_chunks()
        ids, vectors = (table.column(name).chunk(0) for name in ("query_id", "v"))
        for _, own, matrix in by_size(ids, vectors):
            found[matrix.shape[1]] = Best(own.to_pylist(), matrix, k)
    return found


def as_batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    kinds = [pa.string(), pa.int64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["query_id", "doc_id", "score"])


def stream(documents: DataFrame, block: pa.Table, k: int) -> DataFrame:
    """The best of each task: ``documents`` (doc_id, v) pass where they lie beside one bounded block of queries."""
    shared = documents.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        best = asked(shared.value, k)
        for batch in batches:
            for _, ids, matrix in by_size(batch.column("doc_id"), batch.column("v")):
                if matrix.shape[1] in best:
                    best[matrix.shape[1]].see(ids.to_numpy(zero_copy_only=False), matrix)
        yield as_batch([row for own in best.values() for row in own.rows()])

    return documents.select("doc_id", "v").mapInArrow(run, FOUND)
