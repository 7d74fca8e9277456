import numpy as np
import pytest
from builders import as_tuples
from pyspark.sql import functions as F

from seriesmart.operators import nearest
from seriesmart.plans import questions
from seriesmart.sources import vectors

LAYOUT = "doc_id long, embedding array<float>"


def clustered(n, seed=1, dims=12, centres=20):
    pick = np.random.default_rng(seed)
    middle = np.random.default_rng(0).standard_normal((centres, dims)) * 3
    return middle[pick.integers(0, centres, n)] + pick.standard_normal((n, dims))


def frames(spark, n=1500, asked=30):
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(n))]
    rows += [(5000 + i, rows[7][1]) for i in range(300)]  # copies
    rows += [(9000, None), (9001, [0.0] * 12), (9002, [1.0, None]), (9003, [1.0]), (9004, [float("nan")] * 12)]
    queries = [(f"q{i}", v.tolist()) for i, v in enumerate(clustered(asked, 2))] + [("zero", [0.0] * 12), ("copy", rows[7][1])]
    return spark.createDataFrame(rows, LAYOUT), spark.createDataFrame(queries, "query_id string, embedding array<float>")


def by_brute_force(docs, queries, k):
    out = []
    held = [(r.doc_id, np.array(r.embedding, float)) for r in docs.collect() if r.embedding and None not in r.embedding]
    for query in queries.collect():
        q = np.array(query.embedding, float)
        scored = []
        for doc_id, v in held:
            if len(v) == len(q) and np.isfinite(v).all() and np.linalg.norm(v) * np.linalg.norm(q):
                scored.append((-round(float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), 6), doc_id))
        out += [(query.query_id, at, doc_id, -score) for at, (score, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return out


def plain(rows):
    return {(q, p): (d, round(s, 5)) for q, p, d, s in rows}


@pytest.mark.parametrize("block_bytes", [questions.QUERY_BYTES, 500])
def test_documents_beside_blocks_of_queries(spark, block_bytes):
    docs, queries = frames(spark)
    got = as_tuples(questions.nearest_documents(docs, queries, 6, block_bytes), "query_id", "position", "doc_id", "score")
    assert plain(got) == plain(by_brute_force(docs, queries, 6))


@pytest.mark.parametrize("parts", [vectors.VECTORS_PER_PART, 40])
def test_exact_search_of_the_index_is_brute_force(spark, tmp_path, monkeypatch, parts):
    monkeypatch.setattr(vectors, "VECTORS_PER_PART", parts)
    monkeypatch.setattr(vectors, "QUERIES_PER_BLOCK", 9)
    docs, queries = frames(spark)
    index = vectors.build(docs, str(tmp_path / "index"), cells=25)
    got = as_tuples(vectors.search(index, queries, 6, probes=1, exact=True), "query_id", "position", "doc_id", "score")
    assert plain(got) == plain(by_brute_force(docs, queries, 6))
    assert index.counts.sum() == 1800


def test_nearest_cells_have_most_of_the_best(spark, tmp_path):
    docs, queries = frames(spark, 3000, 60)
    index = vectors.build(docs, str(tmp_path / "index"))
    wanted = {(q, d) for q, _, d, _ in by_brute_force(docs, queries, 10)}
    found = {(r.query_id, r.doc_id) for r in vectors.search(index, queries, 10, probes=6).collect()}
    assert len(found & wanted) / len(wanted) >= 0.9
    again = vectors.opened(spark, str(tmp_path / "index"))
    assert np.array_equal(np.nan_to_num(again.centres), np.nan_to_num(index.centres))


def test_only_wanted_cells_are_listed(spark, tmp_path):
    docs, _ = frames(spark)
    index = vectors.build(docs, str(tmp_path / "index"), cells=10)
    some = [int(c) for c in np.flatnonzero(index.counts)[:2]]
    files = index.vectors(some).inputFiles()
    assert files and all(any(f"/cell={c}/" in f for c in some) for f in files)
    assert index.vectors(some).count() == index.counts[some].sum()


def test_radius_bounds_what_a_cell_holds(spark, tmp_path):
    docs, queries = frames(spark)
    index = vectors.build(docs, str(tmp_path / "index"), cells=15)
    for query in queries.filter("query_id <> 'zero'").collect():
        q = nearest.unit(np.array([query.embedding], float))[0]
        for row in index.vectors([int(c) for c in np.flatnonzero(index.counts)]).collect():
            angle = np.arccos(np.clip(q @ index.centres[row.cell], -1, 1)) - index.radii[row.cell]
            v = np.array(row.v) / np.linalg.norm(row.v)
            assert q @ v <= np.cos(max(0, angle)) + 1e-6


def test_nothing_to_index_and_nothing_asked(spark, tmp_path):
    docs, queries = frames(spark)
    empty = vectors.build(docs.filter("doc_id >= 9000 AND doc_id < 9002"), str(tmp_path / "none"))
    assert vectors.search(empty, queries, 3, probes=2, exact=True).collect() == []
    index = vectors.build(docs, str(tmp_path / "index"), cells=5)
    assert vectors.search(index, queries.limit(0), 3, probes=2, exact=True).collect() == []
    assert questions.nearest_documents(docs, queries.limit(0), 3).collect() == []
    assert questions.nearest_documents(docs.limit(0), queries, 3).collect() == []
    assert questions.nearest_documents(docs, queries.withColumn("query_id", F.lit(None).cast("string")), 1).count() == 1
