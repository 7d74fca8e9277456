import math

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows
from odd import rows_of
from pyspark.sql import functions as F
from seriesmart.llm import topk
from seriesmart.llm.queries import QUERIES, SQL


def brute(rows, asked, k):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for i, q in ints:
        if asked(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ints if j != i)[:k]
            out += [(i, at + 1, j, -s) for at, (s, j) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, asked, k):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("norm", F.lit("clash"))
    got = rows_of(topk.top_products(df, F.col("vec_id") % asked == 0, k))
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_against_brute_force_with_ties_and_odd_vectors(spark, scale):
    pick = np.random.default_rng(5)
    rows = [(i, (pick.normal(0, 0.3, 12) * pick.choice([0.2, 1, 3]) * scale).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[4][1]) for i in range(40)]  # a common vector
    rows += [
        (4000, None), (4010, [1.0, None]), (4020, [float("nan")] * 12), (4030, [float("inf")] * 12), (4040, []),
        (4050, [0.0] * 12), (4060, [scale, -scale]), (4070, [scale] * 20), (None, [scale] * 12),
    ]
    assert run(spark, rows, 10, 5) == brute(rows, lambda i: i % 10 == 0, 5)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, -2.0]), (7, [0.1, 0.1])]
    assert run(spark, rows, 50, 5) == brute(rows, lambda i: i % 50 == 0, 5)
    assert run(spark, [], 50, 5) == [] and run(spark, rows[2:], 50, 5) == []


def test_pruning_never_drops_a_candidate():
    class Row:
        ids = np.arange(500).tobytes()
        dims = 8
        vectors = np.random.default_rng(3).integers(-90, 90, (500, 8)).astype(np.int64).tobytes()

    bucket = topk.Bucket(Row)
    for query in np.random.default_rng(4).integers(-90, 90, (40, 8)).astype(np.int64):
        norm = float(np.sqrt((query.astype(float) ** 2).sum()))
        products = bucket.vectors @ query
        for least in np.quantile(products, [0.3, 0.8, 0.99, 1.0]):
            assert set(np.flatnonzero(products >= least)) <= set(bucket.candidates(query, norm, float(least)))


def test_equals_its_sql(spark, folder):
    name = "op4_top_products"
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(connect(folder), SQL[name])


def test_queries_meet_only_slabs_that_are_long_enough(spark, monkeypatch):
    pick = np.random.default_rng(9)
    length = np.repeat([10.0, 3.0, 1.0, 0.3, 0.1], 600) * pick.uniform(0.8, 1, 3000)
    rows = [(i, (v / np.linalg.norm(v) * n).tolist()) for i, (v, n) in enumerate(zip(pick.normal(0, 1, (3000, 4)), length))]
    monkeypatch.setattr(topk, "SLAB_VECTORS", 100)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 20)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    monkeypatch.setattr(topk, "BUCKET_VECTORS", 50)
    seen, tiles = [], topk.tiles
    monkeypatch.setattr(topk, "tiles", lambda s, g: seen.append((s.count(), g.count(), tiles(s, g))) or seen[-1][2])
    assert run(spark, rows, 10, 5) == brute(rows, lambda i: i % 10 == 0, 5)
    slabs, groups, met = seen[0]
    assert slabs == 30 and groups == 15 and met.count() < slabs * groups / 3


def test_tiles_are_those_of_a_comparison_of_all(spark):
    pick = np.random.default_rng(2)
    slabs = [(i, float(x)) for i, x in enumerate([0.0, 1.0, 2.0, *np.exp(pick.uniform(0, 40, 60))])]
    groups = [(i, float(x)) for i, x in enumerate([0.0, 0.5, 1.0, 2.0, slabs[9][1], 1e30, *np.exp(pick.uniform(0, 40, 60))])]
    got = topk.tiles(spark.createDataFrame(slabs, "slab long, longest double"), spark.createDataFrame(groups, "group long, reach double"))
    assert sorted(map(tuple, got.collect())) == [(s, g) for s, n in slabs for g, r in groups if n >= r * (1 - topk.SLACK)]


def test_vectors_without_components_and_one_common_vector(spark):
    rows = [(i, []) for i in range(0, 120, 10)]
    assert run(spark, rows, 50, 5) == brute(rows, lambda i: i % 50 == 0, 5)
    rows = [(i, [1.0, -2.0, 0.5]) for i in range(2500)] + [(2500 + i, [0.01, 0.0, 0.0]) for i in range(500)]
    assert run(spark, rows, 50, 5) == brute(rows, lambda i: i % 50 == 0, 5)


def test_products_of_huge_components_are_exact_or_fail(spark):
    rows = [(0, [3e6, 1e6]), (50, [-3e6, 2e6]), (7, [1e6, 1e6]), (8, [2.0, 1.0])]
    assert run(spark, rows, 50, 5) == brute(rows, lambda i: i % 50 == 0, 5)
    with pytest.raises(Exception, match="exceeds 64 bits"):
        run(spark, [(0, [1e12, 1e12]), (7, [1e12, 1e12])], 50, 5)
