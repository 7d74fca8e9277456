import time

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows
from odd import empty_docs, frame, mutated, odd_docs, odd_texts, rows_of, words
from pyspark.sql import functions as F
from seriesmart.llm import dedup
from seriesmart.llm.components import components
from seriesmart.llm.queries import QUERIES, SQL
from seriesmart.sources.scratch import Scratch


def shingle_set(text, width):
    found = (text or "").encode().lower().split()
    width = min(width, len(found))
    return frozenset(tuple(found[at : at + width]) for at in range(len(found) - width + 1)) if found else frozenset()


def brute_components(rows, width=2):
    sets, parent = [shingle_set(t, width) for _, t, *_ in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, len(sets[i]), least.get(root(i))) for i, (doc_id, *_) in enumerate(rows)]


def test_sizes_of_very_long_documents(spark):
    n, m = F.lit(30_000_000), F.lit(25_000_000)
    assert spark.range(1).select(dedup.sizes_allow(n, m), dedup.sizes_allow(n, F.lit(20_000_000))).first()[:] == (True, False)


def key(row):
    return tuple((v is None, v or 0) for v in row)


def check(spark, rows, width=2):
    got = rows_of(dedup.near_duplicates(frame(spark, rows), width))
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got]
    assert sorted(found, key=key) == sorted(brute_components(rows, width), key=key)
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in got)
    return got


@pytest.mark.parametrize("width", [2, 5])
def test_odd_documents(spark, width):
    check(spark, odd_texts(), width)


def test_chains_and_members_far_from_the_first_of_their_bucket(spark):
    base = words(2, 200, 5000)
    rows = [(500 - i, " ".join(mutated(base, 7 * i, 4 * (i % 9))), "en", "s") for i in range(80)]
    step = words(3, 120, 5000)
    for i in range(12):  # each is like the one before, the ends are not
        rows.append((600 + i, " ".join(step), "en", "s"))
        step = mutated(step, 900 + i, 6)
    check(spark, rows)


def test_distinct_documents_keep_one_of_each_group(spark):
    docs = odd_docs(spark)
    got = dedup.distinct_documents(docs)
    assert got.columns == docs.columns
    rows = odd_texts()
    groups = {c for (_, n, c) in brute_components(rows, 5) if n}
    empty = sum(1 for _, t, *_ in rows if not shingle_set(t, 5))
    assert got.count() == len(groups) + empty


def test_registers_merge_and_estimate():
    a = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 3000).astype(np.uint64))
    left, right = a[:2400], a[600:]
    rows = [dedup.registers(x) for x in (left, right, a)]
    assert np.array_equal(np.maximum(rows[0], rows[1]), rows[2])
    assert abs(dedup.likely_similarity(rows[0], rows[1], len(left), len(right)) - 0.6) < 0.12
    assert dedup.similar(a[:80], a[:100]) and not dedup.similar(a[:79], a[:100])
    one = dedup.registers(a[:1])
    assert len(one) == dedup.REGISTERS and np.isfinite(one.astype(float)).all()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in rows_of(components(edges, Scratch(spark, "test"), "path"))}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_empty_table(spark):
    assert rows_of(dedup.near_duplicates(empty_docs(spark))) == []


def test_equals_its_sql(spark, folder):
    name = "op3_near_duplicates"
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(connect(folder), SQL[name])


def test_rows_of_a_group_are_compared_at_once_and_as_one_by_one():
    """The links are those of a loop over pairs that stops at linked parts."""
    rng = np.random.default_rng(5)
    bases = [np.unique(rng.integers(1, 1 << 62, 60).astype(np.uint64)) for _ in range(4)]
    sets = []
    for at in range(80):
        base = bases[at % 4]
        kept = base[rng.random(len(base)) < 0.93]
        sets.append(np.unique(np.concatenate([kept, rng.integers(1, 1 << 62, int(rng.integers(0, 8))).astype(np.uint64)])))
    rows = [(rep, rep // 3, dedup.registers(found), found) for rep, found in enumerate(sets)]
    group, linked, want, got = dedup._Kept(), set(), [], []
    for row in rows[:50]:
        group.add(*row)
    for rep, part, sketch, found in rows[20:]:
        got += [(other, rep) for other in group.linked_with(part, sketch, found)]
        for other, other_part, other_sketch, whole in rows[:50]:
            parts = frozenset((part, other_part))
            if len(parts) == 1 or parts in linked or 100 * min(len(found), len(whole)) < 80 * max(len(found), len(whole)):
                continue
            likely = dedup.likely_similarity(sketch, other_sketch, len(found), len(whole))
            if likely >= dedup.UNLIKELY and dedup.similar(found, whole):
                want.append((other, rep))
                linked.add(parts)
    assert got == want and len(want) > 20


@pytest.mark.parametrize("sizes", [(1, 1), (5, 4), (4, 5), (1000, 801), (9, 8), (95, 100)])
def test_too_few_equal_registers_are_never_likely(sizes):
    more, less = np.meshgrid(np.arange(dedup.REGISTERS + 1), np.arange(dedup.REGISTERS + 1))
    held = more + less <= dedup.REGISTERS
    more, less = more[held], less[held]
    likely = dedup.likely_similarities(more, less, sizes[0], np.full(len(more), sizes[1]))
    assert (likely[dedup.REGISTERS - more - less < dedup.LEAST_EQUAL] < dedup.UNLIKELY).all()


def test_a_large_group_is_compared_in_little_time():
    """Hundreds of rows beside many, of one size and without a link: no pair takes a call of its own."""
    rng = np.random.default_rng(6)
    sketches = rng.integers(0, 60_000, (1500, dedup.REGISTERS)).astype(np.uint16)
    group, found = dedup._Kept(), np.arange(1, 100, dtype=np.uint64)
    for rep, sketch in enumerate(sketches):
        group.add(rep, rep, sketch, found)
    began = time.process_time()
    for rep, sketch in enumerate(sketches[:300]):
        assert not group.linked_with(10_000 + rep, sketch[::-1].copy(), found)
    assert time.process_time() - began < 10
