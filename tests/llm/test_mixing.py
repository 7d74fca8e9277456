import re
from collections import Counter, defaultdict

from compare import connect, spark_rows, sql_rows
from odd import empty_docs, frame, odd_docs, odd_texts, rows_of
from pyspark.sql import functions as F
from seriesmart.llm import mixing
from seriesmart.llm.queries import QUERIES, SQL

WORD = re.compile(mixing.WORD)


def brute_targets(sizes):
    """The excess over twice a source's size is reshared until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= 2 * sizes[s]]
        if not over:
            return {**full, **share}
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


def test_targets_and_words_taken(spark):
    got = rows_of(mixing.mix(odd_docs(spark), block=64))
    rows = odd_texts()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets, taken = brute_targets(sizes), Counter()
    for row in got:
        assert row["source_size"] == sizes[row["source"]]
        assert abs(row["target"] - targets[row["source"]]) < 1e-6
        assert 0 <= row["taken"] <= 2 * row["size"]
        taken[row["source"]] += row["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 1
    assert sorted(map(str, got)) == sorted(map(str, rows_of(mixing.mix(odd_docs(spark), block=64))))


def test_each_block_has_one_slot_and_sources_are_spread(spark):
    scratch = mixing.Scratch(spark, "test")
    sources = scratch.stage(mixing.targets(mixing.sized(odd_docs(spark))), "sources")
    slots = rows_of(mixing.schedule(sources, 64))
    ranks = defaultdict(list)
    for slot in slots:
        ranks[slot["number"]].append((slot["slot"], slot["rank"]))
    for row in rows_of(sources):
        own = sorted(ranks.get(row["number"], []))
        assert [rank for _, rank in own] == list(range(-(-row["goal"] // 64)))
    largest = max(rows_of(sources), key=lambda row: row["goal"])
    total = sum(row["goal"] for row in rows_of(sources))
    places = [slot for slot, _ in sorted(ranks[largest["number"]])]
    gaps = [b - a for a, b in zip(places, places[1:])]
    assert max(gaps) <= 3 * total / largest["goal"] + 1  # no long runs without the largest source


def test_mixed_documents_keep_columns_and_follow_the_words(spark):
    docs = odd_docs(spark)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    taken = {r["row"]: r for r in rows_of(mixing.mix(docs))}
    wanted = sum((2 * r["taken"] + r["size"]) // (2 * r["size"]) for r in taken.values() if r["size"])
    assert got.count() == wanted
    assert got.filter(F.col("text").isNull()).count() == 0


def test_spans_come_in_the_order_of_the_schedule(spark):
    spans = rows_of(mixing.scheduled_spans(odd_docs(spark), block=64))
    assert [r["slot"] for r in spans] == sorted(r["slot"] for r in spans)
    taken, held = Counter(), Counter()
    for r in spans:
        taken[r["row"]] += r["words"]
        held[r["source"], r["rank"]] += r["words"]
        assert r["first_word"] >= 0 and r["words"] > 0
    assert dict(taken) == {r["row"]: r["taken"] for r in rows_of(mixing.mix(odd_docs(spark), block=64)) if r["taken"]}
    assert max(held.values()) == 64


def test_no_source_with_a_target_vanishes(spark):
    """The target of s2 is less than half of its single document."""
    sizes = [1070, 430, 1000, 1070, 430]
    rows = [(at, "e\n f  " * (n // 2), "en", f"s{at}") for at, n in enumerate(sizes)]
    docs = frame(spark, rows)
    taken = {r["doc_id"]: r for r in rows_of(mixing.mix(docs))}
    assert [i for i, r in taken.items() if 0 < 2 * r["taken"] < r["size"]] == [2]
    got = {r["doc_id"]: r["text"] for r in rows_of(mixing.mixed_documents(docs))}
    assert set(got) == set(range(5)) and rows[2][1].startswith(got[2])
    assert len(WORD.findall(got[2])) == taken[2]["taken"]


def test_equals_its_sql(spark, folder):
    name = "op2_source_mix"
    got, want = spark_rows(QUERIES[name](spark, folder)), sql_rows(connect(folder), SQL[name])
    assert got == want


def test_only_dataframe_functions_run(spark, folder):
    plan = QUERIES["op2_source_mix"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty_table(spark):
    assert rows_of(mixing.mix(empty_docs(spark))) == []
    assert mixing.mixed_documents(empty_docs(spark)).count() == 0
