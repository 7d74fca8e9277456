import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, spark_rows, sql_rows
from odd import CLASHING, empty_docs, frame, odd_docs, odd_texts, rows_of, words
from seriesmart.llm import lexical
from seriesmart.llm.queries import QUERIES, SQL
from seriesmart.sources.scratch import Scratch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def by_definition(docs, items, k=50):
    counted = [(doc_id, Counter(terms_of(text))) for doc_id, text in docs]
    counted = [(doc_id, tf, tf.total()) for doc_id, tf in counted if tf]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(term for _, tf, _ in counted for term in tf)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, tf, n in counted:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in set(terms_of(text))
                if t in tf
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return out


def key(row):
    return tuple((v is None, v or 0) for v in row)


QUERY_TEXTS = [
    (1, " ".join(words(4, 30))),
    (2, "wax WAX wbx! word é ü"),
    (2, "1234 5678 wcx"),
    (3, None),
    (4, ""),
    (None, "a row without an id"),
    (5, "unheard-of"),
    (6, " ".join(words(101, 200))),
]


def items_frame(spark, items=QUERY_TEXTS):
    names = ", ".join(f"{name} string" for name in CLASHING)
    return spark.createDataFrame([(*item, *CLASHING) for item in items], f"item_id long, text string, {names}")


def check(spark, docs, items=QUERY_TEXTS, k=50):
    got = rows_of(lexical.ranked_documents(docs, items_frame(spark, items), k))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got]
    assert sorted(found, key=key) == sorted(by_definition(rows, items, k), key=key)
    return found


def test_odd_documents_by_definition(spark):
    found = check(spark, odd_docs(spark))
    assert {item for item, *_ in found} == {1, 2, 6, None}


@pytest.mark.parametrize("k", [1, 7])
def test_many_small_blocks_ties_and_groups_of_items(spark, monkeypatch, k):
    for name, value in (("BLOCK_DOCS", 5), ("BLOCK_POSTINGS", 300), ("PART_TERMS", 900), ("QUERY_TERMS", 40), ("FIRST_VISIT", 2), ("SLICE_BYTES", 64)):
        monkeypatch.setattr(lexical, name, value)
    rows = [(i, " ".join(words(i % 60, 20 + 13 * (i % 11))), "en", "s") for i in range(300)]
    check(spark, frame(spark, rows + odd_texts()).repartition(6), k=k)


def test_copies_of_a_third_and_one_hot_id(spark):
    hot = " ".join(words(1, 50))
    rows = [(7, hot, "en", "s") for _ in range(200)] + [(i, " ".join(words(i, 60)), "en", "s") for i in range(300)]
    check(spark, frame(spark, rows))


def test_no_documents_no_items_no_terms(spark):
    assert rows_of(lexical.ranked_documents(empty_docs(spark), items_frame(spark))) == []
    assert rows_of(lexical.ranked_documents(odd_docs(spark), items_frame(spark, []))) == []
    nothing = frame(spark, [(1, "!! ??", "en", "s"), (2, None, "en", "s")])
    assert rows_of(lexical.ranked_documents(nothing, items_frame(spark))) == []


def test_bands_grow_with_length_and_are_few():
    numbers = sorted({n + d for p in range(40) for n in (1 << p, 3 << p, 15 << p) for d in (-1, 0, 1) if n + d > 0})
    bands = [lexical.band(n) for n in numbers]
    assert bands == sorted(bands) and len(set(bands)) < 16 + 8 * 44


def test_terms_of_slices(monkeypatch):
    text = "Ab1 é🙂x--\x7f_b AB1\n" * 40 + "lastß"
    whole = lexical.term_counts(text.encode())
    assert whole == Counter(t.encode() for t in terms_of(text))
    for some in (text, "", "a", "!", "!a", "a!é", "🙂"):
        assert lexical.term_total(some.encode()) == len(terms_of(some))
    for size in (1, 7, 100):
        monkeypatch.setattr(lexical, "SLICE_BYTES", size)
        assert lexical.term_counts(text.encode()) == whole


def test_strata_below_the_threshold_are_not_visited():
    """A block of two strata: the long documents cannot reach what the short ones have."""
    ids = list(range(300))
    m = [60] * 200 + [900] * 100
    rows = lexical.index_block(0, ids, m, [np.array([9], np.uint64)] * 300, [np.array([3], np.uint32)] * 300)
    block = lexical.Block(rows.column("ids")[0], rows.column("normalisers")[0])
    block.raw[9] = (rows.column("docs")[1].as_py(), rows.column("groups")[1].as_py())
    groups = np.frombuffer(block.raw[9][1], "<u4").reshape(-1, 3)
    assert groups.tolist() == [[0, 3, 200], [1, 3, 100]]
    top, seen = lexical.Top(50), []
    own_add = top.add
    top.add = lambda scores, found, missing: (seen.append(len(found)), own_add(scores, found, missing))
    block.search([(9, 1000)], top)
    assert seen == [200] and top.ids.tolist() == list(range(50))


def test_impacts_are_whole_numbers():
    tf, m = np.array([1, 2, 5_000_000]), np.array([50, 51, 10**9])
    assert lexical.impacts(tf, m).tolist() == [(10**9 * t) // (1000 * t + 20 * n) for t, n in zip(tf.tolist(), m.tolist())]


def test_an_index_serves_many_searches(spark):
    docs = odd_docs(spark)
    with Scratch(spark, "lexical-test") as scratch:
        index = lexical.build_index(docs, scratch)
        again = lexical.search(index, items_frame(spark), scratch, 5)
        assert spark_rows(again) == spark_rows(lexical.ranked_documents(docs, items_frame(spark), 5))
        heads = index.postings.filter("term IS NULL").toArrow()
        assert sum(len(ids) for ids in heads.column("ids").to_pylist()) == index.n_docs
        assert isinstance(heads, pa.Table)


def test_equals_its_sql(spark, folder):
    name = "op11_lexical"
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(connect(folder), SQL[name])
