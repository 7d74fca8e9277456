import hashlib
import re

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows
from hypothesis import given, settings, strategies as st
from odd import empty_docs, frame, odd_docs, odd_texts, rows_of
from pyspark.sql import functions as F
from seriesmart.llm import infill
from seriesmart.llm.queries import QUERIES, SQL

LONG = "line of a long text\n" * 30_000 + "\n" * 70_000 + "é🙂\n" * 20_000 + "end"


def by_definition(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if text == "" or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def more_texts():
    said = [LONG, "\n", "\n\n\n", "a\nb", "a<P>\nb", "<\nS>\n<S\n>M>", "x <M> y", "<P<S\nP>\n<", "\r\n\r\n", "é\nü\n🙂"]
    return [(1000 + i, text, "en", "s") for i, text in enumerate(said * 3)]


def test_forms_and_digests_by_definition(spark):
    rows = odd_texts() + more_texts()
    got = rows_of(infill.fill_in_middle(frame(spark, rows)).withColumn("back", infill.restored(F.col("form"), F.col("output"))))
    found = sorted((str(r["doc_id"]), r["n"], r["form"], str(r["prefix_chars"]), str(r["middle_chars"]), r["output"], r["back"]) for r in got)
    wanted = [(i, *by_definition(i, text), text or "") for i, text, *_ in rows]
    assert found == sorted((str(i), n, f, str(p), str(m), o, t) for i, n, f, p, m, o, t in wanted)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_rate_and_share(spark):
    rows = [(i, f"a{i}\nb\nc", "en", "s") for i in range(400)]
    got = rows_of(infill.fill_in_middle(frame(spark, rows), seed=3, rate=60, spm_share=20))
    assert [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in sorted(got, key=lambda r: r["doc_id"])] == [
        (i, *by_definition(i, text, 3, 60, 20)) for i, text, *_ in rows
    ]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400_000), st.sampled_from([1, 2, 7, 300, 5000])), max_size=12), st.integers(1, 3))
def test_set_selects_as_a_list_does(spans, step):
    values = sorted({v for start, n in spans for v in range(start, start + n * step, step)})
    found = infill.BoundarySet(np.array(values, np.int64))
    assert len(found) == len(values)
    ranks = range(0, len(values), max(1, len(values) // 97))
    assert [found.select(rank) for rank in ranks] == [values[rank] for rank in ranks]
    if values:
        assert found.select(len(values) - 1) == values[-1]


def test_each_form_of_container():
    pick = np.random.default_rng(5)
    some = np.sort(pick.choice(1 << 16, 300, replace=False)).astype(np.uint16)
    many = np.sort(pick.choice(1 << 16, 30_000, replace=False)).astype(np.uint16)
    run = np.arange(100, 60_000, dtype=np.uint16)
    for low, kind in ((some, infill.ArrayContainer), (many, infill.BitmapContainer), (run, infill.RunContainer)):
        made = infill.container(low)
        assert type(made) is kind
        assert [made.select(at) for at in range(len(low))] == low.tolist()


def test_empty_table(spark):
    got = infill.digests(infill.fill_in_middle(empty_docs(spark)))
    assert rows_of(got) == []
    assert dict(got.dtypes)["n"] == "bigint" and dict(got.dtypes)["form"] == "string"


def test_reruns_and_partitions_agree(spark):
    docs = odd_docs(spark)
    runs = [infill.digests(infill.fill_in_middle(docs.repartition(n))) for n in (1, 7)]
    assert spark_rows(runs[0]) == spark_rows(runs[1])


@pytest.mark.parametrize("name", ["op12_infill"])
def test_equals_its_sql(spark, folder, name):
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(connect(folder), SQL[name])
