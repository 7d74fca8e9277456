import zlib

import numpy as np
from odd import empty_docs, frame, odd_docs, odd_texts, rows_of, words
from pyspark.sql import functions as F
from seriesmart.llm import quality
from seriesmart.llm.labelled import labelled_sample
from seriesmart.llm.queries import QUERIES


def text_of(i):
    found = words(i, 40 + i % 50, 5000)
    if i % 5:
        return " ".join(found).capitalize() + "."
    return [" ".join(f"{w.upper()}!!" for w in found), " | ".join(found), " ".join(w + "$%&" for w in found), "same line\n" * 30][i // 5 % 4]


def labelled(spark, n=400):
    rows = [(i, text_of(i), "en", f"s{i % 3}") for i in range(n)]
    return rows, spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(n)], "doc_id long, quality int, toxic int")


def test_held_out_texts_are_told_apart(spark):
    rows, labels = labelled(spark)
    docs = frame(spark, rows)
    model = quality.learn(docs, labels)
    got = rows_of(quality.score(docs, model))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 50 and sum((r["doc_id"] % 5 > 0) == bool(r["predicted"]) for r in held) / len(held) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)
    good = quality.good_documents(docs, model)
    assert good.columns == docs.columns
    assert {r["doc_id"] for r in rows_of(good)} == {r["doc_id"] for r in got if r["predicted"]}


def test_words_alone_can_tell(spark):
    """Texts of the same form: only which of two sets of words they use tells the label."""
    sets = [[f"{c}{d}oru" for c in "bdfgkl" for d in "aeiou"] for c in "x"] + [[f"{c}{d}ami" for c in "bdfgkl" for d in "aeiou"]]

    def text(i):
        pick = np.random.default_rng(i)
        return " ".join(pick.choice(sets[i % 2], 12).tolist() + pick.choice(sets[0] + sets[1], 28).tolist())

    rows = [(i, text(i), "en", "s") for i in range(900)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(900)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    got = [r for r in rows_of(quality.score(docs, quality.learn(docs, labels))) if r["held_out"]]
    good, bad = ([r["score"] for r in got if r["doc_id"] % 2 == label] for label in (1, 0))
    wins = np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])
    assert len(got) > 100 and wins > 0.9, wins
    same = [quality.terms(t)[: quality.KINDS**3] for t in (b"good fine word here", b"evil junk spam text")]
    other = [quality.terms(t)[quality.FORM_TERMS :] for t in (b"good fine word here", b"evil junk spam text")]
    assert np.array_equal(*same) and not np.array_equal(*other)


def test_votes_are_those_of_the_nearest_by_brute_force(spark):
    rows, labels = labelled(spark, 200)
    model = quality.learn(frame(spark, rows), labels)
    for i in (1000, 1001, 1005):
        own = model.project(np.stack([quality.terms(text_of(i).encode())]))[0]
        cosines = model.vectors @ own
        near = sorted(range(len(cosines)), key=lambda j: -cosines[j])[: quality.NEIGHBOURS]
        weights = [max(float(cosines[j]), 1e-3) ** quality.SHARPNESS for j in near]
        score = sum(w * model.labels[j] for w, j in zip(weights, near)) / sum(weights)
        assert abs(score - model.scores(np.stack([quality.terms(text_of(i).encode())]))[0]) < 1e-3


def test_odd_documents_and_nothing_to_learn_from(spark):
    rows, labels = labelled(spark, 120)
    model = quality.learn(frame(spark, rows), labels)
    got = rows_of(quality.score(odd_docs(spark), model))
    assert len(got) == len(odd_texts()) and all(0 <= r["score"] <= 1 for r in got)
    assert rows_of(quality.score(empty_docs(spark), model)) == []
    none = quality.learn(odd_docs(spark), labels.limit(0))
    assert {r["score"] for r in rows_of(quality.score(odd_docs(spark), none))} == {1.0}
    assert len(quality.learn(empty_docs(spark), labels).labels) == 0


def test_the_bound_holds_for_rows_and_is_filled(spark):
    rows = [(i, f"text {i}", "en", "s") for i in range(20)] + [(3, f"other {i}", "en", "s") for i in range(50)]
    labels = spark.range(2000).selectExpr("1000 - id AS doc_id", "int(id % 2) AS quality", "0 AS toxic")
    sample = [rows_of(labelled_sample(frame(spark, some), labels, "quality", F.lit(True), 8)) for some in (rows, rows[::-1])]
    assert sorted(r["label"] for r in sample[0]) == [0] * 8 + [1] * 8
    assert len({r["doc_id"] for r in sample[0]}) == 16
    assert sorted(map(str, sample[0])) == sorted(map(str, sample[1]))


def test_whole_table(spark, folder):
    got = QUERIES["op8_quality"](spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
