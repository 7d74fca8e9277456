import random
import zlib

import numpy as np
from odd import empty_docs, frame, odd_docs, odd_texts, rows_of, words
from pyspark.sql import functions as F
from seriesmart.llm import toxicity
from seriesmart.llm.queries import QUERIES

INSULTS = ["idiot", "moron", "worthless", "trash"]


def labelled(spark, n=500):
    rows, labels = [], []
    for i in range(n):
        found, toxic = words(i, 60, 5000), int(i % 4 == 0)
        if toxic:
            for at in random.Random(i).sample(range(60), 4):
                found[at] = random.Random(i + at).choice(INSULTS)
        rows.append((i, " ".join(found), "en", f"s{i % 3}"))
        labels.append((i, 1, toxic))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_texts_are_told_apart(spark):
    rows, labels = labelled(spark)
    docs = frame(spark, rows)
    got = rows_of(toxicity.score(docs, toxicity.learn(docs, labels)))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    right = sum((r["doc_id"] % 4 == 0) == bool(r["predicted"]) for r in held)
    assert len(held) > 100 and right / len(held) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)


def test_fixed_phrases_of_different_texts_are_learned(spark):
    """A word that always has the same words in front, and one that starts every text."""
    for phrase, at in (("you are a zorbex", 30), ("grumlin", 0)):
        rows, labels = [], []
        for i in range(500):
            found, toxic = words(i, 60, 5000), int(i % 4 == 0)
            found[at:at] = phrase.split() if toxic else ["you", "are", "a", found[at]] if at else []
            rows.append((i, " ".join(found), "en", "s"))
            labels.append((i, 1, toxic))
        docs = frame(spark, rows)
        models = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        assert models.index.get(phrase.split()[-1].encode(), 0)
        held = [r for r in rows_of(toxicity.score(docs, models)) if r["held_out"]]
        right = sum((r["doc_id"] % 4 == 0) == bool(r["predicted"]) for r in held)
        assert len(held) > 100 and right / len(held) > 0.95


def test_copies_count_once(spark):
    text = "you are a zorbex " + " ".join(words(1, 60, 5000))
    docs = frame(spark, [(i, text, "en", "s") for i in range(60)] + [(100 + i, " ".join(words(i, 60)), "en", "s") for i in range(60)])
    sample = docs.select("text", F.expr("int(doc_id < 100)").alias("label"))
    assert {r["n"] for r in rows_of(toxicity._count(sample).filter("label = 1"))} == {1}


def test_only_training_labels_and_texts_count(spark):
    rows, labels = labelled(spark, 240)
    docs = frame(spark, rows)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    first = {r["doc_id"]: r["score"] for r in rows_of(toxicity.score(docs, toxicity.learn(docs, labels)))}
    second = {r["doc_id"]: r["score"] for r in rows_of(toxicity.score(other, toxicity.learn(other, turned)))}
    assert np.allclose([first[i] for i in first], [second[i] for i in first])


def test_odd_documents_and_labels(spark):
    rows, labels = labelled(spark, 120)
    odd = labels.unionByName(spark.createDataFrame([(1, 0, 1), (None, 1, 1), (4, None, None), (8, 1, 7)], labels.schema))
    models = toxicity.learn(frame(spark, rows), odd)
    got = rows_of(toxicity.score(odd_docs(spark), models))
    assert len(got) == len(odd_texts()) and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (200, 201, 202, 207)}
    assert len(empty) == 1
    assert rows_of(toxicity.score(empty_docs(spark), models)) == []


def test_nothing_to_learn_from(spark):
    _, labels = labelled(spark, 10)
    docs = odd_docs(spark)
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r["score"] for r in rows_of(toxicity.score(docs, toxicity.learn(docs, some)))} == {0.0}
    assert toxicity.learn(empty_docs(spark), labels).weights is None


def test_whole_table(spark, folder):
    got = QUERIES["op5_toxicity"](spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def by_definition(sample):
    """log p(w | v, toxic) - log p(w | v, ordinary) from plain counts of the texts, as a function."""
    pairs = [{}, {}]  # of each class: (before, word) -> distinct texts
    for label, text in sample:
        found = toxicity.words(text.encode())
        for pair in zip([None, *found], found):
            pairs[label].setdefault(pair, set()).add(tuple(found))
    n = [{pair: len(held) for pair, held in own.items()} for own in pairs]
    kinds = [{w: sum(1 for _, x in own if x == w) for w in {x for _, x in own}} for own in n]
    vocabulary = len(set(kinds[0]) | set(kinds[1])) + 1
    in_pair = {w for own in n for (_, w), k in own.items() if k > toxicity.PAIR_DISCOUNT}

    def known(w):
        return w in in_pair or sum(k.get(w, 0) for k in kinds) >= toxicity.LEAST_COUNT

    def cut(k):
        return min(k, toxicity.CLASS_DISCOUNT)

    freed = [sum(map(cut, k.values())) for k in kinds]

    def unigram(w, c):
        if not known(w):
            return 1 / vocabulary
        shared = sum(cut(k.get(w, 0)) for k in kinds) / max(1, sum(freed))
        return (kinds[c].get(w, 0) - cut(kinds[c].get(w, 0)) + freed[c] * shared) / max(1, sum(kinds[c].values()))

    def probability(v, w, c):
        after = {x: k for (u, x), k in n[c].items() if u == v}
        other = {x: k for (u, x), k in n[1 - c].items() if u == v}
        if not (v is None or known(v)) or sum(after.values()) + sum(other.values()) < toxicity.LEAST_COUNT:
            after = {}
        own = sum(after.values())
        kept = {x: k - toxicity.PAIR_DISCOUNT for x, k in after.items() if k > toxicity.PAIR_DISCOUNT}
        back = 1 - sum(kept.values()) / own if own else 1.0
        return back * unigram(w, c) + (kept.get(w, 0) / own if own and known(w) else 0.0)

    return lambda v, w: np.log(probability(v, w, 1)) - np.log(probability(v, w, 0))


def test_ratios_by_definition(spark):
    pick = random.Random(3)
    sample = []
    for i in range(160):
        found = [pick.choice(words(9, 40, 30)) for _ in range(25)]
        label = int(i % 3 == 0)
        if label:
            at = pick.randrange(20)
            found[at : at + 4] = ["you", "utter", "zorbex", "now"]
        else:
            found[5:7] = ["you", "utter"] if i % 2 else ["my", "friend"]
        if i % 20 == 0:
            found.append(f"rare{i}")
        sample += [(label, " ".join(found))] * pick.choice([1, 1, 2])
    models = toxicity._estimate(toxicity._count(spark.createDataFrame(sample, "label int, text string")))
    ratio = by_definition(sample)
    for _, text in sample[:60] + [(0, "zorbex never seen utter zorbex"), (0, "you utter nonsense")]:
        found = toxicity.words(text.encode())
        assert np.allclose(models.ratios(found), [ratio(v, w) for v, w in zip([None, *found], found)])
