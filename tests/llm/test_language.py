import zlib

import numpy as np
from odd import empty_docs, frame, odd_docs, odd_texts, rows_of
from seriesmart.llm import language
from seriesmart.llm.queries import QUERIES
from seriesmart.sources.scratch import Scratch

ENGLISH = "the quick brown fox jumps over the lazy dog and then it runs through the green fields of the county while "
GERMAN = "der schnelle braune fuchs springt über den faulen hund und läuft dann durch die grünen felder während "


def labelled(n=200):
    def text(i):
        found = (GERMAN if i % 3 == 0 else ENGLISH).split()
        pick = np.random.default_rng(i)
        return " ".join(pick.permutation(found)[: 4 + i % 12])

    return [(i, text(i), "de" if i % 3 == 0 else "en", "s") for i in range(n)]


def test_held_out_languages_are_found(spark):
    docs = frame(spark, labelled())
    models = language.learn(docs)
    got = rows_of(language.identify(docs, models))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == ("de" if r["doc_id"] % 3 == 0 else "en") for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_probabilities_add_up_to_one(spark):
    models = language.learn(frame(spark, labelled()))
    signs = sorted({int(k) for k in models.levels[0].keys})
    for context in ([32, 32, 32], [ord(c) for c in "the"], [ord(c) for c in "zzq"]):
        total = np.zeros(len(models.languages))
        for sign in signs:
            total += np.exp(models.log_probabilities(np.array([*context, sign], np.uint64))[0].astype(float))
        unknown = np.exp(models.log_probabilities(np.array([*context, 0x4E00], np.uint64))[0].astype(float))
        assert np.allclose(total + unknown, 1, atol=1e-3)


def test_a_language_with_one_training_document_is_learned(spark):
    rare = [(1000 + i, "quux zonk blarg frim", f"l{i}", "s") for i in range(60)]
    training = {lang for i, _, lang, _ in rare if zlib.crc32(str(i).encode()) % 3 != 1}
    models = language.learn(frame(spark, labelled() + rare))
    assert set(models.languages) == training | {"de", "en"}


def test_one_hot_id_takes_one_place(spark):
    rows = labelled(900) + [(5001, f"the hot one {i}", "en", "s") for i in range(400)] + [(None, "the lost one", "en", "s")] * 9
    with Scratch(spark, "language-test") as scratch:
        got = rows_of(language._sample(frame(spark, rows).repartition(5), 100, scratch))
    by_lang = {lang: [r for r in got if r["lang"] == lang] for lang in ("en", "de")}
    assert {lang: len(found) for lang, found in by_lang.items()} == {"en": 100, "de": 100}
    assert sum(r["text"].startswith("the hot one") for r in got) <= 1
    assert all(sum(r["calibrates"] for r in found) == 25 for found in by_lang.values())
    ids = {t: i for i, t, *_ in rows}
    assert all(zlib.crc32(str(ids[r["text"]]).encode()) % 3 != 1 for r in got)


def test_sample_does_not_depend_on_partitions(spark):
    docs = frame(spark, labelled(700))
    with Scratch(spark, "language-test") as scratch:
        one = sorted(map(str, rows_of(language._sample(docs.coalesce(1), 40, Scratch(spark, "a", scratch.path)))))
        two = sorted(map(str, rows_of(language._sample(docs.repartition(9), 40, Scratch(spark, "b", scratch.path)))))
    assert one == two and len(one) == 80


def by_definition(grams, context, sign, order):
    """Interpolated Kneser-Ney straight from its formula; grams: {4-gram: count}."""
    def counts(n):
        if n == language.ORDER:
            return grams
        found = {}
        for longer in {g[-n - 1 :] for g in (grams if n + 1 == language.ORDER else counts(n + 1))}:
            found[longer[1:]] = found.get(longer[1:], 0) + 1
        return found

    def p(context, n):
        if n == 0:
            return 1 / (len({g[-1] for g in grams}) + 1)
        held = counts(n)
        front = context[len(context) - n + 1 :]
        own = {g: c for g, c in held.items() if g[:-1] == front}
        total = sum(own.values())
        lower = p(context, n - 1)
        if not total:
            return lower
        d = language.DISCOUNT
        return max(own.get((*front, sign), 0) - d, 0) / total + d * len(own) / total * lower

    return p(context, order)


def test_probabilities_by_definition():
    rows = ["abra cadabra", "abc bca cab", "a bad cab drab"]
    grams = {}
    for text in rows:
        own = language.signs(text.encode()).tolist()
        for at in range(len(own) - 3):
            key = tuple(own[at : at + 4])
            grams[key] = grams.get(key, 0) + 1
    keys = np.array([sum(s << (16 * (3 - i)) for i, s in enumerate(g)) for g in grams], np.uint64)
    model = language.estimate(["x"], np.zeros(len(keys), int), keys, np.array(list(grams.values()), float))
    for text in ("abracad", "zab bca", "drab"):
        own = language.signs(text.encode())
        got = model.log_probabilities(own)[:, 0]
        wanted = [by_definition(grams, tuple(own[at : at + 3].tolist()), int(own[at + 3]), 4) for at in range(len(own) - 3)]
        assert np.allclose(np.exp(got.astype(float)), wanted, rtol=1e-4)


def test_odd_documents(spark):
    docs = odd_docs(spark)
    models = language.learn(docs)
    got = rows_of(language.identify(docs, models))
    assert len(got) == len(odd_texts())
    for row in got:
        if row["doc_id"] in (200, 201, 202, 207):
            assert row["lang_pred"] == "und" and row["score"] == 0 and row["rejected"]
        elif row["doc_id"] is not None:
            assert row["lang_pred"] in models.languages
    kept = language.known_documents(docs, models)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r["rejected"] for r in got)
    assert rows_of(language.identify(empty_docs(spark), models)) == []
    assert language.known_documents(empty_docs(spark), models).count() == 0


def test_nothing_to_learn_from(spark):
    nameless = odd_docs(spark).drop("lang").selectExpr("*", "cast(null as string) as lang")
    models = language.learn(nameless)
    assert {r["lang_pred"] for r in rows_of(language.identify(nameless, models))} == {"und"}
    assert language.learn(empty_docs(spark)).languages == []


def test_whole_table(spark, folder):
    got = QUERIES["op10_language"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert got.count() == docs.count()
    right = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang = lang_pred").count()
    assert right > 0.95 * got.filter("held_out").count()
