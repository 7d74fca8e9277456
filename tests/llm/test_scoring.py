import math
import zlib
from collections import Counter

import numpy as np
from odd import empty_docs, frame, odd_docs, odd_texts, rows_of, words
from seriesmart.llm import scoring


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b" "]


def training(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


def check(spark, rows):
    got = sorted(rows_of(scoring.score(frame(spark, rows))), key=lambda r: str((r["doc_id"], r["n_tokens"], r["base_score"])))
    counts = Counter(t for i, text, *_ in rows if training(i) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for doc_id, text, *_ in rows:
        own = tokens_of(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        wanted.append((doc_id, not training(doc_id), len(own), sum(counts[t] > 0 for t in own), n, round(base, 6)))
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    found = [(*(r[name] for name in names), round(r["base_score"], 6)) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    assert all(r["score"] < 0 for r in got)
    return got


def test_counts_and_base_scores(spark):
    check(spark, odd_texts())


def test_blocks_of_any_size_give_the_same_scores(spark, monkeypatch):
    first = check(spark, odd_texts())
    monkeypatch.setattr(scoring, "BUCKET_KEYS", 300)
    second = check(spark, odd_texts())
    assert np.allclose([r["score"] for r in first], [r["score"] for r in second])


def test_pairs_help_on_held_out_texts(spark):
    phrases = [" ".join(words(i, 8, 300)) for i in range(40)]
    pick = np.random.default_rng(1)
    rows = [(i, " ".join(phrases[k] for k in pick.integers(0, 40, 12)), "en", "s") for i in range(300)]
    held = [r for r in check(spark, rows) if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.7 * sum(r["base_score"] for r in held)


def test_scores_by_brute_force(spark):
    """The same mixture, computed plainly from weights learned without a histogram."""
    rows = [(i, " ".join(words(i, 60, 50)), "en", "s") for i in range(60)]
    got = {r["doc_id"]: r["score"] for r in rows_of(scoring.score(frame(spark, rows)))}
    one, two, before = Counter(), Counter(), Counter()
    sequences = {i: tokens_of(t) for i, t, *_ in rows}
    for i, own in sequences.items():
        if training(i):
            for v, w in zip([b"", *own], own):
                one[w] += 1
                two[v, w] += 1
                before[v] += 1
    n, kinds = sum(one.values()), len(one)
    weights = {}
    for b in range(scoring.FREQUENCY_BUCKETS):
        cases = [(v, w, c) for (v, w), c in two.items() if scoring.frequency_bucket(np.array([before[v] - 1.0]))[0] == b]
        now = np.full(3, 1 / 3)
        for _ in range(scoring.ROUNDS if cases else 0):
            sums = np.zeros(3)
            for v, w, c in cases:
                left = before[v] - 1
                p = np.array([(two[v, w] - 1) / left if left else 0, (one[w] - 1) / (n - 1), 1 / (kinds + 1)]) * now
                sums += c * p / p.sum()
            now = sums / sums.sum()
        weights[b] = now
    for i, own in sequences.items():
        total = 0.0
        for v, w in zip([b"", *own], own):
            b = scoring.frequency_bucket(np.array([float(before[v])]))[0]
            p = np.array([two[v, w] / max(1, before[v]), one[w] / n, 1 / (kinds + 1)])
            total += math.log10(float(p @ weights[b]))
        assert abs(got[i] - total) < 0.01 * abs(total)


def test_weights_are_mixtures():
    codes = np.array([(b << 24) | (a << 12) | c for b in (0, 3) for a in (0, 2100) for c in (2050, 2080)])
    weights = scoring.mixture_weights(codes, np.arange(1, 9))
    assert np.allclose(weights.sum(axis=1), 1) and (weights >= 0).all() and weights[0, 0] == 0


def test_nothing_to_learn_from(spark):
    held = [i for i in range(100) if not training(i)][:3]
    got = rows_of(scoring.score(frame(spark, [(i, "some words", "en", "s") for i in held])))
    assert [(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got] == [(0, 0, 0.0, 0.0)] * 3
    assert rows_of(scoring.score(empty_docs(spark))) == []
    assert len(rows_of(scoring.score(odd_docs(spark)))) == len(odd_texts())
