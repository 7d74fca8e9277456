"""Toxicity from class-conditional Kneser-Ney word models."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from seriesmart.llm.common import fold, slices, texts
from seriesmart.llm.labelled import labelled_sample, logistic, probability
from seriesmart.sources.scratch import Scratch

FOLDS, HELD_OUT = 3, 1
CLASS_DISCOUNT = 2.0  # counts in one class up to this tell nothing; they go to the shared backoff
PAIR_DISCOUNT = 5.0  # the same for pairs, which go to the class's words
PER_CLASS = 5_000  # bound of the sample that fits the models
CALIBRATION_SHARE = 5
LEAST_COUNT = 2  # words with fewer continuations are like unknown ones
WINDOW = 12
TELLING = 1.5
FEATURES = 3
THRESHOLD = 0.7
BATCH_BYTES = 4 << 20
NO_WORD = np.int64(0)
NOT_ASCII_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
TOXIC, ORDINARY = 1, 0


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters; digits and ASCII signs part words."""
    return text.decode().lower().encode().translate(NOT_ASCII_LETTERS).split()


def word_keys(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)


@dataclass
class Models:
    """Log-likelihood ratios of words and pairs that differ between the classes.

    ``p(w | v, class)`` interpolates discounted counts of the pair in the class with those of
    the word, and these with the counts that both classes share: what the discount took from
    either class is pooled and given back to both. An expression that is rare in one class so
    falls back to the same probability in both, while one that is frequent in a single class
    does not lift the other. A word counts by its Kneser-Ney continuations, how many kinds of
    words stand in front; a pair, the highest order, by the distinct texts of the class that
    have it. So an expression tells as much if it always follows the same words, and copies of
    a document, which bear the same label, count once.
    """

    index: dict[bytes, int]  # hash of a word -> place; 0 is any other word
    start: int  # place of what comes before the first word
    unigram: np.ndarray  # (words, 2) probabilities by continuation
    back: np.ndarray  # (words, 2) weight of the unigram after a word
    pairs: np.ndarray  # sorted place of word before << 32 | place of word
    discounted: np.ndarray  # (pairs, 2) discounted share of the pair
    weights: np.ndarray | None = None

    def ratios(self, found: list[bytes]) -> np.ndarray:
        """log p(word | toxic) - log p(word | ordinary) for each word."""
        places = np.fromiter((self.index.get(w, 0) for w in found), np.int64, len(found))
        before = np.concatenate([[self.start], places[:-1]])
        own = self.unigram[places] * self.back[before]
        if len(self.pairs):
            wanted = before << 32 | places
            at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
            hit = self.pairs[at] == wanted
            own[hit] += self.discounted[at[hit]]
        logs = np.log(own)
        return logs[:, TOXIC] - logs[:, ORDINARY]

    def features(self, text: bytes) -> np.ndarray:
        """The length-normalised log-likelihood ratio, and two of what tells most.

        Most words tell little for either class, but there are many of them. So what the ratios
        have above TELLING is also summed by itself: per word of the text, and in the
        text's densest window.
        """
        found = words(text)
        if not found:
            return np.zeros(FEATURES)
        ratios = self.ratios(found)
        telling = np.concatenate([[0.0], np.cumsum(np.maximum(ratios - TELLING, 0))])
        width = min(WINDOW, len(ratios))
        densest = (telling[width:] - telling[:-width]).max()
        return np.array([ratios.mean(), np.log1p(100 * telling[-1] / len(ratios)), np.log1p(densest)])


def _count(sample: DataFrame) -> DataFrame:
    """``label, before, word, n``: pairs of words and the distinct texts that have them.

    0 stands for what comes before the first word. Texts of the same words are one text.
    """

    def run(batches):
        for batch in slices(batches, BATCH_BYTES):
            parts = {TOXIC: [], ORDINARY: []}
            for text, label in zip(texts(batch), batch.column("label").to_pylist()):
                keys = word_keys(words(text))
                if len(keys):
                    digest = np.uint64(xxhash.xxh3_64_intdigest(keys.tobytes())).view(np.int64)
                    found = np.unique(np.stack([np.concatenate([[NO_WORD], keys[:-1]]), keys]), axis=1)
                    parts[label].append(np.vstack([np.full(found.shape[1], digest), found]))
            for label, found in parts.items():
                if found:
                    rows = np.hstack(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(rows.shape[1], label, np.int32)), *map(pa.array, rows)],
                        names=["label", "digest", "before", "word"],
                    )

    held = sample.select("text", "label").mapInArrow(run, "label int, digest long, before long, word long").distinct()
    return held.groupBy("label", "before", "word").agg(F.count("*").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, root: str | None = None) -> Models:
    """Class-conditional models from at most ``per_class`` training documents of each class.

    Pairs are counted in tasks. The sample and its pairs are written once, as each is read several times, and
    removed at the end. The driver gets pairs above the discount, the words they end
    with, and words with at least two continuations; what is left out goes to the backoff. Without training
    documents of both classes the models have no weights. The sample is bounded in documents, not in the
    length of their texts: a very long one brings all its words.
    """
    with Scratch(docs.sparkSession, "toxicity", root) as scratch:
        sample = labelled_sample(docs, labels, "toxic", fold("doc_id", FOLDS) != HELD_OUT, per_class).withColumn(
            "calibrates", F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(CALIBRATION_SHARE)) == 0
        )
        sample = scratch.stage(sample.select("text", "label", "calibrates"), "sample")
        models = _estimate(scratch.stage(_count(sample.filter("NOT calibrates")), "pairs"))
        _calibrate(models, sample.filter("calibrates").select("text", "label"))
    return models


def _estimate(pairs: DataFrame) -> Models:
    """The models of counted pairs, not yet calibrated."""
    by_class = [F.when(F.col("label") == c, F.col("n")) for c in (ORDINARY, TOXIC)]
    kinds = [F.count(c).alias(f"k{i}") for i, c in enumerate(by_class)]
    kept = F.col("n") > PAIR_DISCOUNT
    ends = pairs.groupBy("word").agg(*kinds, F.bool_or(kept).alias("in_pair"))
    least = [F.sum(F.least(F.col(k), F.lit(CLASS_DISCOUNT))) for k in ("k0", "k1")]
    totals = ends.agg(F.sum("k0"), F.sum("k1"), F.count("*"), *least).first()
    kept_words = ends.filter(f"in_pair OR k0 + k1 >= {LEAST_COUNT}").toArrow()
    sides = [
        F.coalesce(F.sum(F.when(kept, c - PAIR_DISCOUNT) if s == "kept" else c), F.lit(0.0)).cast("double").alias(f"{s}{i}")
        for i, c in enumerate(by_class)
        for s in ("all", "kept")
    ]
    starts = pairs.groupBy("before").agg(*sides).filter(f"all0 + all1 >= {LEAST_COUNT}").toArrow()
    kept_pairs = pairs.filter(kept).toArrow()

    def column(frame, name):
        return frame.column(name).to_numpy()

    a = np.array([totals[0] or 0, totals[1] or 0], float)
    freed = np.array([totals[3] or 0, totals[4] or 0], float)
    vocabulary = float(totals[2] or 0) + 1
    keys = column(kept_words, "word")
    place = {int(k): i + 1 for i, k in enumerate(keys)}
    place[int(NO_WORD)] = start = len(keys) + 1
    counted = np.stack([column(kept_words, "k0"), column(kept_words, "k1")], axis=1)
    continuation = np.vstack([np.zeros((1, 2)), counted, np.zeros((1, 2))])
    shared = np.minimum(continuation, CLASS_DISCOUNT).sum(axis=1) / max(1.0, freed.sum())
    shared[0] = 1 / vocabulary
    safe = np.maximum(a, 1)
    unigram = (np.maximum(continuation - CLASS_DISCOUNT, 0) + freed * shared[:, None]) / safe
    unigram[:, a == 0] = shared[:, None]
    unigram[0] = 1 / vocabulary  # a word that neither class has tells nothing
    back = np.ones((len(place) + 1, 2))
    at = np.array([place.get(int(k), 0) for k in column(starts, "before")], np.int64)
    sums = np.stack([np.stack([column(starts, f"{s}{c}") for c in (0, 1)], axis=1) for s in ("all", "kept")])
    known = at > 0
    back[at[known]] = np.where(sums[0] > 0, 1 - sums[1] / np.maximum(sums[0], 1), 1.0)[known]
    ids = np.array([place.get(int(w), 0) for w in column(kept_pairs, "word")], np.int64)
    froms = np.array([place.get(int(v), 0) for v in column(kept_pairs, "before")], np.int64)
    label, n = column(kept_pairs, "label"), column(kept_pairs, "n")
    total_of = np.zeros((len(place) + 1, 2))
    total_of[at[known]] = sums[0][known]
    usable = (ids > 0) & (froms > 0)
    codes, rows = np.unique(froms[usable] << 32 | ids[usable], return_inverse=True)
    discounted = np.zeros((len(codes), 2))
    discounted[rows, label[usable]] = (n[usable] - PAIR_DISCOUNT) / np.maximum(total_of[froms[usable], label[usable]], 1)
    return Models(_by_hash(place), start, unigram, back, codes, discounted)


class _ByHash(dict):
    """Place of a word by its hash; words are hashed where they are looked up."""

    def get(self, word, default=0):
        return dict.get(self, xxhash.xxh3_64_intdigest(word), default)


def _by_hash(place: dict[int, int]) -> _ByHash:
    return _ByHash({k & 0xFFFFFFFFFFFFFFFF: v for k, v in place.items()})


def _calibrate(models: Models, sample: DataFrame) -> None:
    """A logistic map from the features to a probability, on documents the models have not seen."""
    shared = sample.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in slices(batches, BATCH_BYTES):
            found = [shared.value.features(text).tolist() for text in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.float64())), batch.column("label")], names=["features", "label"]
            )

    got = sample.mapInArrow(run, "features array<double>, label int").toArrow().to_pydict()
    shared.unpersist()
    if len(set(got["label"])) == 2:
        models.weights = logistic(np.array(got["features"]), np.array(got["label"]))


def score(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every whole text.

    The score is a calibrated probability that the text is toxic; ``predicted`` is 1 from
    THRESHOLD on. A null or empty text, or one without words, has features of 0. If only one
    class or none was there to learn from, every score is 0. Only ``doc_id`` and ``text``
    are read; repeated rows are scored each by itself; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = shared.value
        for batch in slices(batches, BATCH_BYTES):
            found = np.array([own.features(text) for text in texts(batch)]).reshape(-1, FEATURES)
            scores = np.zeros(len(found)) if own.weights is None else probability(found, own.weights)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    wanted = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
