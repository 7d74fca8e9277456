"""Quality by the votes of near neighbours among labelled latent-semantic vectors."""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from seriesmart.llm.common import fold, slices, texts
from seriesmart.llm.labelled import labelled_sample

FOLDS, HELD_OUT = 5, 0
PER_CLASS = 3_000  # bound of the labelled vectors that are broadcast
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 16  # power of the cosine that weighs a vote
THRESHOLD = 0.3
BATCH_BYTES = 4 << 20
BLOCK_ROWS = 512

# Shapes of bytes: lower-case letter or beyond ASCII, capital, digit, blank, line end, and signs.
SHAPES = np.zeros(256, np.int64)
for _byte in range(128):
    _sign = chr(_byte)
    if _sign.isupper():
        SHAPES[_byte] = 1
    elif _sign.isdigit():
        SHAPES[_byte] = 2
    elif _sign in "\n\r":
        SHAPES[_byte] = 4
    elif _sign.isspace():
        SHAPES[_byte] = 3
    elif not _sign.isalpha():
        SHAPES[_byte] = {".": 5, ",": 5, ";": 5, ":": 5, "!": 6, "?": 6, "|": 7, "-": 8, "'": 8, '"': 8,
                         "(": 9, ")": 9, "<": 10, ">": 10, "{": 10, "}": 10, "/": 11, "\\": 11}.get(_sign, 12)
KINDS = int(SHAPES.max()) + 1
REPEATS = 8  # terms for repetition, each with its opposite
FORM_TERMS = KINDS**3 + 2 * REPEATS
WORD_TERMS = 1 << 11  # into which words and pairs of words are hashed
TERMS = FORM_TERMS + WORD_TERMS
WORD_WEIGHT = 0.5  # of the words' part of a vector, to 1 for the part of form
PAIR_FACTOR = np.uint64(0x9E3779B97F4A7C15)
CACHED_WORDS = 200_000


class WordKeys(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        key = self[word] = xxhash.xxh3_64_intdigest(word)
        return key


KEYS = WordKeys()  # of one Python worker


def repetition(text: bytes) -> np.ndarray:
    """Shares between 0 and 1: how much of a text says again what it has said."""
    out = np.zeros(REPEATS)
    found = text.lower().split()
    if not found:
        return out
    n = len(found)
    pairs = n - 1
    counts = Counter(found)
    lines = [line for line in text.split(b"\n") if line.strip()]
    out[0] = 1 - len(set(zip(found, found[1:]))) / pairs if pairs else 0
    out[1] = 1 - len(set(zip(found, found[1:], found[2:]))) / (n - 2) if n > 2 else 0
    out[2] = sum(a == b for a, b in zip(found, found[1:])) / pairs if pairs else 0
    out[3] = 1 - len(set(lines)) / len(lines)
    out[4] = max(counts.values()) / n if n > 4 else 0
    out[5] = sum(1 for w in found if w.isalpha() or w[0] >= 128) / n
    out[6] = min(1.0, sum(map(len, found)) / n / 20)
    out[7] = 1 / (1 + n / 20)
    return out


def word_terms(text: bytes) -> np.ndarray:
    """Square roots of the shares of hashed words and pairs of words, lower-cased, with their signs."""
    found = text.lower().split()
    if not found:
        return np.zeros(WORD_TERMS)
    keys = np.fromiter(map(KEYS.__getitem__, found), np.uint64, len(found))
    every = np.concatenate([keys, (keys[:-1] * PAIR_FACTOR) ^ keys[1:]])
    places = (every * PAIR_FACTOR) >> np.uint64(64 - WORD_TERMS.bit_length() + 1)
    return np.sqrt(np.bincount(places.astype(np.int64), minlength=WORD_TERMS) / len(places))


def terms(text: bytes) -> np.ndarray:
    """Term weights: square roots of the shares of shape trigrams, of repetition terms, and of words."""
    out = np.zeros(TERMS)
    out[FORM_TERMS:] = word_terms(text)
    shapes = SHAPES[np.frombuffer(text, np.uint8)]
    if len(shapes) > 2:
        codes = (shapes[:-2] * KINDS + shapes[1:-1]) * KINDS + shapes[2:]
        counts = np.bincount(codes, minlength=KINDS**3)
        out[: KINDS**3] = np.sqrt(counts / len(codes))
    again = repetition(text)
    out[KINDS**3 : FORM_TERMS : 2] = np.sqrt(again)
    out[KINDS**3 + 1 : FORM_TERMS : 2] = np.sqrt(np.maximum(0, 1 - again))
    return out


@dataclass
class Neighbours:
    """Latent-semantic directions of form and of words, and the labelled vectors on them.

    The two parts are decomposed by themselves, as words would else drown what few terms of form tell; each
    has length 1 before it is weighed, so the cosine of two vectors is a weighted mean of both.
    """

    inverse: np.ndarray  # weight of each term: common ones count less
    directions: list[np.ndarray]  # (terms, dimensions) of form, then of words
    vectors: np.ndarray  # (labelled, dimensions), of length 1
    labels: np.ndarray

    def project(self, rows: np.ndarray) -> np.ndarray:
        weighed = rows * self.inverse
        return _joined([weighed[:, :FORM_TERMS] @ self.directions[0], weighed[:, FORM_TERMS:] @ self.directions[1]])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled vectors by exact cosine, weighted by a power of it."""
        if not len(self.labels):
            return np.ones(len(rows))
        k = min(NEIGHBOURS, len(self.labels))
        cosines = self.project(rows) @ self.vectors.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-3).astype(float) ** SHARPNESS
        return (weights * self.labels[near]).sum(axis=1) / weights.sum(axis=1)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Neighbours:
    """Directions and neighbours from at most ``per_class`` training documents of each class.

    Term weights are made in tasks; the driver gets the sample's rows and decomposes them.
    """
    sample = labelled_sample(docs, labels, "quality", fold("doc_id", FOLDS) != HELD_OUT, per_class)

    def run(batches):
        for batch in slices(batches, BATCH_BYTES):
            rows = [terms(text).astype(np.float32) for text in texts(batch)]
            held = [np.flatnonzero(row).astype(np.uint16) for row in rows]  # most terms are none of a text's
            packed = [at.tobytes() + row[at].tobytes() for at, row in zip(held, rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(packed, pa.binary())], names=["doc_id", "label", "row"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = sample.select("doc_id", "label", "text").mapInArrow(run, f"doc_id {kind}, label int, row binary").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("row", "ascending")])
    if not got.num_rows:
        empty = [np.zeros((n, DIMENSIONS), np.float32) for n in (FORM_TERMS, WORD_TERMS)]
        return Neighbours(np.ones(TERMS, np.float32), empty, np.zeros((0, 2 * DIMENSIONS), np.float32), np.zeros(0))
    packed = got.column("row").to_pylist()
    inverse, directions, vectors = np.zeros(TERMS, np.float32), [], []
    for start, end in ((0, FORM_TERMS), (FORM_TERMS, TERMS)):  # one part of the sample at a time is unpacked
        rows = _unpacked(packed, start, end)
        used = np.count_nonzero(rows, axis=0)
        inverse[start:end] = np.log1p(len(rows) / np.maximum(used, 1)) * (used > 0)
        rows *= inverse[start:end]
        directions.append(_directions(rows, DIMENSIONS))
        vectors.append(rows @ directions[-1])
        del rows
    labelled = got.column("label").to_numpy().astype(float)
    return Neighbours(inverse, directions, _joined(vectors), labelled)


def _unpacked(packed: list[bytes], start: int, end: int) -> np.ndarray:
    """The terms from ``start`` to ``end`` of rows of (places, two bytes each; weights, four bytes each)."""
    rows = np.zeros((len(packed), end - start), np.float32)
    for row, held in zip(rows, packed):
        n = len(held) // 6
        places, weights = np.frombuffer(held, np.uint16, n), np.frombuffer(held, np.float32, n, 2 * n)
        own = slice(*np.searchsorted(places, [start, end]))
        row[places[own].astype(np.int64) - start] = weights[own]
    return rows


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """Both parts, each of length 1 and then weighed, as vectors of length 1."""
    found = [
        weight * part / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
        for part, weight in zip(parts, (1.0, WORD_WEIGHT))
    ]
    both = np.hstack(found)
    return (both / np.maximum(np.linalg.norm(both, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _directions(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """Right singular vectors of the largest singular values, by subspace iteration."""
    start = np.random.default_rng(7).standard_normal((rows.shape[1], dimensions + 16)).astype(np.float32)
    space = rows.T @ (rows @ start)
    for _ in range(4):
        space, _ = np.linalg.qr(space)
        space = rows.T @ (rows @ space)
    space, _ = np.linalg.qr(space)
    _, _, right = np.linalg.svd(rows @ space, full_matrices=False)
    return space @ right[:dimensions].T


def _scored(model: Neighbours, batch: pa.RecordBatch) -> np.ndarray:
    found = texts(batch)
    blocks = [found[at : at + BLOCK_ROWS] for at in range(0, len(found), BLOCK_ROWS)]
    return np.concatenate([model.scores(np.stack([terms(t) for t in block])) for block in blocks]) if found else np.zeros(0)


def score(docs: DataFrame, model: Neighbours) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every whole text.

    The score is the share of label 1 among the votes of the nearest labelled vectors;
    ``predicted`` is 1 from THRESHOLD on. A null text is empty; an empty text has only
    terms that say so and is compared like any other. With nothing to learn from, every
    score is 1. Ties in the cosine may choose any of the tied neighbours, the same ones for
    the same text and model. Repeated rows are scored each by itself, an empty table gives no rows, and a very
    long text costs the list of its words. Only ``doc_id`` and ``text`` are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, BATCH_BYTES):
            scores = np.clip(_scored(shared.value, batch), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    wanted = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, model: Neighbours) -> DataFrame:
    """The documents whose predicted quality is 1, with all their columns.

    Null and empty texts are judged like others, repeated rows each by itself; all stay if nothing could be
    learned; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, BATCH_BYTES):
            yield batch.filter(pa.array(_scored(shared.value, batch) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
