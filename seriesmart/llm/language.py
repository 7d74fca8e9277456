"""Language identification with interpolated Kneser-Ney character models."""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from seriesmart.llm.common import fold, slices, texts
from seriesmart.sources.scratch import Scratch

FOLDS, HELD_OUT = 3, 1
ORDER = 4
DISCOUNT = 0.75
SAMPLE_DOCUMENTS = 1_000  # per language; fits the models
CALIBRATION_SHARE = 4  # one in so many sample documents calibrates instead
TEMPERED = 0.5
MARGIN = 1.5  # of ids, when only the lowest are to be ranked
BATCH_BYTES = 4 << 20
BLANK = 32
UNDETERMINED = "und"
REJECT_BELOW = 0.5


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else a blank."""
    table = np.full(0x110000, BLANK, np.uint32)
    found = [c for c in range(0x110000) if chr(c).isalpha()]
    table[found] = found
    return table


def signs(text: bytes) -> np.ndarray:
    """Lower-cased letters as 16-bit signs, with one blank for whatever stands between words."""
    codes = np.frombuffer(text.decode().lower().encode("utf-32-le"), "<u4")
    codes = letters()[codes]
    blank = codes == BLANK
    codes = codes[~(blank & np.concatenate([[True], blank[:-1]]))] if len(codes) else codes
    if not len(codes):
        return np.zeros(0, np.uint64)
    folded = (codes ^ (codes >> np.uint32(16))) & np.uint32(0xFFFF)
    tail = [] if codes[-1] == BLANK else [BLANK]
    return np.concatenate([[BLANK] * (ORDER - 1), folded, tail]).astype(np.uint64)


def grams(signs_: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` signs at each scored place, packed into 64 bits."""
    key = signs_[ORDER - order : len(signs_) - order + 1].copy()
    for at in range(ORDER - order + 1, ORDER):
        key = (key << np.uint64(16)) | signs_[at : len(signs_) - ORDER + at + 1]
    return key


@dataclass
class Level:
    """One order: sorted n-grams; a row of log-probabilities and of backoffs per language."""

    keys: np.ndarray
    log_p: np.ndarray
    context: np.ndarray  # sorted contexts of this order
    log_back: np.ndarray

    def find(self, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


@dataclass
class Models:
    languages: list[str]
    levels: list[Level]  # order 1 to ORDER
    floor: np.ndarray  # log-probability of an unknown sign
    slope: float = 1.0  # of the calibration
    limits: np.ndarray | None = None  # cross-entropy beyond which a language is rejected

    def log_probabilities(self, signs_: np.ndarray) -> np.ndarray:
        """Rows of log-probabilities per language for each scored place."""
        out = np.empty((len(signs_) - ORDER + 1, len(self.languages)), np.float32)
        left = np.arange(len(out))
        added = np.zeros_like(out)
        for order in range(ORDER, 0, -1):
            level = self.levels[order - 1]
            at, hit = level.find(level.keys, grams(signs_, order)[left])
            out[left[hit]] = level.log_p[at[hit]] + added[left[hit]]
            left = left[~hit]
            if not len(left):
                return out
            if order > 1:
                contexts = grams(signs_, order)[left] >> np.uint64(16)
                at, hit = level.find(level.context, contexts)
                added[left[hit]] += level.log_back[at[hit]]
        out[left] = self.floor + added[left]
        return out

    def judge(self, text: bytes) -> tuple[str, float, float | None, bool]:
        """Language, score, cross-entropy per letter, and whether it is rejected."""
        own = signs(text)
        if not len(own) or (own == BLANK).all():
            return UNDETERMINED, 0.0, None, True
        if not self.languages:
            return UNDETERMINED, 0.0, None, False
        sums = self.log_probabilities(own).sum(axis=0, dtype=np.float64)
        places = len(own) - ORDER + 1
        best = int(np.argmax(sums))
        score = self.posterior(sums, places)[best]
        entropy = -sums[best] / places
        over = self.limits is not None and entropy > self.limits[best]
        return self.languages[best], float(score), float(entropy), bool(over or score < REJECT_BELOW)

    def posterior(self, sums: np.ndarray, places: int) -> np.ndarray:
        """Softmax of length-normalised scores; the slope is fitted on calibration documents."""
        scaled = self.slope * sums / places**TEMPERED
        scaled = np.exp(scaled - scaled.max())
        return scaled / scaled.sum()


def _level(order: int, keys, counts, lower) -> Level:
    """Interpolated Kneser-Ney at one order from counts (n-grams x languages).

    ``lower`` gives rows of probabilities for n-grams of the order below.
    """
    contexts, of = np.unique(keys >> np.uint64(16), return_inverse=True)
    totals = np.zeros((len(contexts), counts.shape[1]))
    kinds = np.zeros_like(totals)
    np.add.at(totals, of, counts)
    np.add.at(kinds, of, counts > 0)
    seen = np.maximum(totals, 1)
    back = np.where(totals > 0, DISCOUNT * kinds / seen, 1.0)
    shorter = keys & np.uint64((1 << 16 * (order - 1)) - 1)
    p = np.maximum(counts - DISCOUNT, 0) / seen[of] + back[of] * lower(shorter)
    return Level(keys, np.log(p).astype(np.float32), contexts, np.log(back).astype(np.float32))


def estimate(languages: list[str], language: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Models:
    """Models of all languages from the counts of n-grams of the highest order."""
    levels: list[Level] = []
    tables = []
    names, at = np.unique(keys, return_inverse=True)
    table = np.zeros((len(names), len(languages)))
    table[at, language] = counts
    tables.append((names, table))
    for order in range(ORDER - 1, 0, -1):  # continuation counts: kinds of signs in front
        longer, table = tables[-1]
        names, at = np.unique(longer & np.uint64((1 << 16 * order) - 1), return_inverse=True)
        lower = np.zeros((len(names), len(languages)))
        np.add.at(lower, at, table > 0)
        tables.append((names, lower))
    alphabet = len(tables[-1][0]) + 1
    uniform = np.full(len(languages), 1.0 / alphabet)

    def of(level: Level):
        return lambda wanted: np.exp(level.log_p[np.searchsorted(level.keys, wanted)].astype(float))

    for order, (names, table) in zip(range(1, ORDER + 1), reversed(tables)):
        below = of(levels[-1]) if levels else lambda wanted: np.tile(uniform, (len(wanted), 1))
        levels.append(_level(order, names, table, below))
    return Models(languages, levels, (np.log(uniform) + levels[0].log_back[0]).astype(np.float32))


def _lowest(known: DataFrame, per_language: int, scratch: Scratch) -> DataFrame:
    """``doc_id, lang, calibrates`` of the ids with the ``per_language`` lowest hashes of each language.

    The distinct ids are counted by geometric bands of their hashes, some hundred a language, which
    gives a band to stop at; only the ids below it are ranked, so no task gets all of a language. The
    margin makes up for the counts being estimates.
    """
    mixed = F.shiftrightunsigned(F.xxhash64("doc_id", "lang"), 1)
    shift = "greatest(0, length(bin(mixed)) - 4)"
    keyed = known.select("doc_id", "lang", mixed.alias("mixed")).withColumn(
        "band", F.expr(f"{shift} * 16 + shiftright(mixed, {shift})")
    )
    bands = keyed.groupBy("lang", "band").agg(F.approx_count_distinct("doc_id").alias("ids"))
    below = Window.partitionBy("lang").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.coalesce(F.sum("ids").over(below), F.lit(0)) < per_language * MARGIN
    last = bands.withColumn("wanted", wanted).filter("wanted").groupBy("lang").agg(F.max("band").alias("last"))
    last = scratch.stage(last, "bands")
    some = keyed.join(last, "lang").filter("band <= last").select("doc_id", "lang", "mixed").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("mixed", "doc_id"))
    chosen = some.withColumn("place", place).filter(F.col("place") <= per_language)
    return chosen.select("doc_id", "lang", (F.col("place") % CALIBRATION_SHARE == 0).alias("calibrates"))


def _sample(docs: DataFrame, per_language: int, scratch: Scratch) -> DataFrame:
    """``lang, text, calibrates`` of at most ``per_language`` documents of each language, as a written table.

    One text comes for each id, that of the lowest hash, so the bound holds for rows. Every CALIBRATION_SHARE-th of a
    language calibrates, so its first ones always train. The chosen ids are a written table, so Spark
    knows its size and broadcasts it while it is small; then only their texts leave the scan.
    Rows without an id are not learned from.
    """
    known = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")).filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT)
    )
    chosen = scratch.stage(_lowest(known, per_language, scratch), "chosen")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    single = known.join(chosen, ["doc_id", "lang"]).groupBy("doc_id", "lang", "calibrates").agg(least)
    return scratch.stage(single.select("lang", "least.text", "calibrates"), "sample", codec="zstd")


def learn(docs: DataFrame, per_language: int = SAMPLE_DOCUMENTS, root: str | None = None) -> Models:
    """Models from a bounded sample of the training documents of each language.

    N-grams are counted in tasks; the driver gets the counts of at most ``per_language``
    documents a language. An empty table, or one without known languages, gives models that know none.
    """
    with Scratch(docs.sparkSession, "language", root) as scratch:
        return _learn(_sample(docs, per_language, scratch))


def _learn(sample: DataFrame) -> Models:
    def count(batches):
        for batch in slices(batches, BATCH_BYTES):
            rows = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                own = signs(text)
                if len(own):
                    rows.setdefault(lang, []).append(grams(own, ORDER))
            for lang, parts in rows.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(keys), "gram": keys.view(np.int64), "n": n})

    counted = (
        sample.filter("NOT calibrates").select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    )
    languages = sorted(set(counted.column("lang").to_pylist()))
    if not languages:
        return Models([], [], np.zeros(0))
    index = {lang: at for at, lang in enumerate(languages)}
    numbers = np.array([index[lang] for lang in counted.column("lang").to_pylist()])
    keys = counted.column("gram").to_numpy().view(np.uint64)
    models = estimate(languages, numbers, keys, counted.column("n").to_numpy())
    _calibrate(models, sample.filter("calibrates").select("lang", "text"))
    return models


def _calibrate(models: Models, sample: DataFrame) -> None:
    """Fits the slope of the scores by likelihood, and each language's limit of cross-entropy."""
    shared = sample.sparkSession.sparkContext.broadcast(models)

    def score(batches):
        own = shared.value
        for batch in slices(batches, BATCH_BYTES):
            langs, sums, places = [], [], []
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                found = signs(text)
                if len(found) and lang in own.languages:
                    langs.append(own.languages.index(lang))
                    sums.append(own.log_probabilities(found).sum(axis=0, dtype=np.float64))
                    places.append(len(found) - ORDER + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.int32()), pa.array(sums, pa.list_(pa.float64())), pa.array(places, pa.int64())],
                names=["lang", "sums", "places"],
            )

    got = sample.mapInArrow(score, "lang int, sums array<double>, places long").toArrow().to_pydict()
    shared.unpersist()
    if not got["lang"]:
        return
    lang, sums, places = (np.array(got[name]) for name in ("lang", "sums", "places"))
    scaled = sums / places[:, None] ** TEMPERED
    scaled -= scaled.max(axis=1, keepdims=True)

    def loss(slope):
        z = slope * scaled
        return np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), lang])

    models.slope = float(min(np.geomspace(0.05, 20, 60), key=loss))
    entropy = -sums[np.arange(len(sums)), lang] / places
    # Half above the highest that calibration saw: a text beyond it is of no known language.
    models.limits = np.array(
        [1.5 * entropy[lang == at].max() if (lang == at).any() else np.inf for at in range(len(models.languages))]
    )


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, cross_entropy, rejected`` for every whole text.

    The language is the one with the lowest cross-entropy per letter. ``und`` with score 0 is
    for null texts and texts without a letter, and for all texts if nothing could be learned.
    ``rejected`` marks those, scores below a half, and texts whose cross-entropy is far above
    what calibration saw in that language. Equal languages go to the first by name. Only
    ``doc_id`` and ``text`` are read; repeated rows are judged each by itself, an empty table gives no
    rows, and a very long text costs some tens of bytes a letter for each language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = shared.value
        for batch in slices(batches, BATCH_BYTES):
            found = [own.judge(text) for text in texts(batch)]
            columns = list(zip(*found)) or [[]] * 4
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"],
            )

    wanted = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string"))
    return wanted.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"
    )


def known_documents(docs: DataFrame, models: Models) -> DataFrame:
    """The documents that are not rejected, with all their columns.

    Null texts and texts without a letter go; nothing else does if nothing could be learned. Repeated rows are
    judged each by itself; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    names = docs.columns

    def run(batches):
        own = shared.value
        for batch in slices(batches, BATCH_BYTES):
            yield batch.filter(pa.array([not own.judge(text)[3] for text in texts(batch)], pa.bool_()))

    return docs.select(names).mapInArrow(run, docs.schema)
