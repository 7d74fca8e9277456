"""Language-model scores by deleted interpolation of word n-grams counted over the corpus."""

from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from seriesmart.llm.common import fold, lower_words, slices, texts
from seriesmart.llm.dedup import WordHashes, mixed
from seriesmart.sources.scratch import Scratch

FOLDS, HELD_OUT = 7, 2
BLOCK_BYTES = 8 << 20
BUCKET_KEYS = 1 << 20
END, START = (xxhash.xxh3_64_intdigest(mark) for mark in (b"", b" "))  # neither can be a word
FREQUENCY_BUCKETS = 40
STEPS = 8  # steps per doubling in the histogram from which the weights are learned
NEVER = -(1 << 11)
ROUNDS = 100
BLOCK = "block long, n_tokens long, doc_ids array<long>, held_out binary, lengths binary, keys binary, tokens binary"
REQUEST = "bucket long, block long, level int, keys binary, counts binary"
ANSWER = "block long, level int, bucket long, counts binary, tokens long, kinds long"
COUNTED = "doc_ids array<long>, held_out binary, lengths binary, words binary, pairs binary"


def squeezed(numbers: np.ndarray) -> bytes:
    """An array with the bytes of equal weight side by side, compressed."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(raw: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0xD6E8FEB86659FD93) + mixed(after))


class Block:
    """Some documents as places in a sorted array of word hashes; each ends with END."""

    def __init__(self, held_out, lengths, keys, tokens):
        self.keys, self.tokens, self.lengths = keys, tokens, lengths
        self.training = np.repeat(~held_out, lengths)
        words = keys[tokens]
        first = np.cumsum(lengths) - lengths
        before = np.concatenate([[np.uint64(0)], words[:-1]])
        before[first] = np.uint64(START)
        self.pairs, self.pair_of = np.unique(pair_keys(before, words), return_inverse=True)

    def levels(self):
        """``(level, sorted keys, counts in the training documents)`` of words and of pairs."""
        yield 1, self.keys, np.bincount(self.tokens[self.training], minlength=len(self.keys))
        yield 2, self.pairs, np.bincount(self.pair_of[self.training], minlength=len(self.pairs))


def _block(row) -> Block:
    return Block(
        np.frombuffer(row.held_out, bool),
        np.frombuffer(row.lengths, np.int64),
        np.frombuffer(row.keys, np.uint64),
        unsqueezed(row.tokens, np.uint32),
    )


def _blocks(docs: DataFrame) -> DataFrame:
    """Documents in blocks of about BLOCK_BYTES of text, encoded."""

    def encoded(number, rows, hashes):
        found = [[*map(hashes.__getitem__, lower_words(text)), END] for _, _, text in rows]
        words = np.array([key for keys in found for key in keys], np.uint64)
        keys, tokens = np.unique(words, return_inverse=True)
        lengths = np.array(list(map(len, found)), np.int64)
        held_out = np.array([held for _, held, _ in rows], bool)
        columns = [[d for d, _, _ in rows]], held_out.tobytes(), lengths.tobytes(), keys.tobytes()
        return pa.RecordBatch.from_pydict(
            {
                "block": [number],
                "n_tokens": [len(words)],
                "doc_ids": pa.array(columns[0], pa.list_(pa.int64())),
                **dict(zip(("held_out", "lengths", "keys"), ([c] for c in columns[1:]))),
                "tokens": [squeezed(tokens.astype(np.uint32))],
            }
        )

    def run(batches):
        hashes, waiting, size = WordHashes(), [], 0
        number = TaskContext.get().partitionId() << 33
        for batch in slices(batches, BLOCK_BYTES):
            ids, held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for doc in zip(ids, held, texts(batch)):
                waiting.append(doc)
                size += len(doc[2])
                if size >= BLOCK_BYTES:
                    yield encoded(number, waiting, hashes)
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield encoded(number, waiting, hashes)

    wanted = docs.select(
        F.col("doc_id").cast("long"), (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("text").cast("string")
    )
    return wanted.mapInArrow(run, BLOCK)


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the key, so that sorted keys are sorted by bucket too."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _requests(blocks: DataFrame, buckets: int) -> DataFrame:
    """What each block asks of each bucket: its n-grams and how often its training documents have them."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pandas().itertuples():
                out = []
                for level, keys, counts in _block(row).levels():
                    found, starts = np.unique(_bucket_of(keys, buckets), return_index=True)
                    for bucket, start, end in zip(found.tolist(), starts, [*starts[1:], len(keys)]):
                        steps = np.diff(keys[start:end], prepend=np.uint64(0))
                        out.append((bucket, row.block, level, squeezed(steps), squeezed(counts[start:end].astype(np.uint32))))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "block", "level", "keys", "counts"]
                )

    return blocks.mapInArrow(run, REQUEST)


def _answers(requests: DataFrame) -> DataFrame:
    """The corpus counts of what each block asked for, in its order, and the totals of words."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for level, part in rows.groupby("level"):
            asked = [np.cumsum(unsqueezed(raw, np.uint64), dtype=np.uint64) for raw in part["keys"]]
            own = np.concatenate([unsqueezed(raw, np.uint32) for raw in part["counts"]])
            kinds, of = np.unique(np.concatenate(asked), return_inverse=True)
            totals = np.bincount(of, weights=own, minlength=len(kinds)).astype(np.uint64)
            bucket, answers = part["bucket"].iloc[0], np.split(totals[of], np.cumsum(list(map(len, asked)))[:-1])
            out += [(b, level, bucket, squeezed(a), 0, 0) for b, a in zip(part["block"], answers)]
            if level == 1:
                out.append((None, level, bucket, b"", int(totals.sum()), int((totals > 0).sum())))
        names = ["block", "level", "bucket", "counts", "tokens", "kinds"]
        return pd.DataFrame(out, columns=names).astype({"block": "Int64"})

    return requests.groupBy("bucket").applyInPandas(run, ANSWER)


def _counted(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Per block and token the corpus counts of the word and of its pair with the word before."""

    def run(asked: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        row = next(asked.itertuples())
        block = _block(row)
        counts = {}
        for level, part in got.sort_values("bucket").groupby("level"):
            counts[level] = np.concatenate([unsqueezed(raw, np.uint64) for raw in part["counts"]])
        words, pairs = counts[1][block.tokens], counts[2][block.pair_of]
        columns = [row.doc_ids, row.held_out, row.lengths, squeezed(words), squeezed(pairs)]
        return pd.DataFrame([columns], columns=["doc_ids", "held_out", "lengths", "words", "pairs"])

    both = blocks.groupBy("block").cogroup(answers.filter("block IS NOT NULL").groupBy("block"))
    return both.applyInPandas(run, COUNTED)


class Tokens:
    """Counts per token of a counted block; the context's count is that of the word before."""

    def __init__(self, row):
        self.lengths = np.frombuffer(row.lengths, np.int64)
        self.held_out = np.frombuffer(row.held_out, bool)
        self.words = unsqueezed(row.words, np.uint64).astype(np.float64)
        self.pairs = unsqueezed(row.pairs, np.uint64).astype(np.float64)
        self.first = np.cumsum(self.lengths) - self.lengths
        ends = self.words[self.first + self.lengths - 1]  # START comes as often as END
        self.contexts = np.concatenate([[0.0], self.words[:-1]])
        self.contexts[self.first] = ends


def frequency_bucket(contexts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the whole logarithm to base 2."""
    return np.minimum(np.frexp(contexts)[1], FREQUENCY_BUCKETS - 1).astype(np.int64)


def _steps(ratios: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        found = np.round(STEPS * np.log2(ratios))
    return np.where(ratios > 0, np.clip(found, NEVER + 1, -NEVER - 1), NEVER).astype(np.int64)


def _histogram(counted: DataFrame, tokens: int, kinds: int) -> DataFrame:
    """How often training tokens, each left out of all counts, have which estimates.

    Deleted estimates of pair and word, relative to the uniform one, in eighths of a doubling,
    by the frequency bucket of the context. The number of rows is bounded by those steps.
    """

    def run(batches):
        for batch in batches:
            for row in batch.to_pandas().itertuples():
                own = Tokens(row)
                training = np.repeat(~own.held_out, own.lengths)
                left = own.contexts[training] - 1
                by_pair = np.where(left > 0, (own.pairs[training] - 1) / np.maximum(left, 1), 0.0)
                by_word = (own.words[training] - 1) / max(1, tokens - 1)
                code = frequency_bucket(left) << 24
                code |= (_steps(by_pair * (kinds + 1)) - NEVER) << 12 | (_steps(by_word * (kinds + 1)) - NEVER)
                codes, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

    return counted.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def mixture_weights(codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per frequency bucket the weights of pair, word and uniform estimates, by expectation-maximisation."""
    weights = np.tile([0.0, 0.5, 0.5], (FREQUENCY_BUCKETS, 1))
    bucket, steps = codes >> 24, np.stack([(codes >> 12) & 0xFFF, codes & 0xFFF], axis=1) + NEVER
    ratios = np.where(steps == NEVER, 0.0, 2.0 ** (steps / STEPS))
    for b in np.unique(bucket):
        of = bucket == b
        estimates, times = np.hstack([ratios[of], np.ones((of.sum(), 1))]), n[of].astype(float)
        now = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            shares = estimates * now
            shares /= shares.sum(axis=1, keepdims=True)
            now = (shares * times[:, None]).sum(axis=0) / times.sum()
        weights[b] = np.maximum(now, 1e-6) / np.maximum(now, 1e-6).sum()
    weights[0] = [0.0, *(weights[0, 1:] / weights[0, 1:].sum())]  # an unseen context has no pairs
    return weights


def score(docs: DataFrame, root: str | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document.

    Tokens are lower-cased words and one end. The model mixes maximum-likelihood estimates of
    the pair with the word before, of the word, and the uniform one over the known words and
    one unknown, with weights by how often the context occurs. The weights come from
    expectation-maximisation over all training tokens, each deleted from the counts that
    estimate it. ``base_score`` is the add-one model of single words. Both are sums of log10
    over whole texts. A null or empty text is its end alone. Held-out documents add to no
    count. With nothing to learn from, only the uniform estimate is left. Repeated rows count
    as often as they occur; only ``doc_id`` and ``text`` are read.

    Texts are encoded in blocks and written once. Each block sends its distinct n-grams, counted,
    to buckets of the hash range, whose number follows the tokens; a bucket adds up what all
    blocks sent, and answers each of them in its order. So one frequent word is one entry
    per block, no table of counts is sent whole to anyone, and no count is left out.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "scoring", root)
    blocks = scratch.stage(_blocks(docs), "blocks", codec="zstd")
    size = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    answers = scratch.stage(_answers(_requests(blocks, max(1, ceil(2 * size / BUCKET_KEYS)))), "answers")
    tokens, kinds = answers.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    counted = scratch.stage(_counted(blocks, answers), "counted", codec="zstd")
    scratch.remove("blocks")
    scratch.remove("answers")
    seen = _histogram(counted, tokens, kinds).toArrow()
    weights = mixture_weights(seen.column("code").to_numpy(), seen.column("n").to_numpy())
    if not tokens:
        weights[:] = [0.0, 0.0, 1.0]

    def run(batches):
        for batch in batches:
            for row in batch.to_pandas().itertuples():
                own = Tokens(row)
                by_pair = own.pairs / np.maximum(own.contexts, 1)
                estimates = np.stack([by_pair, own.words / max(1, tokens), np.full(len(by_pair), 1 / (kinds + 1))], axis=1)
                model = np.log10((estimates * weights[frequency_bucket(own.contexts)]).sum(axis=1))
                base = np.log10((own.words + 1) / (tokens + kinds + 1))
                known = (own.words > 0).astype(np.int64)
                sums = [np.add.reduceat(values, own.first) for values in (known, base, model)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row.doc_ids, pa.int64(), from_pandas=True),
                        pa.array(own.held_out),
                        pa.array(own.lengths),
                        pa.array(sums[0]),
                        pa.array(np.full(len(own.lengths), tokens, np.int64)),
                        pa.array(sums[1]),
                        pa.array(sums[2]),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return counted.mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
