"""Document fingerprints: content-defined chunks, their digests and weighted containment."""

import base64
import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

MIN_CHUNK, NORMAL_CHUNK, MAX_CHUNK = 8, 32, 128
HARD, EASY = np.uint32(0x7F << 25), np.uint32(0x0F << 28)  # 7 and 4 bits around log2(NORMAL_CHUNK)
DIGEST_BYTES = 5
PARTS_PER_PARTITION = 8
RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher."""
    x = numbers.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
GEAR = (_BYTES >> np.uint64(32)).astype(np.uint32)
PLACES = np.full(MAX_CHUNK, 0xD6E8FEB86659FD93, np.uint64)
PLACES = np.cumprod(PLACES)


def cut_points(data: np.ndarray) -> list[int]:
    """Where chunks end.

    The gear hash of a place is the sum of shifted gear values of the 32 bytes up to it, built
    by doubling. A chunk ends at the first place past MIN_CHUNK whose hash has 7 zero bits;
    past NORMAL_CHUNK 4 zero bits are enough, and at MAX_CHUNK it ends anyway.
    """
    rolling = GEAR[data]
    for width in (1, 2, 4, 8, 16):
        shifted = rolling[:-width] << np.uint32(width)
        rolling = rolling.copy()
        rolling[width:] += shifted
    easy = np.flatnonzero((rolling & EASY) == 0)
    hard = easy[(rolling[easy] & HARD) == 0].tolist()
    easy, size, ends, start = easy.tolist(), len(data), [], 0
    while size - start > MIN_CHUNK:
        at = bisect_left(hard, start + MIN_CHUNK - 1)
        normal = start + NORMAL_CHUNK - 1
        if at < len(hard) and hard[at] < normal:
            start = hard[at] + 1
        else:
            at = bisect_left(easy, normal)
            last = start + MAX_CHUNK
            start = min(easy[at] + 1, last) if at < len(easy) else last
        if start >= size:
            break
        ends.append(start)
    ends.append(size)
    return ends


def chunk_set(text: bytes) -> np.ndarray:
    """Sorted distinct ``digest << 8 | length`` of the chunks of a text."""
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text, np.uint8)
    ends = np.array(cut_points(data))
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    places = np.arange(len(data)) - np.repeat(starts, lengths)
    digests = _mixed(np.add.reduceat(_BYTES[data] * PLACES[places], starts))
    kept = (digests >> np.uint64(64 - 8 * DIGEST_BYTES)) << np.uint64(8)
    return np.unique(kept | lengths.astype(np.uint64))


def encoded(chunks: np.ndarray) -> str:
    """Six bytes a chunk, digest then length, in base64."""
    return base64.b64encode(chunks.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decoded(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, DIGEST_BYTES + 1)
    return np.hstack([np.zeros((len(raw), 2), np.uint8), raw]).view(">u8").ravel().astype(np.uint64)


def containment(own: np.ndarray, other: np.ndarray) -> float:
    """The share of the own chunks' length that the other set holds too; two empty sets: 1."""
    if not len(own):
        return float(not len(other))
    weight = own & np.uint64(0xFF)
    return float(weight[np.isin(own, other, assume_unique=True)].sum() / weight.sum())


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last floor(n / 2) code points replaced by the first as many (or
    all) of the next document's in descending doc_id; the last document is followed by the
    first. Ties of doc_id are ordered by their compressed text, null ids come last; a null
    text is empty; an only document follows itself. Likeness is the weighted containment of
    a text's chunks; an empty text is like an empty one only. Other columns are not read.

    Texts are shuffled once, compressed, into ranges of doc_id. The ranges' bounds are ids
    that occur, found as quantiles, a few per shuffle partition. The rows with a bound's id
    also go to the range above it, where they follow that range's last document. A task
    streams through sorted rows and holds two texts at a time.
    """
    spark = docs.sparkSession
    parts = PARTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = F.array(*(F.lit((i + 1) / parts) for i in range(parts)))
    bounds_row = docs.agg(F.percentile_approx("doc_id", wanted, 100_000), F.max("doc_id")).first()
    bounds = np.array(sorted({*(bounds_row[0] or []), *([] if bounds_row[1] is None else [bounds_row[1]])}))
    tails = {bound: at + 1 for at, bound in enumerate(bounds[:-1].tolist())}
    last_id = bounds_row[1]

    def spread(batches):
        for batch in batches:
            pack = zstandard.ZstdCompressor(level=3).compress
            ids, raw = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            rows = []
            for doc_id, text in zip(ids, raw):
                packed = pack(text or b"")
                part = 0 if doc_id is None or not len(bounds) else int(np.searchsorted(bounds, doc_id))
                rows.append((part, 0, doc_id, packed))
                if doc_id in tails:
                    rows.append((tails[doc_id], 1, doc_id, packed))
                if doc_id == last_id:
                    rows.append((0, 1, doc_id, packed))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = [pa.int32(), pa.int32(), batch.schema.field(0).type, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "tail", "doc_id", "packed"]
            )

    def fingerprints(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        waiting = None  # (part, doc_id, text, chunks)
        for batch in batches:
            rows = []
            for part, tail, doc_id, packed in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if tail and (waiting is None or waiting[0] != part):
                    continue  # a further row with the bound's id
                raw = unpack(packed)
                text, chunks = raw.decode(), chunk_set(raw)
                if waiting is not None:
                    rows.append(_row(waiting, text, chunks))
                waiting = None if tail else (part, doc_id, text, chunks)
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [batch.schema.field(2).type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            names = ["doc_id", *(column.split()[0] for column in RESULT.split(", "))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    spread_out = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        spread, f"part int, tail int, doc_id {kind}, packed binary"
    )
    ordered = spread_out.repartition("part").sortWithinPartitions(
        "part", "tail", F.col("doc_id").desc_nulls_last(), "packed"
    )
    return ordered.mapInArrow(fingerprints, f"doc_id {kind}, {RESULT}")


def _row(document, next_text: str, next_chunks: np.ndarray):
    _, doc_id, text, chunks = document
    half = len(text) // 2
    edited = (text[: len(text) - half] + next_text[:half]).encode()
    other = chunk_set(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited).hexdigest(),
        encoded(chunks),
        encoded(other),
        containment(chunks, other),
        containment(chunks, next_chunks),
    )
