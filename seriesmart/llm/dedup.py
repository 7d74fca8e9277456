"""Near-duplicate documents: SetSketch registers, bands, joint estimates, and exact checks."""

from collections import defaultdict
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from seriesmart.llm.common import lower_words, slices, texts
from seriesmart.llm.components import components
from seriesmart.sources.scratch import Scratch

REGISTERS = 256
BANDS, BAND_ROWS = 42, 6
BASE, RATE, LARGEST = 1.001, 20.0, 65_535
SIMILAR = (80, 100)  # intersection to union
UNLIKELY = 0.62  # five deviations of the estimate below the threshold
LEAST_EQUAL = 112  # with fewer equal registers, sizes allowing, no order of the others makes UNLIKELY the likeliest
TILE_SHINGLES = 1 << 18
ROWS_AT_ONCE = 4096
CACHED_WORDS = 400_000
BATCH_BYTES = 4 << 20
ROW = "_dedup_row"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SKETCHED = "row long, doc_id long, n int, digest binary, registers binary"
COMPARED = "a long, b long"

# Level j of the sketch has values between BOUNDS[j] and BOUNDS[j + 1].
with np.errstate(divide="ignore"):
    BOUNDS = -np.log1p(-np.arange(REGISTERS + 1) / REGISTERS) / RATE
SPANS = -np.expm1(-RATE * np.diff(BOUNDS))
BAND_FACTORS = np.random.default_rng(11).integers(1, 1 << 62, BAND_ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(numbers: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher."""
    x = (numbers ^ (numbers >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        key = self[word] = xxhash.xxh3_64_intdigest(word)
        return key


def shingles(text: bytes, hashes: WordHashes, width: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of ``width`` words, or of the whole shorter sequence."""
    found = lower_words(text)
    if not found:
        return np.zeros(0, np.uint64)
    keys = np.fromiter((hashes[w] for w in found), np.uint64, len(found))
    length = min(width, len(keys))
    out = np.full(len(keys) - length + 1, length, np.uint64) * GOLDEN
    for at in range(length):
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + keys[at : len(keys) - length + 1 + at])
    return np.unique(out)


def registers(found: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes.

    Each element gives register after register, in an order of its own without repeats, a
    value from ever higher intervals of an exponential distribution; registers keep minima. Once no
    register is above the next interval, the rest cannot matter. Minima are stored by their
    logarithm to BASE, truncated. Registers of a union are the larger ones of both sets.
    """
    least = np.full(REGISTERS, np.inf)
    start = (found & np.uint64(0xFF)).astype(np.int64)
    stride = ((found >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64) | 1
    level, step = 0, min(REGISTERS, 1500 // max(1, len(found)) + 1)
    while level < REGISTERS and BOUNDS[level] < least.max():
        levels = np.arange(level, min(level + step, REGISTERS))
        noise = mixed(found[:, None] + (levels.astype(np.uint64) + np.uint64(1)) * GOLDEN)
        share = (noise >> np.uint64(11)).astype(np.float64) * 2.0**-53
        values = BOUNDS[levels] - np.log1p(-share * SPANS[levels]) / RATE
        places = (start[:, None] + levels * stride[:, None]) % REGISTERS
        np.minimum.at(least, places.ravel(), values.ravel())
        level += len(levels)
    return np.clip(np.floor(1 - np.log(least) / log(BASE)), 0, LARGEST).astype(np.uint16)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One key per band for each row of registers."""
    parts = rows[:, : BANDS * BAND_ROWS].reshape(len(rows), BANDS, BAND_ROWS).astype(np.uint64)
    sums = (parts * BAND_FACTORS).sum(axis=2, dtype=np.uint64)
    return mixed(sums + (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * GOLDEN)


GRID = np.linspace(0, 1, 101)[:-1]


def likely_similarities(more: np.ndarray, less: np.ndarray, n_a: int, n_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarities under which the registers' orders are likeliest, sizes being known.

    ``more`` and ``less`` count the registers of one sketch of ``n_a`` elements that are above and below those of
    each of several others.
    """
    more, less, n_b = more[:, None], less[:, None], n_b[:, None]
    equal = REGISTERS - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    grid = GRID * np.minimum(u / v, v / u)
    shrink = (BASE - 1) / BASE
    p_more = -np.log1p(-(u - v * grid) * shrink) / log(BASE)
    p_less = -np.log1p(-(v - u * grid) * shrink) / log(BASE)
    rest = np.maximum(1 - p_more - p_less, 1e-12)
    chance = more * np.log(np.maximum(p_more, 1e-12)) + less * np.log(np.maximum(p_less, 1e-12)) + equal * np.log(rest)
    return grid[np.arange(len(grid)), np.argmax(chance, axis=1)]


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """The same for one pair of sketches."""
    more, less = np.array([(a > b).sum()]), np.array([(a < b).sum()])
    return float(likely_similarities(more, less, n_a, np.array([n_b]))[0])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 80 * union, on whole sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return SIMILAR[1] * both >= SIMILAR[0] * (len(a) + len(b) - both)


def sizes_allow(n, m):
    return F.least(n, m).cast("long") * SIMILAR[1] >= F.greatest(n, m).cast("long") * SIMILAR[0]


def _sketches(docs: DataFrame, row: str | None, width: int) -> DataFrame:
    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, BATCH_BYTES):
            sizes, digests, sketches = [], [], []
            for text in texts(batch):
                found = shingles(text, hashes, width)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sketches.append(registers(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())],
                names=["row", "doc_id", "n", "digest", "registers"],
            )

    number = F.col(row) if row else F.monotonically_increasing_id()
    wanted = docs.select(number.alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, SKETCHED)


def _bands(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            raw = batch.column("registers").to_pylist()
            if raw:
                keys = band_keys(np.stack([np.frombuffer(r, np.uint16) for r in raw]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.ravel().view(np.int64)),
                        pa.array(np.repeat(batch.column("rep").to_numpy(), BANDS)),
                        pa.array(np.repeat(batch.column("n").to_numpy(), BANDS)),
                    ],
                    names=["key", "rep", "n"],
                )

    return classes.select("rep", "n", "registers").mapInArrow(run, "key long, rep long, n int")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``rep, n, registers, shingles`` of the wanted classes, from their whole texts."""

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, BATCH_BYTES):
            found = [shingles(text, hashes, width) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([xxhash.xxh3_128_digest(f.tobytes()) for f in found], pa.binary()),
                    pa.array([f.tobytes() for f in found], pa.binary()),
                ],
                names=["doc_id", "digest", "shingles"],
            )

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    ids = wanted.select("doc_id").distinct()
    made = some.join(ids, some["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").mapInArrow(
        run, "doc_id long, digest binary, shingles binary"
    )
    same = made["doc_id"].eqNullSafe(wanted["doc_id"]) & (made["digest"] == wanted["digest"])
    return made.join(wanted, same).select("rep", "n", "registers", "shingles")


class _Kept:
    """The few rows of a group, beside which its many rows pass one by one."""

    def __init__(self):
        self.reps, self.parts, self.sketches, self.sets = [], [], [], []
        self.sizes, self.linked = None, defaultdict(set)

    def add(self, rep: int, part: int, registers: np.ndarray, found: np.ndarray) -> None:
        self.reps.append(rep)
        self.parts.append(part)
        self.sketches.append(registers)
        self.sets.append(found)

    def linked_with(self, part: int, registers: np.ndarray, found: np.ndarray) -> list[int]:
        """Of each part that the given row links its own part with, where no row before did, one row."""
        if self.sizes is None:
            self.sizes = np.array([len(s) for s in self.sets], np.int64)
            self.parts = np.array(self.parts, np.int64)
            self.sketches = np.array(self.sketches, np.uint16).reshape(-1, REGISTERS)
        n, linked, out = len(found), self.linked[part], []
        allowed = SIMILAR[1] * np.minimum(self.sizes, n) >= SIMILAR[0] * np.maximum(self.sizes, n)
        possible = np.flatnonzero(allowed & (self.parts != part))
        for start in range(0, len(possible), ROWS_AT_ONCE):
            near = possible[start : start + ROWS_AT_ONCE]
            if linked:
                near = near[~np.isin(self.parts[near], list(linked))]
            near = near[(self.sketches[near] == registers).sum(axis=1) >= LEAST_EQUAL]
            if not len(near):
                continue
            others = self.sketches[near]
            more, less = (registers > others).sum(axis=1), (registers < others).sum(axis=1)
            for at in near[likely_similarities(more, less, n, self.sizes[near]) >= UNLIKELY].tolist():
                other = int(self.parts[at])
                if other not in linked and similar(found, self.sets[at]):
                    linked.add(other)
                    self.linked[other].add(part)
                    out.append(self.reps[at])
        return out


def _compare(few: DataFrame, many: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between rows of ``few`` and rows of ``many`` in the same group.

    Both have ``group`` (any columns in a struct), ``rep`` and ``part``; rows of one part are
    linked already. A group's few rows are kept in memory and its many rows stream by, so the
    callers bound the few. Pairs whose sizes or whose likeliest similarity rule them out are
    not checked on their sets. Once two parts are linked in a group, no further pair of
    them is looked at there.
    """

    def run(batches):
        group, kept = None, None
        for batch in batches:
            links = []
            columns = (batch.column(i).to_pylist() for i in range(6))
            for key, side, rep, part, raw_registers, raw_set in zip(*columns):
                if key != group:
                    group, kept = key, _Kept()
                own = np.frombuffer(raw_registers, np.uint16), np.frombuffer(raw_set, np.uint64)
                if side == 0:
                    kept.add(rep, part, *own)
                else:
                    links += [(other, rep) for other in kept.linked_with(part, *own)]
            found = list(zip(*links)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b"])

    rows = few.select("group", F.lit(0).alias("side"), "rep", "part").unionByName(
        many.select("group", F.lit(1).alias("side"), "rep", "part")
    )
    full = rows.join(sets, "rep").select("group", "side", "rep", "part", "registers", "shingles")
    return full.repartition("group").sortWithinPartitions("group", "side", "rep").mapInArrow(run, COMPARED)


def _tile(column: str, n_tiles: str):
    return F.pmod(F.xxhash64(F.lit("tile"), column), F.col(n_tiles))


def near_duplicates(
    docs: DataFrame, width: int = 5, root: str | None = None, row: str | None = None
) -> DataFrame:
    """``row, doc_id, n_shingles, component_id, kept`` for every document.

    A document's set are the distinct runs of ``width`` successive words of its lower-cased text,
    or its whole sequence if that is shorter; a null text or one without words has an empty set
    and is linked with nothing. Two documents are linked if 100 * intersection >= 80 * union; a component's id
    is its smallest doc_id, and the document that bears it is kept. Rows with equal sets
    are one class throughout. A null doc_id takes part but cannot be an id; a component of
    nulls only has a null id and is not kept. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.

    Classes share a bucket where six registers of a band agree; 42 bands miss a pair at the
    threshold with a chance of 3 in a million. In each bucket all members are first compared
    with its first one, which links nearly all there is. Then only buckets are left that
    hold members, besides the first, of different components: there all members of all but the
    largest component are compared with all other members, in tiles of bounded size. So
    no pair that shares a bucket is left out, no bucket is capped, and no pairs are
    written but links.
    """
    scratch = Scratch(docs.sparkSession, "dedup", root)
    sketches = scratch.stage(_sketches(docs, row, width), "sketches")
    known = sketches.filter("n > 0")
    found = known.groupBy("digest").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least_doc"))
    members = known.select("row", "doc_id", "digest")
    classes = scratch.stage(
        found.join(known.drop("digest"), F.col("rep") == F.col("row")).select(
            "rep", "least_doc", "doc_id", "digest", "n", "registers"
        ),
        "classes",
    )
    bands = _bands(classes)
    hubs = (
        bands.groupBy("key")
        .agg(F.min(F.struct("rep", "n")).alias("hub"), F.count("*").alias("size"))
        .filter("size > 1")
        .select("key", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    shared = scratch.stage(bands.join(hubs, "key"), "shared")
    wanted = classes.join(shared.select("rep").distinct(), "rep", "left_semi").drop("least_doc")
    sets = scratch.stage(_sets(docs, wanted, width), "sets")

    # First every member beside the first one of its bucket.
    beside = shared.filter((F.col("rep") != F.col("hub")) & sizes_allow(F.col("n"), F.col("hub_n"))).select(
        "hub", "rep", "n"
    ).distinct()
    tiles = beside.groupBy("hub").agg(F.ceil(F.sum("n") / TILE_SHINGLES).alias("tiles"))
    tiled = beside.join(tiles, "hub").select(
        F.struct("hub", _tile("rep", "tiles").alias("tile")).alias("group"), "rep", F.col("rep").alias("part")
    )
    heads = tiled.select("group", F.col("group.hub").alias("rep"), F.col("group.hub").alias("part")).distinct()
    links = scratch.stage(_compare(heads, tiled, sets), "links")

    # Then, in buckets that are still of several components, what is left.
    parts = scratch.stage(components(links, scratch, "first"), "parts")
    others = (
        shared.filter(F.col("rep") != F.col("hub"))
        .select("key", "rep", "n")
        .join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .withColumn("part", F.coalesce("component", "rep"))
        .drop("component")
    )
    by_part = others.groupBy("key", "part").agg(F.count("*").alias("rows"), F.sum("n").alias("words"))
    buckets = (
        by_part.groupBy("key")
        .agg(
            F.max(F.struct("rows", "part")).alias("largest"),
            F.sum("words").alias("words"),
            F.max(F.struct("rows", "part", "words")).alias("most"),
            F.count("*").alias("parts"),
        )
        .filter("parts > 1")
        .select(
            "key",
            F.col("largest.part").alias("largest"),
            F.ceil(F.col("words") / TILE_SHINGLES).alias("tiles"),
            F.greatest(F.ceil((F.col("words") - F.col("most.words")) / TILE_SHINGLES), F.lit(1)).alias("few_tiles"),
        )
    )
    mixed_buckets = scratch.stage(others.join(buckets, "key"), "mixed")
    few = (
        mixed_buckets.filter("part <> largest")
        .withColumn("few_tile", _tile("rep", "few_tiles"))
        .withColumn("tile", F.explode(F.expr("sequence(0, tiles - 1)")))
    )
    many = mixed_buckets.withColumn("tile", _tile("rep", "tiles")).withColumn(
        "few_tile", F.explode(F.expr("sequence(0, few_tiles - 1)"))
    )
    group = F.struct("key", F.col("few_tile").cast("long"), F.col("tile").cast("long")).alias("group")
    more = _compare(few.select(group, "rep", "part"), many.select(group, "rep", "part"), sets)
    every = scratch.stage(links.unionByName(more), "all-links")

    ends = scratch.stage(components(every, scratch, "last"), "components")
    labelled = classes.join(ends, classes["rep"] == ends["node"], "left").select(
        "digest", F.coalesce("component", "rep").alias("component"), "least_doc"
    )
    least = labelled.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    ids = labelled.join(least, "component").select("digest", "component_id")
    linked = members.join(ids, "digest").select("row", "component_id")
    out = sketches.select("row", "doc_id", F.col("n").cast("long").alias("n_shingles")).join(linked, "row", "left")
    return out.withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def distinct_documents(docs: DataFrame, width: int = 5, root: str | None = None) -> DataFrame:
    """The documents without near-copies, with all their columns.

    Of each component one document stays, of repeated rows with the kept id one. Documents
    without words all stay, null texts too; an empty table gives no rows. What the comparison wrote is removed at once.
    """
    scratch = Scratch(docs.sparkSession, "dedup-documents", root)
    numbered = scratch.stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "documents", codec="zstd")
    with Scratch(docs.sparkSession, "dedup-compared", root) as compared:
        judged = scratch.stage(near_duplicates(numbered, width, compared.path, ROW), "judged")
    single = judged.filter("n_shingles > 0").groupBy("component_id").agg(
        F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias(ROW)
    )
    stay = single.select(ROW).unionByName(judged.filter("n_shingles = 0").select(F.col("row").alias(ROW)))
    return numbered.join(stay, ROW, "left_semi").select(docs.columns)


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
    FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
