"""Ranked lexical search over an index whose documents are grouped by their length normaliser.

Documents with the same normaliser m form a stratum. There an impact depends on the number of
occurrences alone, so it is computed once for all documents with that number, and the largest
number of a stratum bounds what a term can add in it.
"""

import re
from collections import Counter
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from seriesmart.llm.common import slices, texts
from seriesmart.llm.dedup import WordHashes
from seriesmart.sources.scratch import Scratch

# Terms are runs of ASCII digits and letters and of whatever is beyond ASCII, here as bytes of UTF-8.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
NO_TERM = re.compile(rb"[^0-9A-Za-z\x80-\xFF]")
IN_TERM = np.array([bool(TERM.fullmatch(bytes([byte]))) for byte in range(256)])
K = 50
SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
BAND_BITS = 4  # leading bits of a length that tell its band
PART_TERMS = 1 << 24  # terms with repeats in a part of the index
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 12, 1 << 20
QUERY_TERMS = 1 << 18  # of the items that are searched together
FIRST_VISIT = 256  # documents; twice as many with each further visit
SHARES = 64
SPREAD = "part long, m long, doc_id long, terms binary, counts binary"
INDEXED = "block long, term long, docs binary, groups binary, ids array<long>, normalisers array<long>"


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a whole text, A-Z lower-cased, slice by slice."""
    found, start = Counter(), 0
    while start < len(text):
        gap = NO_TERM.search(text, start + SLICE_BYTES)
        end = gap.start() if gap else len(text)
        found.update(TERM.findall(text[start:end].lower()))
        start = end
    return found


def term_total(text: bytes) -> int:
    """How many terms a text has, repeats included: the bytes where one begins."""
    own = IN_TERM[np.frombuffer(text, np.uint8)]
    return int(np.count_nonzero(own[1:] & ~own[:-1])) + int(own[:1].sum())


def normaliser(n: int, n_docs: int, n_terms: int) -> int:
    """m of a document of ``n`` terms."""
    return 100 - 50 + (50 * n * n_docs) // n_terms


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one occurrence count adds, before the weight of its term."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass(frozen=True)
class Index:
    """``postings`` has a row per block and term, and one with null term per block with its documents."""

    postings: DataFrame
    n_docs: int
    n_terms: int


def band(n: int) -> int:
    """Lengths in geometric bands, eight for each doubling: some hundred at most."""
    shift = max(0, n.bit_length() - BAND_BITS)
    return (shift << BAND_BITS) + (n >> shift)


def _lengths(docs: DataFrame) -> DataFrame:
    """``band, docs, terms``: what the documents of each batch have, by bands of length."""

    def run(batches):
        for batch in slices(batches, BATCH_BYTES):
            sums: dict[int, list[int]] = {}
            for n in filter(None, map(term_total, texts(batch))):
                own = sums.setdefault(band(n), [0, 0])
                own[0] += 1
                own[1] += n
            yield pa.RecordBatch.from_pydict(
                {
                    "band": pa.array(sums, pa.int32()),
                    "docs": pa.array([d for d, _ in sums.values()], pa.int64()),
                    "terms": pa.array([t for _, t in sums.values()], pa.int64()),
                }
            )

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "band int, docs long, terms long")


def _spread(docs: DataFrame, parts: dict[int, tuple[int, int]], n_docs: int, n_terms: int) -> DataFrame:
    """The terms of each document that has any, with the part of the index it belongs to.

    ``parts`` has the first part and the number of parts for each band of lengths.
    """

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, BATCH_BYTES):
            rows = []
            for row, doc_id, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), texts(batch)):
                found = term_counts(text)
                if not found:
                    continue
                n = found.total()
                first, several = parts[band(n)]
                terms = np.fromiter((hashes[term] for term in found), np.uint64, len(found))
                counts = np.fromiter(found.values(), np.uint32, len(found))
                rows.append(
                    (first + row % several, normaliser(n, n_docs, n_terms), doc_id, terms.tobytes(), counts.tobytes())
                )
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "m", "doc_id", "terms", "counts"]
            )

    mixed = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 1)
    wanted = docs.select(mixed.alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, SPREAD)


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    held = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, held)


def index_block(block: int, ids: list, normalisers: list[int], terms: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    """The rows of one block of documents, which come in order of their normalisers.

    A term's documents stand by stratum, then by falling count; ``groups`` has the
    stratum, the count and the number of documents of each of these groups.
    """
    strata = np.unique(np.array(normalisers, np.int64), return_inverse=True)[1].astype(np.uint64)
    at = np.repeat(np.arange(len(ids), dtype=np.uint64), [len(t) for t in terms])
    term = np.concatenate(terms)
    fewer = np.uint64(0xFFFFFFFF) - np.concatenate(counts).astype(np.uint64)
    place = (strata[at.astype(np.int64)] << np.uint64(44)) | (fewer << np.uint64(12)) | at
    order = np.lexsort((place, term))
    term, place = term[order], place[order]
    new_term = np.diff(term, prepend=~term[:1]) != 0
    new_group = new_term | (np.diff(place >> np.uint64(12), prepend=place[:1] >> np.uint64(12)) != 0)
    starts, heads = np.flatnonzero(new_term), np.flatnonzero(new_group)
    sizes = np.diff(heads, append=len(term))
    head = place[heads]
    groups = np.stack(
        [head >> np.uint64(44), np.uint64(0xFFFFFFFF) - ((head >> np.uint64(12)) & np.uint64(0xFFFFFFFF)), sizes.astype(np.uint64)],
        axis=1,
    ).astype("<u4")
    docs = (place & np.uint64(0xFFF)).astype("<u2")
    n = len(starts)
    none = pa.nulls(n, pa.list_(pa.int64()))
    rows = [
        pa.array(np.full(n + 1, block, np.int64)),
        pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(term[starts].view(np.int64))]),
        pa.concat_arrays([pa.nulls(1, pa.binary()), _binary(np.append(starts, len(term)) * 2, docs)]),
        pa.concat_arrays(
            [pa.nulls(1, pa.binary()), _binary(np.append(np.searchsorted(heads, starts), len(heads)) * 12, groups)]
        ),
        pa.concat_arrays([pa.array([ids], pa.list_(pa.int64())), none]),
        pa.concat_arrays([pa.array([normalisers], pa.list_(pa.int64())), none]),
    ]
    return pa.RecordBatch.from_arrays(rows, names=["block", "term", "docs", "groups", "ids", "normalisers"])


def _indexed(spread: DataFrame) -> DataFrame:
    """Rows of a part, in order of their normalisers, as blocks of bounded size."""

    def run(batches):
        part, number, held, postings = None, 0, [], 0

        def block():
            ids, normalisers, terms, counts = map(list, zip(*held))
            return index_block((part << 32) | number, ids, normalisers, terms, counts)

        for batch in batches:
            for own, m, doc_id, terms, counts in zip(*(column.to_pylist() for column in batch.columns)):
                if held and (own != part or postings >= BLOCK_POSTINGS or len(held) >= BLOCK_DOCS):
                    yield block()
                    held, postings, number = [], 0, number + 1
                if own != part:
                    part, number = own, 0
                held.append((doc_id, m, np.frombuffer(terms, np.uint64), np.frombuffer(counts, np.uint32)))
                postings += len(held[-1][2])
        if held:
            yield block()

    dealt = spread.repartition("part").sortWithinPartitions("part", "m")
    return dealt.mapInArrow(run, INDEXED)


def build_index(docs: DataFrame, scratch: Scratch, name: str = "index") -> Index:
    """Indexes all terms of all documents, as a written table.

    One pass counts terms by bands of length; a second one deals the documents by band, and
    large bands by row, to parts of about PART_TERMS terms. Each part is sorted by normaliser
    and cut into blocks of BLOCK_DOCS documents or BLOCK_POSTINGS postings, which a task builds
    one after the other, so a block holds few strata. Null texts and texts without terms are not indexed.
    Terms are 64-bit hashes.
    """
    sums = (F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
    bands = _lengths(docs).groupBy("band").agg(*sums).collect()  # some hundred rows at most
    n_docs, n_terms = sum(r["docs"] for r in bands), sum(r["terms"] for r in bands)
    parts, first = {}, 0
    for row in sorted(bands):
        parts[row["band"]] = (first, ceil(row["terms"] / PART_TERMS))
        first += parts[row["band"]][1]
    spread = _spread(docs, parts, n_docs, n_terms)
    return Index(scratch.stage(_indexed(spread), name, codec="zstd"), n_docs, n_terms)


def _items(queries: DataFrame) -> DataFrame:
    """``number, item_id, terms`` of each row of the queries; a null text has no terms."""
    kind = queries.schema["item_id"].dataType.simpleString()

    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, BATCH_BYTES):
            found = [np.array([hashes[t] for t in term_counts(text)], np.uint64).view(np.int64) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([f.tolist() for f in found], pa.list_(pa.int64()))],
                names=["number", "item_id", "terms"],
            )

    numbered = queries.select(F.monotonically_increasing_id().alias("number"), "item_id", F.col("text").cast("string"))
    return numbered.mapInArrow(run, f"number long, item_id {kind}, terms array<long>")


def _weighed(index: Index, items: DataFrame) -> DataFrame:
    """``number, term, weight`` of the items' terms that any document has."""
    entries = items.select("number", F.explode("terms").alias("term"))
    held = index.postings.select("term", (F.octet_length("docs") / 2).cast("long").alias("df"))
    found = held.join(entries.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(float(2 * index.n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(1000 * F.log(ratio)).cast("long").alias("weight")
    return entries.join(found.select("term", weight), "term").select("number", "term", "weight")


class Top:
    """The best documents of an item so far: highest scores, ties to the smaller id, null ids last."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids, self.missing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, missing = np.concatenate([self.ids, ids]), np.concatenate([self.missing, missing])
        best = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores, self.ids, self.missing = scores[best], ids[best], missing[best]
        if len(best) == self.k:
            self.least = max(1, int(self.scores[-1]))


class Block:
    """One block of the index while it is searched: its strata, and the postings of some terms."""

    def __init__(self, ids: pa.Scalar, normalisers: pa.Scalar):
        self.missing = ids.values.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.values.fill_null(0).to_numpy()
        self.m, self.stratum = np.unique(normalisers.values.to_numpy(), return_inverse=True)
        self.sizes = np.bincount(self.stratum)
        self.raw: dict[int, tuple[bytes, bytes]] = {}
        self.terms: dict[int, tuple] = {}

    def postings(self, term: int, weight: int) -> tuple:
        """Places, weighed impacts and strata of the term's documents; its strata and their bounds."""
        if term not in self.terms:
            docs, groups = self.raw[term]
            groups = np.frombuffer(groups, "<u4").reshape(-1, 3).astype(np.int64)
            strata = groups[:, 0]
            weighed = weight * impacts(groups[:, 1], self.m[strata])
            first = np.flatnonzero(np.diff(strata, prepend=-1))
            places = np.frombuffer(docs, "<u2")
            self.terms[term] = (
                places,
                np.repeat(weighed, groups[:, 2]),
                self.stratum[places],
                strata[first],
                weighed[first],
            )
        return self.terms[term]

    def search(self, entries: list[tuple[int, int]], top: Top) -> None:
        """Visits strata by falling bound while these reach what the item already has."""
        found = [self.postings(term, weight) for term, weight in entries if term in self.raw]
        if not found:
            return
        bounds = np.zeros(len(self.m), np.int64)
        for *_, strata, most in found:
            bounds[strata] += most
        order = np.argsort(-bounds, kind="stable")
        reach = np.cumsum(self.sizes[order])
        start, docs = 0, FIRST_VISIT
        while start < len(order) and bounds[order[start]] >= top.least:
            end = max(start + 1, int(np.searchsorted(reach, docs, side="right")))
            visited = np.zeros(len(self.m), bool)
            visited[order[start:end]] = True
            visited &= bounds >= top.least
            scores = np.zeros(len(self.ids), np.int64)
            for places, weighed, strata, *_ in found:
                own = visited[strata]
                scores[places[own]] += weighed[own]
            hits = np.flatnonzero(scores >= top.least)
            if len(hits):
                top.add(scores[hits], self.ids[hits], self.missing[hits])
            start, docs = end, int(reach[end - 1]) * 2


def _ranked(index: Index, entries: pa.Table, k: int) -> DataFrame:
    """``number, doc_id, score``: the best of each task for each of some items."""
    spark = index.postings.sparkSession
    items: dict[int, list[tuple[int, int]]] = {}
    for number, term, weight in zip(*(entries.column(c).to_pylist() for c in ("number", "term", "weight"))):
        items.setdefault(number, []).append((term, weight))
    shared = spark.sparkContext.broadcast(items)

    def run(batches):
        wanted = shared.value
        tops = {number: Top(k) for number in wanted}
        block, number = None, None

        def finish():
            if block is not None and block.raw:
                for item, entries in wanted.items():
                    block.search(entries, tops[item])

        for batch in batches:
            for at, (own, term) in enumerate(zip(batch.column("block").to_pylist(), batch.column("term").to_pylist())):
                if own != number:
                    finish()
                    number = own
                    block = Block(batch.column("ids")[at], batch.column("normalisers")[at])
                else:
                    block.raw[term] = (batch.column("docs")[at].as_py(), batch.column("groups")[at].as_py())
        finish()
        for item, top in tops.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(top.scores), item, np.int64)),
                    pa.array(top.ids, mask=top.missing),
                    pa.array(top.scores),
                ],
                names=["number", "doc_id", "score"],
            )

    terms = spark.createDataFrame(pa.table({"term": entries.column("term")})).distinct()
    rows = index.postings.join(F.broadcast(terms), "term", "left_semi").unionByName(index.postings.filter("term IS NULL"))
    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("term").asc_nulls_first())
    return dealt.mapInArrow(run, "number long, doc_id long, score long")


def search(index: Index, queries: DataFrame, scratch: Scratch, k: int = K) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents for each row of ``queries``.

    Items are searched together in groups of about QUERY_TERMS terms, which are broadcast; the postings
    of their terms are gathered by block. A task keeps what each item has found so far from block to block, so
    that ever fewer strata reach it.
    """
    spark = queries.sparkSession
    items = scratch.stage(_items(queries), "items")
    weighed = scratch.stage(_weighed(index, items), "weighed")
    groups = ceil(weighed.count() / QUERY_TERMS)
    found = None
    for group in range(groups):
        own = weighed.filter(F.pmod(F.xxhash64("number"), F.lit(groups)) == group)
        best = _ranked(index, own.toArrow(), k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        found = spark.createDataFrame([], "number long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    share = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SHARES)).alias("share")
    in_share = F.row_number().over(Window.partitionBy("number", "share").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    best = (
        found.select("*", share)
        .withColumn("rank", in_share)
        .filter(F.col("rank") <= k)
        .withColumn("rank", rank)
        .filter(F.col("rank") <= k)
    )
    return best.join(items.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


def ranked_documents(docs: DataFrame, queries: DataFrame, k: int = K, root: str | None = None) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each row of ``queries``, all if fewer.

    Terms are counted in whole texts; null texts and texts without terms neither count nor match. Each
    row of ``queries`` is ranked by itself, also where rows share an ``item_id``; a term counts once.
    Ties go to the smaller doc_id, null last; repeated rows of documents are documents of their own and take a rank each.
    Empty documents or queries give no rows. Only ``doc_id``, ``text`` and ``item_id`` are read.
    """
    scratch = Scratch(docs.sparkSession, "lexical", root)
    return search(build_index(docs, scratch), queries, scratch, k)


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0
), sized AS (
  SELECT row, doc_id, 100 - 50 + ((50 * len(terms) * n_docs) // n_terms) AS m FROM docs, totals WHERE len(terms) > 0
), counted AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) GROUP BY row, term
), items AS (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark
), wanted AS (
  SELECT DISTINCT item, item_id, term FROM (SELECT item, item_id, unnest(terms) AS term FROM items)
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term
), scored AS (
  SELECT item, item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted JOIN counted USING (term) JOIN weights USING (term) JOIN sized USING (row)
  GROUP BY item, item_id, row, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
"""
