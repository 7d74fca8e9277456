"""Fill-in-middle transformation: a document is cut at two of its line ends and rearranged.

The line ends of a text are a compressed set in the manner of Roaring bitmaps, and the two cuts
are selections from it by rank.
"""

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seriesmart.llm.common import slices, texts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
MARKS = tuple(mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
SEED = 7
RATE = 100  # per cent of the documents that are rearranged
SPM_SHARE = 50  # per cent of these that begin with the suffix
BATCH_BYTES = 4 << 20
CONTAINER_BITS = 16
ARRAY_MOST = 4096  # values that an array container holds at most
BITMAP_BYTES = 1 << (CONTAINER_BITS - 3)
NEWLINE = 10


class ArrayContainer:
    """Few values: sorted 16-bit numbers."""

    def __init__(self, low: np.ndarray):
        self.low = low

    def select(self, rank: int) -> int:
        return int(self.low[rank])


class BitmapContainer:
    """Many values: one bit for each possible one, with running counts per 64-bit word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << CONTAINER_BITS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.counts = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, rank: int) -> int:
        at = int(np.searchsorted(self.counts, rank, side="right"))
        before = int(self.counts[at - 1]) if at else 0
        own = np.flatnonzero(np.unpackbits(self.words[at : at + 1].view(np.uint8), bitorder="little"))
        return 64 * at + int(own[rank - before])


class RunContainer:
    """Successive values: where runs start, with running counts of their lengths."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts
        self.counts = np.cumsum(lengths, dtype=np.int64)

    def select(self, rank: int) -> int:
        at = int(np.searchsorted(self.counts, rank, side="right"))
        return int(self.starts[at]) + rank - (int(self.counts[at - 1]) if at else 0)


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest of the three forms for sorted distinct 16-bit numbers."""
    first = np.flatnonzero(np.diff(low.astype(np.int32), prepend=-2) != 1)
    if 2 + 4 * len(first) < min(2 * len(low), BITMAP_BYTES):
        return RunContainer(low[first], np.diff(first, append=len(low)))
    return ArrayContainer(low) if len(low) <= ARRAY_MOST else BitmapContainer(low)


class BoundarySet:
    """Sorted distinct offsets in containers by their high bits, with cumulative cardinalities."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> CONTAINER_BITS
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.high = high[first]
        low = (offsets & ((1 << CONTAINER_BITS) - 1)).astype(np.uint16)
        self.containers = [container(part) for part in np.split(low, first[1:])] if len(offsets) else []
        self.counts = np.append(first[1:], len(offsets)) if len(offsets) else first

    def __len__(self) -> int:
        return int(self.counts[-1]) if len(self.counts) else 0

    def select(self, rank: int) -> int:
        """The value that ``rank`` others precede: first its container, then its place in there."""
        at = int(np.searchsorted(self.counts, rank, side="right"))
        before = int(self.counts[at - 1]) if at else 0
        return (int(self.high[at]) << CONTAINER_BITS) + self.containers[at].select(rank - before)


def line_ends(text: bytes) -> BoundarySet:
    """Where the lines of a text end, as offsets of its UTF-8; the last line may lack its break."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == NEWLINE) + 1
    if text and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    return BoundarySet(ends)


def draws(doc_id: object, seed: int) -> list[int]:
    """Four numbers of 32 bits that depend on the id and the seed alone; a null id is empty text."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in (0, 8, 16, 24)]


def characters(text: bytes) -> int:
    """Code points of UTF-8."""
    if text.isascii():
        return len(text)
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def rearranged(doc_id, text: bytes, seed: int, rate: int, spm_share: int) -> tuple[int, str, int | None, int | None, bytes]:
    """Lines, form, code points of prefix and middle, and the output."""
    ends = line_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or any(mark in text for mark in MARKS):
        return n, PLAIN, None, None, text
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = (ends.select(cut - 1) if cut else 0 for cut in cuts)
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = MARKS
    if h4 % 100 < spm_share:
        form, output = SPM, b"".join((s, suffix, p, prefix, m, middle))
    else:
        form, output = PSM, b"".join((p, prefix, s, suffix, m, middle))
    return n, form, characters(prefix), characters(middle), output


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every whole text.

    A text of ``n`` lines is cut after two numbers of lines, from 0 to n, that the id and the seed
    choose; ``rate`` per cent of the texts are rearranged, ``spm_share`` per cent of these with
    the suffix in front. The others, empty and null texts (null is empty) and texts
    that hold one of the marks are ``plain``: their output is the text, and their counts are null. Equal ids
    draw equal numbers, so repeated rows come out alike; a null id draws as empty text. An
    empty table gives no rows. Only ``doc_id`` and ``text`` are read. Rows are mapped where
    they lie, without a shuffle; a task holds some megabytes of texts, or one text, and eight bytes a line of it.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, BATCH_BYTES):
            ids = batch.column("doc_id").to_pylist()
            rows = [rearranged(i, text, seed, rate, spm_share) for i, text in zip(ids, texts(batch))]
            n, forms, prefixes, middles, outputs = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(forms, pa.string()),
                    pa.array(prefixes, pa.int64()),
                    pa.array(middles, pa.int64()),
                    pa.array(outputs, pa.binary()).view(pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    wanted = docs.select("doc_id", F.col("text").cast("string"))
    return wanted.mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(form: Column, output: Column) -> Column:
    """The text that was rearranged.

    A rearranged text holds each mark once, as no text with a mark is rearranged and no mark
    can begin inside a text and end inside another mark.
    """

    def between(start: str, end: str | None) -> Column:
        rest = F.substring_index(output, start, -1)
        return F.substring_index(rest, end, 1) if end else rest

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def digests(formatted: DataFrame) -> DataFrame:
    """The columns of :func:`fill_in_middle` with digests of the output and of the text read back from it."""
    return formatted.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")).cast("binary"), 256).alias("restored_sha256"),
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1,
         CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3,
         CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
  FROM lines
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
              OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
         coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix
  FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
