"""Best-fit packing of documents into sequences of a fixed length."""

import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from seriesmart.llm.common import ByteTokenizer, slices
from seriesmart.sources.scratch import Scratch

BATCH_BYTES = 4 << 20
PIECES_PER_TASK = 1 << 19
AGAIN = 1 << 62  # in the ids of sequences that are packed a second time


class OpenBins:
    """Bounded-space online best-fit.

    At most ``capacity`` bins are open. A bit is set in ``spaces`` for each free space that an
    open bin has, so the tightest bin for a piece is the lowest set bit from its length on.
    When a piece fits none and all bins are open, the fullest one closes.
    """

    def __init__(self, length: int, capacity: int):
        self.length, self.capacity = length, capacity
        self.spaces, self.open, self.made = 0, 0, 0
        self.by_space: dict[int, list[int]] = {}

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        number = bins.pop()
        if not bins:
            self.spaces ^= 1 << space
        self.open -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """The bin's number and the place of the piece in it."""
        fitting = self.spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.open >= self.capacity:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
            number, space = self.made, self.length
            self.made += 1
        left = space - size
        if left:
            self.by_space.setdefault(left, []).append(number)
            self.spaces |= 1 << left
            self.open += 1
        return number, self.length - space


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 1024,
    open_bins: int = 4096,
    end_id: int = 2,
    root: str | None = None,
) -> DataFrame:
    """One row per piece of a document with its sequence and place.

    A document is its ids and ``end_id``; a null text is empty, so it is the end alone. One
    longer than ``length`` is cut so that all its pieces but the first are full. Each task
    packs the documents of its partition batch by batch, without a shuffle; the pieces of a batch
    arrive longest first, which leaves about a fifth of the waste. Memory is the open bins and
    one batch of texts, and a task that runs again gives the same rows. The pieces of what stays open when a
    partition ends, without their texts, are packed once more, those of all partitions together, so the
    number of sequences hardly depends on how the documents are split. Other columns of ``docs`` are not read; repeated rows are
    packed each by itself; an empty table gives no pieces.
    """
    scratch = Scratch(docs.sparkSession, "packing", root)
    packed = scratch.stage(_packed(docs, tokenizer, length, open_bins, end_id), "pieces")
    pieces = packed.filter("piece >= 0")
    open_ = scratch.stage(packed.filter("piece < 0").select("sequence_id"), "open")
    loose = scratch.stage(pieces.join(open_, "sequence_id", "left_semi").select(pieces.columns), "loose")
    return pieces.join(open_, "sequence_id", "left_anti").select(pieces.columns).unionByName(
        _again(loose, length, open_bins)
    )


def _again(loose: DataFrame, length: int, open_bins: int) -> DataFrame:
    """The pieces of sequences that stayed open, in new sequences; PIECES_PER_TASK at once, longest first."""
    tasks = ceil(loose.count() / PIECES_PER_TASK) or 1

    def run(batches):
        bins = OpenBins(length, open_bins)
        first = AGAIN | TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(size) for size in batch.column("length").to_pylist()]
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["sequence_id"] = pa.array([first + number for number, _ in placed], pa.int64())
            columns["offset"] = pa.array([offset for _, offset in placed], pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    dealt = loose.repartition(tasks, "sequence_id").sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
    return dealt.mapInArrow(run, loose.schema)


def _packed(docs: DataFrame, tokenizer: str, length: int, open_bins: int, end_id: int) -> DataFrame:
    """The pieces as each partition packs them, and with piece -1 the sequences that stay open."""
    schema = StructType(
        [
            StructField("doc_id", docs.schema["doc_id"].dataType),
            StructField("piece", IntegerType()),
            *(StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset")),
        ]
    )

    def run(batches):
        ids_of = ByteTokenizer(tokenizer, special=True).ids
        bins = OpenBins(length, open_bins)
        first = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, BATCH_BYTES):
            pieces = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = ids_of(text or "") + end
                tokens = len(ids) // 4
                start, piece = 0, 0
                while start < tokens:
                    stop = start + ((tokens - start - 1) % length + 1)
                    pieces.append((doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, piece = stop, piece + 1
            pieces.sort(key=lambda piece: -piece[3])
            rows = []
            for piece in pieces:
                number, offset = bins.place(piece[3])
                rows.append((*piece, first + number, offset))
            columns = list(zip(*rows)) or [[]] * len(schema)
            kinds = [batch.schema.field(0).type, pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names
            )
        left = [(length - space, first + number) for space, numbers in bins.by_space.items() for number in numbers]
        if left:
            n = len(left)
            used, numbers = map(list, zip(*left))
            parts = [pa.nulls(n, batch.schema.field(0).type), pa.array([-1] * n, pa.int32()), pa.nulls(n, pa.int64())]
            rest = [pa.array(used), pa.nulls(n, pa.int64()), pa.array(numbers), pa.nulls(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*parts, *rest], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
