"""ZIP archives that hold one data table and its description."""

import csv
import io
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from seriesmart.sources.tasks import sent_by_value, tasks_of_a_shuffle

sent_by_value(__name__)

ROWS_PER_BATCH = 8_192
CHUNK_BYTES = 1 << 20
MARK = b"\xef\xbb\xbf"
QUOTE, LINE_END = 34, 10


def data_member(names: list[str]) -> str | None:
    """The first table in the archive that is not a description."""
    tables = (n for n in names if n.endswith(".csv") and not n.endswith("_MetaData.csv"))
    return next(tables, None)


def _cut(text: bytes) -> int:
    """Where the last record of a text ends that begins with one; 0 if none does."""
    signs = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(signs == LINE_END)
    outside = np.cumsum(signs == QUOTE)[ends] % 2 == 0  # a line end inside quotes ends no record
    return int(ends[outside][-1]) + 1 if outside.any() else 0


def _chunks(path: str, raw):
    """(number, header, text) of a table in pieces that end with a record, streamed.

    The first piece is the header alone, in every piece's second place.
    """
    left, number, header = raw.read(len(MARK)), 0, None
    left = b"" if left == MARK else left
    more = True
    while more:
        data = raw.read(CHUNK_BYTES)
        more, left = bool(data), left + data
        end = _cut(left) if more else len(left)
        if not more and left.count(b'"') % 2:
            raise ValueError(f"open quote in {path}")
        if end and header is None:
            lines = csv.reader(io.StringIO(left[:end].decode(), newline=""))
            header = next(lines, [])
            first = _first_record(left)
            left, end = left[first:], end - first
        if end:
            yield number, header, left[:end]
            left, number = left[end:], number + 1


def _first_record(text: bytes) -> int:
    """The length of the first record with its line end."""
    signs = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(signs == LINE_END)
    outside = ends[np.cumsum(signs == QUOTE)[ends] % 2 == 0]
    return int(outside[0]) + 1 if len(outside) else len(text)


def _pieces(batches):
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                member = data_member(archive.namelist())
                if member is None:
                    raise ValueError(f"no data table in {path}: {archive.namelist()}")
                with archive.open(member) as raw:
                    for number, header, text in _chunks(path, raw):
                        yield path, number, header, text


def _rows(path: str, number: int, header: list[str], text: bytes, columns: list[str]):
    """(place, values) of the records of a piece; one with more or fewer fields than the header fails."""
    places = [header.index(name) for name in columns]
    for at, line in enumerate(csv.reader(io.StringIO(text.decode(), newline=""))):
        if line:
            if len(line) != len(header):
                raise ValueError(f"{len(line)} fields instead of {len(header)} in {path}: {line[:20]}")
            yield (number << 32) | at, [line[at] if line[at] != "" else None for at in places]


def archive_rows(archives: DataFrame, columns: list[str], spread: bool = False) -> DataFrame:
    """The named columns of the data table in each archive, all as text.

    ``archives`` has the columns (path, content). An archive without a data table
    fails the job, and so does an open quote or a record that is not as long as the header. An
    archive's bytes are one value, so it is below 2 GB; its table is decompressed in one stream, as it must be, and
    cut into pieces of a megabyte that end with a record. These are parsed in the same task, in order, or with
    ``spread`` by all tasks; then ``row_order`` tells the place of a row in its table.
    Empty text is NULL, as in the reader of plain delimited text.
    """
    order = [StructField("row_order", LongType())] if spread else []
    layout = StructType([*(StructField(name, StringType()) for name in ("path", *columns)), *order])
    kinds = [pa.string()] * (1 + len(columns)) + [pa.int64()] * len(order)

    def emitted(pieces):
        kept = []
        for path, number, header, text in pieces:
            for place, values in _rows(path, number, header, text, columns):
                kept.append((path, *values, place) if spread else (path, *values))
                if len(kept) == ROWS_PER_BATCH:
                    yield batch(kept)
                    kept = []
        if kept:
            yield batch(kept)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=layout.names)

    def cut(batches):
        for path, number, header, text in _pieces(batches):
            yield pa.RecordBatch.from_pydict(
                {"path": [path], "number": [number], "header": [header], "text": pa.array([text], pa.binary())}
            )

    def parse(batches):
        return emitted(row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))

    bytes_of = archives.select("path", "content")
    if not spread:
        return bytes_of.mapInArrow(lambda batches: emitted(_pieces(batches)), layout)
    pieces = bytes_of.mapInArrow(cut, "path string, number long, header array<string>, text binary")
    return pieces.repartition(tasks_of_a_shuffle(archives.sparkSession), "path", "number").mapInArrow(parse, layout)


def read_archives(spark: SparkSession, path: str, columns: list[str], spread: bool = False) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return archive_rows(files, columns, spread)
