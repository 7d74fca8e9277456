"""Workbooks as a cell grid: one row per worksheet row, every cell as text.

Only the bytes are decoded in Python. A workbook is an archive; one task per file takes the wanted sheets out of it as they
are, compressed, and each sheet is then decoded by a task of its own, its rows streamed out in batches. What the cells mean is decided downstream by DataFrame operators.
"""

import io
import posixpath
import zipfile
import zlib
from collections.abc import Callable
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesmart.schemas import CELL_GRID
from seriesmart.sources.tasks import sent_by_value, tasks_of_a_shuffle

sent_by_value(__name__)

ROWS_PER_BATCH = 4_096
READ_BYTES = 1 << 16
HEADER_BYTES = 30  # of a part of an archive, before its name
SHARED_TEXTS = "xl/sharedStrings.xml"
PARTS = "file string, sheet_idx int, sheet string, packed boolean, part binary, texts_packed boolean, texts binary"
_ARROW_PARTS = pa.schema(
    [
        ("file", pa.string()),
        ("sheet_idx", pa.int32()),
        ("sheet", pa.string()),
        ("packed", pa.bool_()),
        ("part", pa.binary()),
        ("texts_packed", pa.bool_()),
        ("texts", pa.binary()),
    ]
)
_ARROW_GRID = pa.schema(
    [
        ("file", pa.string()),
        ("sheet_idx", pa.int32()),
        ("sheet", pa.string()),
        ("row_idx", pa.int64()),
        ("cells", pa.list_(pa.string())),
    ]
)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _joined_text(node) -> str:
    return "".join(part.text or "" for part in node.iter() if _local(part.tag) == "t")


def _shared_texts(part) -> list[str]:
    texts = []
    for _, node in ElementTree.iterparse(part):
        if _local(node.tag) == "si":
            texts.append(_joined_text(node))
            node.clear()
    return texts


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, part name) in workbook order."""
    listed = []
    links = {
        node.attrib["Id"]: posixpath.normpath(posixpath.join("/xl", node.attrib["Target"]))[1:]
        for node in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(node.tag) == "sheet":
            link = next(v for k, v in node.attrib.items() if _local(k) == "id")
            listed.append((node.attrib["name"], links[link]))
    return listed


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - 64
    return index - 1


def _cell_text(node, shared: list[str]) -> str | None:
    kind = node.attrib.get("t", "n")
    if kind == "inlineStr":
        return _joined_text(node)
    raw = next((part.text for part in node if _local(part.tag) == "v"), None)
    if raw is None:
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "TRUE" if raw == "1" else "FALSE"
    return raw


def _sheet_rows(part, shared: list[str]):
    """(row number counted from 1, cells) of one worksheet, streamed."""
    number = 0
    for _, node in ElementTree.iterparse(part):
        if _local(node.tag) != "row":
            continue
        number = int(node.attrib.get("r", number + 1))
        cells = []
        for cell in node:
            reference = cell.attrib.get("r")
            at = _column_index(reference) if reference else len(cells)
            cells.extend([None] * (at - len(cells)))
            cells.append(_cell_text(cell, shared))
        yield number, cells
        node.clear()


def _part(book: zipfile.ZipFile, content, name: str) -> tuple[bool, bytes]:
    """A part of the archive as it lies there: whether it is compressed, and its bytes."""
    entry = book.getinfo(name)
    if entry.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) or entry.flag_bits & 1:
        raise ValueError(f"{name} is encrypted or not compressed by deflate")
    head = bytes(content[entry.header_offset : entry.header_offset + HEADER_BYTES])
    names, extra = int.from_bytes(head[26:28], "little"), int.from_bytes(head[28:30], "little")
    start = entry.header_offset + HEADER_BYTES + names + extra
    return entry.compress_type == zipfile.ZIP_DEFLATED, bytes(content[start : start + entry.compress_size])


def _opened(packed: bool, content: bytes):
    """A part as a file, decompressed while it is read."""
    return _Inflating(content) if packed else io.BytesIO(content)


class _Inflating:
    def __init__(self, content: bytes):
        self.raw, self.inflate = io.BytesIO(content), zlib.decompressobj(-zlib.MAX_WBITS)

    def read(self, size: int = -1) -> bytes:
        if size < 0:
            return self.inflate.decompress(self.inflate.unconsumed_tail + self.raw.read()) + self.inflate.flush()
        out = b""
        while not out and not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.raw.read(READ_BYTES)
            if not data:
                raise ValueError("a part of the workbook ends too early")
            out = self.inflate.decompress(data, size)
        return out


def _take(batches, choose: Callable[[list[str]], list[str]]):
    """The wanted sheets of each workbook, still compressed, with the texts that they share."""
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            raw = memoryview(content.as_buffer())
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as book:
                listed = _sheets(book)
                wanted = set(choose([sheet for sheet, _ in listed]))
                has_texts = SHARED_TEXTS in book.namelist()
                for at, (sheet, part_name) in enumerate(listed):
                    if sheet in wanted:
                        packed, part = _part(book, raw, part_name)
                        texts_packed, texts = _part(book, raw, SHARED_TEXTS) if has_texts else (False, None)
                        row = (posixpath.basename(path), at, sheet, packed, part, texts_packed, texts)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([value], kind.type) for value, kind in zip(row, _ARROW_PARTS)], schema=_ARROW_PARTS
                        )


def _decode(batches):
    for batch in batches:
        for file, at, sheet, packed, part, texts_packed, texts in zip(*(column.to_pylist() for column in batch.columns)):
            shared = _shared_texts(_opened(texts_packed, texts)) if texts is not None else []
            kept = []
            for number, cells in _sheet_rows(_opened(packed, part), shared):
                kept.append((file, at, sheet, number, cells))
                if len(kept) == ROWS_PER_BATCH:
                    yield _batch(kept)
                    kept = []
            if kept:
                yield _batch(kept)


def _batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind.type) for column, kind in zip(zip(*rows), _ARROW_GRID)],
        schema=_ARROW_GRID,
    )


def workbook_grid(
    workbooks: DataFrame,
    sheets: list[str] | None = None,
    choose: Callable[[list[str]], list[str]] | None = None,
) -> DataFrame:
    """The cell grid of workbooks given as (path, content).

    Only the wanted sheets are decoded: those in ``sheets``, or what ``choose`` takes of a
    workbook's sheet names. A workbook is one value, so it is below 2 GB; its bytes are
    read in place, and each sheet goes to a task of its own.
    """

    def pick(names: list[str]) -> list[str]:
        if choose:
            return choose(names)
        return [name for name in names if not sheets or name in sheets]

    taken = workbooks.select("path", "content").mapInArrow(lambda batches: _take(batches, pick), PARTS)
    dealt = taken.repartition(tasks_of_a_shuffle(workbooks.sparkSession), "file", "sheet_idx")
    return dealt.mapInArrow(_decode, CELL_GRID)


def read_workbooks(
    spark: SparkSession,
    path: str,
    name_glob: str = "*.xlsx",
    sheets: list[str] | None = None,
    skip_names: list[str] | None = None,
    choose: Callable[[list[str]], list[str]] | None = None,
) -> DataFrame:
    """The cell grid of the workbooks whose name fits and matches none of ``skip_names``.

    Workbooks of several publications may share a folder; each plan takes its own.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_glob).load(path)
    for pattern in skip_names or []:
        files = files.filter(~F.col("_metadata.file_path").rlike(pattern))  # before any byte is read
    return workbook_grid(files, sheets, choose)


def missing_sheets(grid: DataFrame, expected: list[str]) -> DataFrame:
    """(file, sheet) for every expected sheet that a file lacks."""
    found = grid.groupBy("file").agg(
        *(F.max(F.col("sheet") == name).alias(f"_{at}") for at, name in enumerate(expected))
    )
    wanted = F.array(
        *(
            F.struct(F.lit(name).alias("sheet"), F.col(f"_{at}").alias("present"))
            for at, name in enumerate(expected)
        )
    )
    return found.select("file", F.inline(wanted)).filter(~F.col("present")).select("file", "sheet")


def require_sheets(grid: DataFrame, expected: list[str]) -> None:
    lost = missing_sheets(grid, expected).limit(10).collect()
    if lost:
        raise ValueError(f"expected sheets not found: {[tuple(row) for row in lost]}")
