"""What several of the operators share: folds, words of a text, byte-level tokenizing."""

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The split that belongs to the published byte-level vocabulary; a fixed value.
BYTE_PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# White space that may not stand before a blank where a text is cut into words to encode.
ODD_SPACE = "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)
NO_CUT = ("  ", *(space + " " for space in ODD_SPACE))
ASCII_NO_CUT = tuple(pair for pair in NO_CUT if pair.isascii())
SLICE_CHARS = 1 << 20
CACHED_WORDS = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids fall in fold 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 of a text column; null is empty."""
    return [value or b"" for value in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about ``max_bytes`` at most, or one row."""
    for batch in batches:
        at = batch.schema.get_field_index(name)
        sizes = np.array([0 if n is None else n for n in pc.binary_length(batch.column(at)).to_pylist()])
        group = np.cumsum(sizes) // max_bytes
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)


def lower_words(text: bytes) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; bytes.split cuts at just these six bytes."""
    return text.lower().split()


@lru_cache(maxsize=2)
def byte_encoding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a ``tokenizers`` JSON file as ranks.

    Ids of such a vocabulary are in merge order, so the ids that come out are those of
    ``tokenizers`` itself, several times faster.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {token["content"]: token["id"] for token in model["added_tokens"]}
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in printable}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("bytes", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens=special)


class WordIds(dict):
    """Token ids of words as little-endian unsigned 32-bit bytes, encoded when first seen."""

    def __init__(self, encode: Callable[[str], list[int]], before: str):
        self.encode, self.before = encode, before

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        ids = self[word] = np.array(self.encode(self.before + word), "<u4").tobytes()
        return ids


class ByteTokenizer:
    """Encodes whole texts; strings of special tokens become their ids where asked."""

    def __init__(self, path: str, special: bool):
        encoding = byte_encoding(path)
        allowed = "all" if special else set()
        self.encode = lambda text: encoding.encode(text, allowed_special=allowed, disallowed_special=())
        self.decode_bytes = encoding.decode_bytes
        self.first, self.later = WordIds(self.encode, ""), WordIds(self.encode, " ")

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit.

        The split never joins a blank to a non-space before it, so a text in which each
        blank follows a non-space is cut there, and each word is encoded once. A text is
        handled in slices, so that its list of words stays small.
        """
        if any(pair in text for pair in (ASCII_NO_CUT if text.isascii() else NO_CUT)) or text.startswith(" "):
            return np.array(self.encode(text), "<u4").tobytes()
        parts, start = [], 0
        while start < len(text):
            end = text.find(" ", start + SLICE_CHARS)
            end = len(text) if end < 0 else end
            words = text[start:end].split(" ")
            head = self.first[words[0]] if start == 0 else b""
            parts.append(head + b"".join(map(self.later.__getitem__, words[1:])))
            start = end
        return b"".join(parts)
