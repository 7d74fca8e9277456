"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows of its docs; its result can be written
and reread as the next one's docs. All but the last return the columns of docs, whatever these are. Null and
empty texts are judged like others by the first stage and go in the second; very long texts are
handled whole; repeated rows are documents of their own until the third; an empty table gives no rows.

The copies that a stage makes lie in a folder of its own. They are removed when a later stage
begins whose docs no longer read them, as they do not once the result was written.
"""

from pyspark.sql import DataFrame, SparkSession

from seriesmart.llm import dedup, language, mixing, packing, quality
from seriesmart.llm.common import table
from seriesmart.llm.queries import tokenizer
from seriesmart.sources.scratch import Scratch

_rooms: list[Scratch] = []


def _room(spark: SparkSession, docs: DataFrame, name: str) -> str:
    """The folder for the copies of a stage, once those of earlier ones that ``docs`` does not read are gone."""
    held = [room for room in _rooms if room.spark is spark]
    read = docs.inputFiles() if held else []
    for room in held:
        if not any(room.path.rpartition("/")[2] in file for file in read):
            room.remove()
            _rooms.remove(room)
    _rooms.append(Scratch(spark, name))
    return _rooms[-1].path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; with no labels that it can learn from, none does."""
    _room(spark, docs, "quality")
    return quality.good_documents(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or like no language that was learned, go."""
    return language.known_documents(docs, language.learn(docs, root=_room(spark, docs, "languages")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id, null last."""
    return dedup.distinct_documents(docs, root=_room(spark, docs, "distinct"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target weights; a document may come twice, or not at all."""
    return mixing.mixed_documents(docs, root=_room(spark, docs, "mix"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer(), root=_room(spark, docs, "packing"))


STAGES = [
    ("quality classifier", keep_good),
    ("language identification", keep_known_languages),
    ("near-duplicates", drop_near_duplicates),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None  # learned models and the ids of a published vocabulary cannot be told in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is a written table, and the one before it is removed."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        written = Scratch(spark, f"pipeline-{name.replace(' ', '-')}")
        docs = written.stage(stage(spark, docs, sf_dir), "documents", codec="zstd")
        if before:
            before.remove()
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
