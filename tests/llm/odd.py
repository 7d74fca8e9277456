"""Small frames with everything that may go wrong in a table of documents."""

import random

from pyspark.sql import types as T

CLASHING = ["row", "size", "part", "key", "digest", "n", "rep", "component", "label", "held_out", "score", "block"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(name, T.StringType()) for name in CLASHING),
    ]
)


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    """Frequent words come often: a rough Zipf draw over invented words of letters."""
    pick = random.Random(seed)
    named = str.maketrans("0123456789", "abcdefghij")
    return [f"w{int(vocabulary ** pick.random())}x".translate(named) for _ in range(n)]


def mutated(found: list[str], seed: int, changes: int) -> list[str]:
    pick = random.Random(seed)
    out = list(found)
    for at in pick.sample(range(len(out)), changes):
        out[at] = f"new{seed}q{at}"
    return out


def odd_texts() -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empty and long texts, ties and repeated rows."""
    base = words(1, 160)
    rows = [(i, " ".join(words(100 + i, 80 + 7 * i)), "en" if i % 3 else "de", f"s{i % 4}") for i in range(30)]
    rows += [(100 + i, " ".join(mutated(base, i, i % 14)), "en", "hot") for i in range(40)]
    rows += [
        (200, None, "en", "s0"),
        (201, "", None, None),
        (202, " \t\n ", "en", None),
        (203, "Word", None, "s1"),
        (204, "word", "de", "s1"),
        (205, " ".join(words(9, 30_000)), "en", "s2"),
        (206, "é ü  two  blanks\n end <|endoftext|> \\ [INST] 🙂 " * 3, "fr", "s3"),
        (207, "1234 5678 !!", "de", "s3"),
        (None, "a row without an id", "en", "s1"),
        (None, None, None, None),
        (3, " ".join(words(103, 80 + 21)), "de", "s3"),
        (3, " ".join(words(103, 80 + 21)), "de", "s3"),
        (5, "another text under a known id", "en", "s9"),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, len(row[1] or ""), *CLASHING) for row in rows], SCHEMA)


def odd_docs(spark):
    return frame(spark, odd_texts())


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [row.asDict() for row in df.collect()]
