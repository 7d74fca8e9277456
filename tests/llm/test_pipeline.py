import os

import corpus_pipeline
from odd import empty_docs, frame, odd_docs, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as entry


def test_stages_keep_columns_and_take_effect(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = [docs.count()]
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, folder)
        if at < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == docs.columns
        made.write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3] > 0
    assert docs.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 1024
    assert entry.queries()["pipeline"](spark, folder).count() == counts[-1]


def test_odd_documents_pass_every_stage(spark, folder):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, folder)
        assert made.columns == docs.columns and made.count() >= 0
        docs = frame(spark, [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows_of(made)])
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() > 0


def test_every_operator_is_registered():
    names = entry.queries()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1


def test_copies_of_a_run_are_removed(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    made = corpus_pipeline.run(spark, folder)
    assert made.count() > 0
    left = {name.rpartition("-")[0] for name in set(os.listdir(shared)) - before}
    assert left == {"pipeline-source-mix", "packing"}  # what the result still reads


def test_copies_that_are_still_read_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    distinct = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    rows = corpus_pipeline.mix_sources(spark, distinct, folder)  # not written in between
    assert distinct.count() > 0 and rows.count() > 0


def test_empty_table_passes_every_stage(spark, folder):
    docs = empty_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, folder)
        assert made.columns == docs.columns and made.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
