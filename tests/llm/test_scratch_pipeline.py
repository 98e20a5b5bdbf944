"""Quality stage and pipeline: scratch tables, and rows by the keys of their verdicts."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
import data
from scratch import left_by
from sheetrecon.llm import bytegrams, quality


def test_quality_stage_keeps_no_copy_of_the_rows(spark, monkeypatch):
    _, docs = data.corpus(spark)
    monkeypatch.setattr(bytegrams, "ENTRIES", 4000)  # several passes over the texts
    left = left_by(spark, lambda: quality.drop_rejected(docs))
    assert left == ["rejected"]


def test_pipeline_keeps_the_tables_of_its_stages(spark):
    assert left_by(spark, lambda: corpus_pipeline.run(spark, data.SF)) == sorted(n for n, _ in corpus_pipeline.STAGES)


def test_kept_rows_are_those_of_the_verdicts(spark):
    _, docs = data.corpus(spark)
    docs = docs.withColumn("no", F.monotonically_increasing_id()).persist()
    # language and text that are missing or empty in turn are not confused
    odd = [(None, "a"), ("a", None), ("", "a"), ("a", ""), (None, None), ("", "")]
    more = spark.createDataFrame([(-i, t, g) for i, (g, t) in enumerate(odd, 1)], "no long, text string, lang string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    want = quality.quality_rules(docs, "no").where("kept").select("doc_id").collect()
    got = quality.drop_rejected(docs)
    assert got.columns == docs.columns
    assert Counter(r.no for r in got.collect()) == Counter(r.doc_id for r in want)
