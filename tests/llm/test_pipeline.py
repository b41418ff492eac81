from __future__ import annotations

import corpus_pipeline
from tidemark.llm import jaccard_join


def test_stages_keep_columns_and_pack_what_is_left(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialise(stage(spark, docs, data_dir), "test-stage")
        assert after.columns == docs.columns
        assert after.join(docs, "doc_id", "left_anti").count() == 0
        docs = after
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True)
    groups = jaccard_join.similar_groups(docs, corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)
    assert groups.count() == counts[-1]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data_dir)
    assert packed.select("doc_id").distinct().count() == counts[-1]
