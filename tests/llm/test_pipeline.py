from __future__ import annotations

import corpus_pipeline
import pytest
from cases import documents, labels, near_free, shingles

from tradelake.llm import language, mixing, packing, quality


def test_stages_in_order(spark, sf_dir):
    """Each stage gets what the one before it kept, and its decisions take effect."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir).persist()
        kept[name] = docs.count()
        if name != "best-fit packing":
            assert docs.columns == columns
        if name == "quality classifier":
            assert kept[name] == quality.score(before, model).filter("predicted = 1").count()
        if name == "language ID":
            assert kept[name] == before.count() - language.identify(before, language.fit(before)).filter("lang_rejected").count()
        if name == "n-gram Jaccard join":
            assert near_free([shingles(r.text) for r in docs.collect()])
            assert not near_free([shingles(r.text) for r in before.collect()])
        if name == "mixing sources to target weights":
            words = sum(r.taken for r in mixing.mix(before).collect())
            assert sum(len(r.text.split()) for r in docs.collect()) == words
        if name == "best-fit packing":
            assert docs.agg({"length": "sum"}).first()[0] == packing.pieces(before).agg({"length": "sum"}).first()[0]
    assert min(kept.values()) > 50


def test_run_gives_the_last_stage(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 50
    first, second = (sorted(map(str, corpus_pipeline.run(spark, sf_dir).drop("sequence_id", "offset").collect())) for _ in range(2))
    assert first == second


@pytest.mark.parametrize("rows", [[], None])
def test_odd_documents(spark, scratch, rows):
    documents(spark, *([] if rows is None else [rows])).write.parquet(f"{scratch}/documents.parquet")
    labels(spark).write.parquet(f"{scratch}/labels.parquet")
    assert (corpus_pipeline.run(spark, scratch).count() == 0) == (rows == [])
