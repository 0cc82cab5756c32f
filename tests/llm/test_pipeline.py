"""The pipeline's stages: columns, decisions, and each against its own operator."""

import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import __spark_entry__ as entry
from chronoreg.llm import common, near, queries
from corpus import corpus, frame

SF = "/root/testdata/sf0.01"  # enough labelled rows to learn from


def test_registered():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "secret_scans", "mixing", "packing"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, results = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(spark, docs, SF))
        results[name] = docs
        if name != "packing":
            assert docs.columns == columns, name
    kept = {r.doc_id for r in results["quality_classifier"].select("doc_id").collect()}
    toxic = [d for d, r in labels.items() if r.toxic]
    assert sum(d in kept for d in toxic) < 0.3 * len(toxic)
    clean = [d for d, r in labels.items() if r.quality and not r.toxic]
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)
    components = {r.doc_id: r for r in near.near_duplicates(results["quality_classifier"]).collect()}
    assert {r.doc_id for r in results["near_dedup"].collect()} == {d for d, r in components.items() if r.kept}
    before, after = ({r.doc_id: r.text for r in results[n].collect()} for n in ("near_dedup", "secret_scans"))
    assert set(before) == set(after) and any(before[d] != after[d] for d in before) and all("token = \"" not in t for t in after.values())
    mixed = {r.doc_id for r in results["mixing"].select("doc_id").collect()}
    assert mixed <= set(after) and len(mixed) > 0.9 * len(after)
    assert {r.doc_id for r in results["packing"].select("doc_id").distinct().collect()} == mixed


def test_mixing_keeps_clean_documents(spark):
    """The mixing stage sees few toxic and poor documents, and still must tell them from clean ones."""
    sf = "/root/testdata/sf0.1"
    docs = common.stage(corpus_pipeline.classify_quality(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf))
    clean = spark.read.parquet(f"{sf}/labels.parquet").where("quality > 0 AND toxic = 0").select("doc_id").distinct()
    clean = {r.doc_id for r in docs.join(clean, "doc_id", "left_semi").select("doc_id").collect()}
    mixed = {r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, sf).select("doc_id").collect()}
    assert len(clean & mixed) >= 0.99 * len(clean)


def _tables(spark, folder, rows, labels):
    frame(spark, rows).withColumn("n_chars", F.char_length("text").cast("long")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_awkward_rows(spark, tmp_path):
    """Nulls, repeated rows, empty and very long texts, extra columns: whole texts come back from the packed ids."""
    rows = corpus(11) + [(7000, "long words " * 40_000, 1, "keys"), (7001, " " * 300_000, 2, "x")]
    rows += [rows[0], rows[-2]]
    sf = _tables(spark, tmp_path, rows, [(3, 1, 0), (None, 1, 1), (6, None, 0), (9, 0, 1), (9, 1, 0), (99999, 1, 1)])
    whole = Tokenizer.from_file(queries.tokenizer_paths()[0])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.stage(stage(spark, docs, sf))
        assert docs.columns == before.columns and docs.schema.simpleString() == before.schema.simpleString(), name
        if name != "mixing":
            assert docs.where("doc_id IS NULL").count() <= before.where("doc_id IS NULL").count(), name
        if name == "near_dedup":
            assert docs.where("doc_id IS NOT NULL").count() == docs.where("doc_id IS NOT NULL").select("doc_id", "text").distinct().count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    kept = [(r.doc_id, r.text or "") for r in docs.collect() if r.doc_id is not None]
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length for r in last)
    assert {r.doc_id for r in last} == {d for d, _ in kept}
    once = {d: t for d, t in kept if sum(d == x for x, _ in kept) == 1}
    for doc, text in once.items():
        parts = sorted((r.start, r.ids) for r in last if r.doc_id == doc)
        assert sum((i for _, i in parts), []) == whole.encode(text, add_special_tokens=False).ids + [2]
    assert len(corpus_pipeline.run(spark, sf).collect()) == len(last)


def test_empty_tables(spark, tmp_path):
    sf = _tables(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, sf).collect() == []
