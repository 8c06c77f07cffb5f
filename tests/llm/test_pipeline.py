"""The pipeline on whole tables of the smallest scale: each stage against a plain version of its rule."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from stratavault.llm import mixing, quality
from .test_decontaminate import brute
from .test_simhash import plain_components, plain_fingerprint

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        kept.append(out.collect())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == docs.columns
        docs = spark.createDataFrame(kept[-1], out.schema)
    ids = [{r.doc_id for r in rows} for rows in kept]
    assert all(len(rows) == len(i) for rows, i in zip(kept, ids, strict=True))

    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    judged = quality.judged(spark.read.parquet(f"{DATA}/documents.parquet"), labels).collect()
    assert ids[1] == {r.doc_id for r in judged if r.predicted == 1}

    classes = {}
    for r in kept[1]:
        classes.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), r.doc_id))
    assert ids[2] == {min(c)[1] for c in classes.values()}

    roots = plain_components({r.doc_id: plain_fingerprint(r.text) for r in kept[2]}, 2)
    assert ids[3] == set(roots.values())

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute([(r.doc_id, r.text) for r in kept[3]], items)}
    assert leaked and ids[4] == ids[3] - leaked

    taken = mixing.mixed(spark.createDataFrame(kept[4]))
    assert {(r.doc_id, r.copies) for r in kept[5]} == {(r.doc_id, r.taken // r["size"]) for r in taken.collect() if r.taken}
    assert ids[5] == {r.doc_id for r in corpus_pipeline.run(spark, DATA).select("doc_id").collect()}
