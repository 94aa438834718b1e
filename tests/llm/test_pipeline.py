"""The pipeline stage by stage, and as a query."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from rows import SF_DIR, edge_frame, empty_frame, with_clashes

from tidemark.llm.common import table


def test_stages_do_what_they_say(spark):
    docs = table(spark, SF_DIR, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, SF_DIR).cache()
    left = {r.doc_id for r in good.collect()}
    told = [(d, q) for d, q in labels.items()]
    assert sum((d in left) == (q == 1) for d, q in told) / len(told) > 0.9
    unique = stages["exact dedup"](spark, good, SF_DIR).cache()
    texts = [" ".join(r.text.split()) for r in unique.collect()]
    assert len(texts) == len(set(texts)) == len({" ".join(r.text.split()) for r in good.collect()})
    near = stages["n-gram Jaccard join"](spark, unique, SF_DIR).cache()
    assert near.columns == docs.columns and near.count() <= unique.count()
    mixed = stages["mixing sources"](spark, near, SF_DIR)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in near.collect()}
    assert stages["piece encoding"](spark, mixed, SF_DIR).count() == mixed.count()


def test_run_gives_what_the_stages_give(spark):
    docs = table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    digest = lambda f: hashlib.sha256("".join(sorted(map(repr, f.collect()))).encode()).hexdigest()
    assert digest(corpus_pipeline.run(spark, SF_DIR)) == digest(docs)


def test_stages_take_edge_rows(spark):
    for name, stage in corpus_pipeline.STAGES:
        docs = edge_frame(spark)
        out = stage(spark, docs, SF_DIR)
        assert out.count() >= 0, name
        assert stage(spark, empty_frame(spark), SF_DIR).count() == 0, name
        if name != "piece encoding":
            wide = with_clashes(docs)
            assert stage(spark, wide, SF_DIR).columns == wide.columns, name
