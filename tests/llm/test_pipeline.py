"""The pipeline's stages, and the queries with SQL against it."""

from __future__ import annotations

import pytest

import corpus_pipeline
from joulemart.llm.queries import QUERIES
from tests.llm.edge_rows import documents, shingles


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_queries_equal_their_sql(spark, sf_dir, duck, name):
    run, sql = QUERIES[name]
    frame = run(spark, sf_dir)
    relation = duck(sf_dir).sql(sql)
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)
    order = [relation.columns.index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=str)


def test_stages_on_the_small_tables(spark, sf_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "ngram_jaccard_join", "mix_sources", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = corpus_pipeline.keep_quality(spark, docs, sf_dir).persist()
    assert good.columns == docs.columns
    kept = {r["doc_id"] for r in good.collect()}
    assert sum(labels[i] == 1 for i in labels if i in kept) >= 0.97 * sum(labels.values())
    single = corpus_pipeline.keep_one_of_similar(spark, good, sf_dir).collect()
    left = {r["doc_id"]: shingles(r["text"], 5) for r in single}
    assert len(left) == len(single)
    for i, a in left.items():
        assert not any(i < j and a and 100 * len(a & b) >= 80 * len(a | b) for j, b in left.items())
    for r in good.collect():
        own = shingles(r["text"], 5)
        assert r["doc_id"] in left or any(100 * len(own & b) >= 80 * len(own | b) for b in left.values()) or own
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.count() > 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(packed.columns)


def test_similar_stage_on_odd_rows(spark, sf_dir):
    docs = documents(spark)
    kept = corpus_pipeline.keep_one_of_similar(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 4, 5, 6, 7, 9, 10, 11, 12, None, None], key=str)


def test_rows_with_one_id_are_judged_by_their_own_text(spark, sf_dir):
    base, other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in ("a", "b", "c"))
    rows = [
        (1, base), (7, base + " more"), (7, other), (7, other), (7, ""),
        (5, third), (5, third + " more"), (5, " ".join(f"d{i}" for i in range(60))), (9, third + " end"), (6, other + " end"),
    ]
    full = [(i, t, "en", "s", len(t), k, "x") for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(full, documents(spark).schema)
    kept = corpus_pipeline.keep_one_of_similar(spark, docs, sf_dir)
    found = sorted((r["doc_id"], r["text"][:1]) for r in kept.collect())
    assert found == [(1, "a"), (5, "c"), (5, "d"), (6, "b"), (7, "")]
    alone = corpus_pipeline.keep_one_of_similar(spark, docs.filter("doc_id <> 6"), sf_dir)
    assert sorted((r["doc_id"], r["text"][:1]) for r in alone.collect()) == [(1, "a"), (5, "c"), (5, "d"), (7, ""), (7, "b")]


def test_stages_take_empty_tables(spark, sf_dir):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
