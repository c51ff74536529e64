import os
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from tests.llm.tables import awkward, documents
from tidelake.llm import quality, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def test_held_out_accuracy(spark):
    found = queries.op6_quality_classifier(spark, SF_DIR).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").df()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert len(found) == duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/documents.parquet'").limit(1).fetchall()[0][0]
    assert len(held) > 30
    assert (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.99
    assert ((found.score >= 0) & (found.score <= 1)).all()
    assert ((found.score >= 0.3) == (found.predicted == 1)).all()


def test_awkward_rows_and_few_labels(spark):
    docs = documents(spark, awkward())
    for labels in ([], [(4, 1, 0)], [(4, 1, 0), (5, 0, 1), (6, 1, 0), (7, None, 0), (None, 1, 0), (9, 0, 0), (9, 0, 0)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int, text int")
        model, ratios = quality.learn(docs, table, "quality", lambda c: F.lit(True))
        scores = quality.scored(docs, model, ratios).collect()
        assert len(scores) == len(awkward()) and all(0 <= r.score <= 1 for r in scores)
        assert quality.accepted(docs, model, ratios, 0.0).count() == len(awkward())
        assert quality.accepted(docs, model, ratios, 1.1).count() == 0
        assert quality.scored(documents(spark, []), model, ratios).count() == 0


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(2)
    rows = [np.unique(np.r_[rng.integers(0, 50, 8), 60 + int(i % 2)]) for i in range(200)]
    labels = np.array([i % 2 for i in range(200)])
    w, bias = quality.dual_coordinate_descent(rows, labels, np.ones(64), 10.0, 100, 1)
    margin = quality.margins(rows, w, np.ones(64), bias)
    assert ((margin > 0) == (labels > 0)).all()


def test_counts_cover_all_training_rows(spark):
    """Ratios come from every labelled row, also with a sample of a few."""
    rows = [(i, "good words here" if i % 2 else "bad stuff there") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    _, few = quality.learn(documents(spark, rows).repartition(3), labels, "quality", lambda c: F.lit(True), most_rows=20)
    _, all_ = quality.learn(documents(spark, rows), labels, "quality", lambda c: F.lit(True), most_rows=10_000)
    assert np.array_equal(few, all_)


def test_memory_of_features_does_not_grow_with_the_batch():
    rng = np.random.default_rng(5)
    texts = pa.array([" ".join(f"w{k}" for k in rng.integers(0, 50_000, 200)) for _ in range(3000)])
    assert texts.nbytes > 3 << 20
    tracemalloc.start()
    assert sum(end - first for first, end, _, _ in quality.Featurizer().batches(texts)) == len(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 << 20
