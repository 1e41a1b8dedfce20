"""Labelled samples are bounded by rows, and the package reaches the tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from rows import documents  # noqa: F401

from appkpi.llm import quality, toxicity
from appkpi.llm.labelled import labelled_rows, labelled_sample


def test_rows_that_share_an_id_are_one(spark, documents):
    docs = documents([(i, f"text {i}") for i in range(40)])
    many = spark.range(50_000).select(
        F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("copy "), "id").alias("text"),
        F.lit("en").alias("lang"), F.lit("test").alias("source"), F.lit(1).cast("long").alias("n_chars"),
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    sample = labelled_sample(docs.unionByName(many), labels, "toxic", F.lit(True), 10).collect()
    assert sorted(r.y for r in sample) == [0] * 10 + [1] * 10
    assert len({r.doc_id for r in sample}) == 20
    again = labelled_sample(many.repartition(9).unionByName(docs), labels, "toxic", F.lit(True), 10).collect()
    assert sorted(sample) == sorted(again)


def test_classifiers_learn_from_every_labelled_row(spark, documents, monkeypatch):
    rows = [(i, ("badword stays here " if i % 2 else "good thing is here ") + f"text {i % 7}") for i in range(300)]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(300)], "doc_id long, quality int, toxic int")
    learned = []
    for module in (quality, toxicity):
        taken = []

        def rows_of(*args, taken=taken):
            taken.append(labelled_rows(*args))
            return taken[0]

        monkeypatch.setattr(module, "labelled_rows", rows_of)
        learned.append(module.train(docs, labels, shard_rows=50))
        found = taken[0].collect()
        assert sorted(r.doc_id for r in found) == list(range(300))
        assert 3 <= len({r.shard for r in found}) <= 6 and {r.held for r in found} == {True, False}
    again = toxicity.train(docs.repartition(7), labels.repartition(3), shard_rows=50)
    assert np.array_equal(again.table, learned[1].table) and again.thresholds == learned[1].thresholds
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, learned[1]).collect()}
    assert all((s >= 0.5) == bool(i % 2) for i, s in scores.items())
    good = {r.doc_id: r.probability for r in quality.score_quality(docs, learned[0]).collect()}
    assert all((p >= 0.5) == bool(i % 2) for i, p in good.items())
