"""Rows that meet the labels."""

from appkpi.llm import labelled


def test_rows_without_a_label_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i if i < 3000 else None, f"t{i}") for i in range(3001)], "doc_id long, text string")
    clear = spark.createDataFrame([(i, 1) for i in range(0, 4000, 50)], "doc_id long, y int")
    found = [r.doc_id for r in labelled.likely_labelled(docs, clear, clear.count()).collect()]
    assert set(range(0, 3000, 50)) <= set(found) and len(found) == len(set(found)) < 300
    # A map that is too small lets more rows through, and loses none.
    assert labelled.likely_labelled(docs, clear, 0).join(clear, "doc_id").count() == 60
