"""The pipeline's line dedup removes all that later occurrences cover."""

from __future__ import annotations

import random

from rows import documents  # noqa: F401

import corpus_pipeline
from appkpi.llm import lines


def plain_cut(rows):
    first, out = {}, {}
    for i, text in sorted(rows):
        parts, gone = text.split("\n"), set()
        own = [k for k, x in enumerate(parts) if x.strip(" ")]
        for k in range(len(own) - 2):
            a, z = own[k], own[k + 2]
            d, b, y = first.setdefault(tuple(parts[j] for j in own[k : k + 3]), (i, a, z))
            if (d, b) != (i, a):
                gone |= {j for j in range(a, z + 1) if d != i or j > y}
        out[i] = "\n".join(x for j, x in enumerate(parts) if j not in gone)
    return out


def test_passage_inside_a_document_that_has_a_copy(documents):
    passage = ["p1", "p2", "p3", "p4"]
    whole = "\n".join(["x1", "x2", *passage, "y1", "y2"])
    rows = [(1, "\n".join(["a", *passage, "b"])), (5, whole), (6, whole)]
    found = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(None, documents(rows), "").collect()}
    assert found == {1: rows[0][1], 5: "x1\nx2\ny1\ny2", 6: ""}
    again = lines.dedup_lines(documents(rows))
    assert {r.doc_id: (r.text, r.lines_removed) for r in again.collect()} == {
        1: (rows[0][1], 0), 5: ("x1\nx2\ny1\ny2", 4), 6: ("", 8)
    }


def test_passages_against_brute_force(documents):
    rng = random.Random(6)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", " ", "d e", ""]) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(101, ""), (102, "z\nz\nz\nz\nz\nz"), (103, "z\nz\nz\nz"), (104, "q\n\nq\nq\nq\n \nq")]
    docs = documents(rows)
    found = corpus_pipeline.line_dedup(None, docs, "").collect()
    assert {r.doc_id: r.text for r in found} == plain_cut(rows)
    assert all(r.n_chars == len(r.text) for r in found)
    for line in {x for _, t in rows for x in t.split("\n")}:
        assert any(line in r.text.split("\n") for r in found)
