"""Lines, tokens, packing, token files, archives, classifiers, language model and pipeline."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from datetime import UTC, datetime
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rows import documents, odd_rows  # noqa: F401
from appkpi.llm import bpe, common, lines, lm, packing, quality, token_files, toxicity, warc
from appkpi.llm.queries import ORACLE, QUERIES
from appkpi.llm.tokens import library_coder, vocabulary_path
from appkpi.llm.words import PIECE_BYTES, hash_words, hash_words_and_starts
from workloads.check import compare

SF_DIR = "/root/testdata/sf0.001"
BYTES, WORDS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("word_bpe_49k.json")
ODD_TEXTS = [
    "", "  a  b\n\n c ", "It's  don'T  x\u0085y <|endoftext|> z<|endoftext|><|endoftext|>",
    "日本語 text ﬁ", "İstanbul ǅ ÀÉ² ½ x_y a×b÷c 3²", "\x1c a\x1fb", "a\tb\r\nc   ", "é ä 'S 'LL 're",
    "ß STRASSE ẞ Σας ΟΔΟΣ", "\x00 a", "x\xadb \x7f\x80", "👍🏽 x", "ab" * 3000, "a" * 9000,
    "<|startoftext|> on <|endoftext|>",
]


def prose(rng, words=("the", "of", "and", "house", "river", "stone", "walks", "bright", "under", "tree"), n=80):
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ing", "ed"]) for _ in range(n))


# ---- registered queries with SQL ----


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, SF_DIR, QUERIES[name], ORACLE[name]) is None


def test_every_operator_has_a_query():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES if n != "pipeline"} == set(map(str, range(1, 14)))


# ---- lines ----


def plain_dedup(rows):
    first, windows = {}, {}
    for key, text in sorted({(i, t) for i, t in rows if t is not None}):
        own = [(k, x) for k, x in enumerate(text.split("\n")) if x.strip(" ")]
        windows[key, text] = [
            (tuple(x for _, x in own[k : k + 3]), own[k][0], own[k + 2][0]) for k in range(len(own) - 2)
        ]
        for w, a, z in windows[key, text]:
            first.setdefault(w, (key, text, a, z))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0))
            continue
        goes = set()
        for w, a, z in windows[i, t]:
            d, own, b, y = first[w]
            if (d, own, b) != (i, t, a):
                # It may overlap the first one, in the same text.
                goes.update(range(max(a, y + 1) if (d, own) == (i, t) else a, z + 1))
        kept = [x for k, x in enumerate(t.split("\n")) if k not in goes]
        out.append((i, "\n".join(kept), len(t.split("\n")) - len(kept)))
    return sorted(out, key=str)


def test_lines_against_brute_force(documents):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", " ", "d e", ""]) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a\na\na\na\na\na"), (103, "one\ntwo")]
    docs = documents(rows).withColumn("lines_removed", F.lit("old")).withColumn("gone", F.lit(1)).withColumn("row", F.lit(2))
    found = lines.dedup_lines(docs)
    assert found.columns == [*[c for c in docs.columns if c != "lines_removed"], "lines_removed"]
    got = sorted(((r.doc_id, r.text, r.lines_removed) for r in found.collect()), key=str)
    assert got == plain_dedup(rows)


def test_lines_of_repeated_rows_null_ids_and_no_rows(documents, odd_rows):
    rows = [(None, "k\nl\nm"), (9, "k\nl\nm\nn"), (9, "k\nl\nm\nn"), *odd_rows]
    got = [(r.doc_id, r.text) for r in lines.dedup_lines(documents(rows)).collect()]
    assert len(got) == len(rows)
    # All of k, l, m stand in the row without an id, which comes first.
    assert got.count((9, "n")) == 2 and (None, "k\nl\nm") in got
    assert lines.dedup_lines(documents(rows).limit(0)).count() == 0


def test_lines_run_no_python(documents):
    plan = lines.dedup_lines(documents([(1, "a\nb\nc")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- words ----


def test_equal_words_and_only_those_have_equal_hashes():
    rng = random.Random(1)
    parts = [bytes(rng.choices(b"ab\xc3\x00", k=rng.randint(1, 5))) for _ in range(3000)]
    raw = b"".join(p + bytes(rng.choices(b" \t\n\r\x0b\x0c", k=rng.randint(1, 3))) for p in parts)
    seen = {}
    for word, h in zip(raw.split(), hash_words(raw).tolist(), strict=True):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    assert len(hash_words(b"")) == len(hash_words(b" \n")) == 0


def test_hashes_don_t_depend_on_where_a_piece_ends():
    filler = b"abc " * (PIECE_BYTES // 4 - 2)
    raw = filler + b"x" * (3 * PIECE_BYTES) + b" last word" + filler + b"end"
    hashes = hash_words(raw)
    assert len(hashes) == len(raw.split())
    assert hashes[-1] == hash_words(b"end")[0] and hashes[0] == hash_words(b"abc")[0]
    assert list(hash_words_and_starts(raw, 2)[1][-2:]) == list(hash_words(b"ab en"))


# ---- tokens ----


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_cached_words_give_the_library_s_ids(path):
    coder = library_coder(path)
    for text in [*ODD_TEXTS, prose(random.Random(2))]:
        ids = np.frombuffer(coder.encode(text), np.uint16).tolist()
        assert ids == coder.tokenizer.encode(text, add_special_tokens=False).ids, text[:40]


def test_bpe_equals_the_library_both_ways(documents):
    tokenizer = library_coder(BYTES).tokenizer
    texts = [*ODD_TEXTS, prose(random.Random(4), n=300), None]
    docs = documents(list(enumerate(texts)))
    encoded = {r.doc_id: r.ids for r in bpe.encode(docs, BYTES).collect()}
    digests = {r.doc_id: r for r in bpe.round_trip(docs, BYTES).collect()}
    decoded = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, BYTES), BYTES).collect()}
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert encoded[i] == ids and decoded[i] == back
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    assert bpe.byte_bpe(BYTES).decode([220, 187]) == tokenizer.decode([220, 187], skip_special_tokens=False)


def test_bpe_of_odd_rows(documents, odd_rows):
    assert bpe.round_trip(documents(odd_rows), BYTES).count() == len(odd_rows)
    assert bpe.round_trip(documents(odd_rows).limit(0), BYTES).count() == 0


# ---- packing ----


def test_neighbours_on_the_curve_are_neighbours_in_space():
    cells = [(x, y, z) for x in range(8) for y in range(8) for z in range(8)]
    cells.sort(key=lambda c: packing.hilbert_key(list(c), 3))
    assert [packing.hilbert_key(list(c), 3) for c in cells] == list(range(512))
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in zip(cells, cells[1:], strict=False))


def check_packed(pieces, texts):
    """``texts``: id to text. Every id of every text once, sequences full but for the last."""
    tokenizer = library_coder(WORDS).tokenizer
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(by_doc[i], key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert sum(p.length for p in own) == len(ids) == own[0].doc_tokens
        for p in own:
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
    sizes = {}
    for s, own in by_sequence.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        sizes[s] = sum(p.length for p in own)
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(n == 2048 for s, n in sizes.items() if s < len(sizes) - 1)


def test_packed_sequences_hold_every_id_once(documents):
    rng = random.Random(6)
    texts = {i: prose(rng, n=rng.randint(1, 400)) for i in range(60)} | {90: None, 91: "", 92: "long " * 9000}
    docs = documents(list(texts.items())).withColumn("key", F.lit(0)).withColumn("row", F.lit(0))
    pieces = packing.pack(docs.repartition(3), WORDS)
    check_packed(packing.piece_digests(pieces).collect(), texts)
    whole = packing.sequences(pieces).collect()
    assert all(len(r.ids) == 2048 for r in whole)
    assert sum(x != 0 for r in whole for x in r.ids) <= sum(p.length for p in pieces.collect())


def test_packing_of_odd_rows(documents, odd_rows):
    tokens = sum(len(library_coder(WORDS).encode(t or "")) // 2 + 1 for _, t in odd_rows)
    assert packing.pack(documents(odd_rows), WORDS).agg(F.sum("length")).first()[0] == tokens
    assert packing.pack(documents(odd_rows).limit(0), WORDS).count() == 0


# ---- token files ----


@pytest.mark.parametrize("n", [1, 127, 128, 129, 16384, 16385, 65536])
def test_blocks_come_back(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(0.5, n).clip(0, 50000)).astype("<u2")
    counts = Counter(ids.tolist()) | {7: 1}
    coder = token_files.Coder(token_files.scaled(sorted(counts.items())))
    coded = coder.encode([ids.tobytes(), ids[::-1].tobytes()])
    back = coder.decode([(*c, n) for c in coded])
    assert (back[0] == ids).all() and (back[1] == ids[::-1]).all()


def test_files_hold_documents_in_order(spark, documents, folder, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 512)
    rng = random.Random(8)
    texts = {i * 3 % 61: prose(rng, n=rng.randint(0, 300)) for i in range(61)} | {200: None, 201: "tail " * 3000}
    token_files.write(documents(list(texts.items())).repartition(3), folder, BYTES)
    found = token_files.digests(token_files.read_pieces(spark, folder)).collect()
    at = 0
    for r in sorted(found, key=lambda r: r.doc_id):
        raw = library_coder(BYTES).encode(texts[r.doc_id] or "")
        ids = np.append(np.frombuffer(raw, "<u2"), 2).astype("<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(found) == len(texts)


def test_damaged_files_are_noticed(spark, documents, folder):
    token_files.write(documents([(1, "some text")]), folder, BYTES)
    broken = spark.read.parquet(f"{folder}/blocks").withColumn("ids_crc", F.lit(0).cast("long"))
    broken.write.parquet(f"{folder}-2/blocks")
    spark.read.parquet(f"{folder}/table").write.parquet(f"{folder}-2/table")
    with pytest.raises(Exception, match="damaged"):
        token_files.read_pieces(spark, f"{folder}-2").collect()


def test_files_of_odd_rows(spark, documents, odd_rows, folder):
    token_files.write(documents(odd_rows), folder, BYTES)
    assert token_files.digests(token_files.read_pieces(spark, folder)).count() == len(odd_rows)
    token_files.write(documents(odd_rows).limit(0), f"{folder}-empty", BYTES)
    assert token_files.read_pieces(spark, f"{folder}-empty").count() == 0


def test_joined_checksums():
    a, b = b"some bytes", b"and more of them"
    assert token_files.join_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


# ---- archives ----


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_archive_comes_back(spark, folder):
    same, big = "s" * 120, "é" * 400_000
    rows = [
        (3, "http://a/\n x", same), (1, None, same), (2, "u", same), (4, "u", "short"), (5, "u", "short"),
        (6, "u", None), (7, "u", ""), (8, "u", big), (9, "u", big), (None, "u", same), (10, "u", "ü" * 49 + "x"),
        (11, "u", "ü" * 49 + "x"), (12, "u", "ü" * 50), (13, "u", "ü" * 50), (1, "again", same),
    ]
    docs = pages_of(spark, rows).withColumn("digest", F.lit("x")).withColumn("first_id", F.lit(0))
    warc.write(docs.repartition(3), folder, chunk_bytes=1 << 14)
    found = warc.read(spark, folder).collect()
    first = {same: 1, big: 8, "ü" * 50: 12}
    expected = []
    for i, _, html in rows:
        raw = (html or "").encode()
        to = first.get(html)
        to = None if to == i else to
        kind = "response" if to is None else "revisit"
        expected.append((i, len(raw), hashlib.sha256(raw).hexdigest(), kind, to))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    stored = spark.read.parquet(folder)
    assert stored.agg(F.max(F.octet_length("data"))).first()[0] <= 1 << 14
    record = stored.where("chunk > 0").select("record").first()[0]
    parts = stored.where(F.col("record") == record).orderBy("chunk").collect()
    head, body = b"".join(p.data for p in parts).split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response")
    assert f"Content-Length: {len(body)}".encode() in head


def test_headers_have_what_the_standard_requires(spark, folder):
    """Mandatory fields, one record id each, revisits that name the record they stand for, HTTP blocks."""
    same = "é" * 60
    rows = [(1, "http://a/", same), (2, "http://b/", same), (3, None, "x"), (3, None, "x"), (None, "u", same), (4, "u", None)]
    warc.write(pages_of(spark, rows).repartition(2), folder, at=datetime(2026, 3, 1, 12, 30, 5, tzinfo=UTC))
    heads = [r.data for r in spark.read.parquet(folder).where("chunk = 0").collect()]
    fields = [warc.parse_header(h.split(b"\r\n\r\n", 1)[0]) for h in heads]
    for head, own in zip(heads, fields, strict=True):
        assert head.startswith(b"WARC/1.1\r\n")
        assert own["WARC-Date"] == "2026-03-01T12:30:05Z"
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", own["WARC-Record-ID"])
        assert own["WARC-Type"] in ("response", "revisit") and int(own["Content-Length"]) > 0
        assert own["Content-Type"] == "application/http; msgtype=response"
        block = head.split(b"\r\n\r\n", 1)[1]
        assert block.startswith(b"HTTP/1.1 200 OK\r\n") and block.endswith(b"\r\n\r\n")
        assert f"Content-Length: {own['X-Payload-Length']}".encode() in block
    assert len({f["WARC-Record-ID"] for f in fields}) == len(rows)
    first = next(f["WARC-Record-ID"] for f in fields if f["X-Page-ID"] == "1")
    assert [f["WARC-Refers-To"] for f in fields if f["WARC-Type"] == "revisit"] == [first, first]


@pytest.mark.parametrize("where", ["chunk <> 1", "not last", "chunk <> 0"])
def test_archive_with_a_chunk_lost(spark, folder, where):
    warc.write(pages_of(spark, [(1, "u", "x" * 5000)]), folder, chunk_bytes=1000)
    spark.read.parquet(folder).where(where).write.parquet(f"{folder}-2")
    with pytest.raises(Exception, match="missing|cut short"):
        warc.read(spark, f"{folder}-2").collect()


def test_archive_of_no_pages(spark, folder):
    warc.write(pages_of(spark, []), folder)
    assert warc.read(spark, folder).count() == 0


# ---- quality ----


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines_ = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = Counter(runs)
    inside = {i + k for i, r in enumerate(runs) if twice[r] > 1 for k in range(8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines_[:k] for k, x in enumerate(lines_)), len(inside),
    )


def test_base_counts_against_brute_force():
    rng = random.Random(9)
    texts = [*ODD_TEXTS[:-4], "w " * 8, "w " * 9, "a b c d e f g h " * 2, "x\nx\n \n \nx"]
    texts += ["".join(rng.choice(["a ", "b ", "a\n", "#", "é\t"]) for _ in range(rng.randint(0, 200))) for _ in range(50)]
    for text in texts:
        assert quality.base_counts(text, hash_words(text.encode())) == plain_counts(text), text[:40]


@pytest.fixture(scope="module")
def graded():
    rng = random.Random(10)
    good = [(i, prose(rng, n=rng.randint(25, 150)), 1, 0) for i in range(150)]
    junk = [(200 + i, " ".join(w + rng.choice(["***", "%%%", "&&&"]) for w in prose(rng, n=60).split()), 0, 0) for i in range(100)]
    bad = [(400 + i, prose(rng, n=60) + rng.choice([" dreadful", " HORRID.", " vile!"]) + " " + prose(rng, n=30), 1, 1) for i in range(100)]
    return good + junk + bad


@pytest.fixture
def labels(spark, graded):
    return spark.createDataFrame([(i, q, t) for i, _, q, t in graded], "doc_id long, quality int, toxic int")


def test_quality_keeps_good_texts_and_drops_junk(documents, graded, labels, odd_rows):
    docs = documents([(i, t) for i, t, _, _ in graded])
    model = quality.train(docs, labels, F.col("doc_id") % 3 != 0)
    unseen = {i: q for i, _, q, _ in graded if i % 3 == 0}
    found = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    assert sum(found[i].kept == bool(q) for i, q in unseen.items()) >= 0.97 * len(unseen)
    assert all(0 <= r.probability <= 1 for r in found.values())
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}
    odd = documents(odd_rows)
    assert quality.score_quality(odd, model).count() == len(odd_rows)
    assert quality.keep_good(odd.limit(0), model).count() == 0
    untaught = quality.train(docs.limit(0), labels.limit(0))
    assert quality.score_quality(docs, untaught).where("not kept and not base_failed").count() == 0


def test_repeated_words_fail(documents):
    model = quality.fit(iter(()))
    rows = [(1, "again and again " * 20), (2, "few words"), (3, prose(random.Random(11), n=60))]
    found = {r.doc_id: r.base_failed for r in quality.score_quality(documents(rows), model).collect()}
    assert found == {1: True, 2: True, 3: False}


# ---- toxicity ----


def test_toxic_words_are_found_in_unseen_texts(spark, documents, graded, labels, odd_rows):
    docs = documents([(i, t) for i, t, _, _ in graded])
    model = toxicity.train(docs, labels, F.col("doc_id") % 3 != 0)
    unseen = {i: t for i, _, _, t in graded if i % 3 == 0}
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert sum((found[i].score >= 0.5) == bool(t) for i, t in unseen.items()) >= 0.95 * len(unseen)
    clean = toxicity.keep_clean(docs, model)
    assert {r.doc_id for r in clean.collect()} == {i for i, r in found.items() if not r.flagged}
    other = toxicity.score_toxicity(docs.withColumn("lang", F.lit("xx")).drop("source"), model).collect()
    assert all(r.score == found[r.doc_id].score and r.threshold == 0.5 for r in other)
    odd = toxicity.score_toxicity(documents(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.keep_clean(documents(odd_rows).limit(0), model).count() == 0
    untaught = toxicity.train(docs, labels.limit(0))
    assert toxicity.score_toxicity(docs, untaught).where("flagged").count() == 0


def test_windows_over_chunk_borders(monkeypatch):
    model = toxicity.new_model()
    model.table[:] = np.random.default_rng(0).normal(size=model.table.shape)
    rows = toxicity.table_rows(prose(random.Random(12), n=500))
    whole = model.pooled(rows)
    monkeypatch.setattr(toxicity, "CHUNK_WORDS", 7)
    parts = model.pooled(rows)
    assert np.allclose(whole[0], parts[0], atol=1e-4)


# ---- language model ----


@pytest.fixture(scope="module")
def two_languages():
    rng = random.Random(13)
    first = [a + b for a in ("the", "and", "whe") for b in ("n", "re", "st", "ing", "ed", "m")]
    second = [a + b for a in ("ment", "eau", "qui") for b in ("la", "er", "te", "re", "ai", "on")]
    return [(i, prose(rng, first if i % 2 else second, n=60)) for i in range(300)]


def test_model_beats_the_word_shares(documents, two_languages, odd_rows, monkeypatch):
    monkeypatch.setattr(lm, "HOT_WORDS", 20)
    rows = two_languages + [(1000 + k, t) for k, (_, t) in enumerate(odd_rows)]
    docs = documents(rows).repartition(3)
    held = F.col("doc_id") % 7 == 2
    monkeypatch.setattr(lm, "SCORE_TOKENS", 500)
    monkeypatch.setattr(lm, "HOT_SHARE", 50)
    model, counts, pairs = lm.train(docs.where("doc_id % 7 <> 2"))
    found = lm.score(docs, model, counts, pairs, held).collect()
    assert len(found) == len(rows)
    seen = Counter()
    for i, text in rows:
        if i % 7 != 2:
            seen.update([*(text or "").lower().encode().split(), "end"])
    n, kinds = sum(seen.values()), len(seen)
    texts = dict(rows)
    for r in found:
        words = [*(texts[r.doc_id] or "").lower().encode().split(), "end"]
        base = sum(math.log10((seen[w] + 1) / (n + kinds + 1)) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(seen[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base) and r.score < 0
    held_out = [r for r in found if r.held_out and r.doc_id < 1000]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out) + 0.15 * sum(r.n_tokens for r in held_out)


def plain_pairs(pairs):
    """Natural log that each pair adds, and each context where a pair is not known."""
    known, contexts = {}, {}
    for r in pairs.collect():
        for out, keys, logs in (
            (known, lm.unpacked(r.codes, r.shard), r.logs),
            (contexts, np.frombuffer(r.contexts, np.uint64), r.context_logs),
        ):
            out.update(zip(((r.shard, k) for k in keys.tolist()), np.frombuffer(logs, np.float32).tolist()))
    return known, contexts


@pytest.mark.parametrize("hot_share", [1, 200, 200_000])
def test_probabilities_of_all_words_sum_to_one(documents, two_languages, hot_share, monkeypatch):
    monkeypatch.setattr(lm, "HOT_SHARE", hot_share)
    model, counts, pairs = lm.train(documents(two_languages))
    words = {r.word: r for r in counts.collect()}
    known, contexts = plain_pairs(pairs)
    of_hot = dict(zip(model.contexts.tolist(), model.context_logs.tolist()))
    hot_pairs = dict(zip(model.pairs.tolist(), model.pair_logs.tolist()))

    def pair_log(code):
        code = np.array([code], np.uint64)
        shard = lm.shard_of(code, model.shards)
        code = lm.in_shard(code, shard)
        context, at = int(lm.context_of(code)[0]), int(shard[0])
        if context in of_hot:
            at = int(lm.spread_shard(shard, code, model.shards)[0])
            rest = known.get((at, int(lm.in_shard(code, at)[0])), 0)
            return of_hot[context] + hot_pairs.get(int(code[0]), rest)
        return known.get((at, int(code[0])), contexts.get((at, context), 0))

    text = two_languages[0][1]
    text_words, buckets = lm.words_and_buckets(text)
    history = lm.history_rows(text_words, buckets)
    n = len(text_words) + 1
    log_p = np.stack([model.log_probabilities(history, np.full(n, c)) for c in range(lm.CLASSES + 1)], axis=1)
    assert np.allclose(np.exp(log_p).sum(axis=1), 1, atol=1e-4)
    # After a word: every bucket of every class, and inside a bucket its words and one place for unseen ones.
    last = np.repeat(text_words[3], lm.BUCKETS)
    every = np.arange(lm.BUCKETS)
    codes = np.array([lm.pair_codes(np.array([h, h]), model.classes[[b, b]], np.array([b, b]))[1] for h, b in zip(last, every)])
    chance = model.share * np.exp([pair_log(c) for c in codes.tolist()])
    assert np.allclose(np.bincount(model.classes, chance, lm.CLASSES)[np.unique(model.classes)], 1, atol=1e-3)
    # The score of the text, word by word.
    score = 0.0
    pair_codes = lm.pair_codes(text_words, model.classes[buckets], buckets).tolist()
    for k, word in enumerate([*text_words.view(np.int64).tolist(), None]):
        c = lm.CLASSES if word is None else model.classes[buckets[k]]
        n = model.texts if word is None else words[word].n
        pair = 0 if word is None else pair_log(pair_codes[k])
        score += (log_p[k, c] + pair) / math.log(10) + math.log10(n + 1) - model.log_mass[c]
    found = lm.score(documents([two_languages[0]]), model, counts, pairs, F.lit(True)).first()
    assert found.score == pytest.approx(score, rel=1e-5)


def test_pair_weights_follow_the_counts(documents, two_languages):
    """Where the pull to zero is weak against the counts, a pair's chance is its share of the context."""
    share = np.full(lm.BUCKETS, 1 / lm.BUCKETS)
    codes = np.array([1 << 40 | 5, 1 << 40 | 9, 2 << 40 | 5], np.uint64)
    contexts, log_z, total, weight = lm.fit_pairs(share, codes, np.array([6000, 2000, 900]))
    assert contexts.tolist() == [1 << 40, 2 << 40] and total.tolist() == [8000, 900]
    chance = np.exp(weight - log_z[[0, 0, 1]]) / lm.BUCKETS
    assert np.allclose(chance, [0.75, 0.25, 1], atol=0.01)


@pytest.mark.parametrize("group_bytes", [1, 40, 1 << 16])
def test_texts_together_are_as_texts_alone(odd_rows, group_bytes, monkeypatch):
    """No text sees the words of another, whichever texts are hashed together; empty ones take their place."""
    monkeypatch.setattr(lm, "GROUP_BYTES", group_bytes)
    texts = [t for _, t in odd_rows] + ["", None, "a", "b a", " ", "a b a", "x" * (PIECE_BYTES + 9), "", "c d e f g"]
    classes = np.arange(lm.BUCKETS) % lm.CLASSES
    at = 0
    for rows, words, buckets, sizes in lm.in_groups((k, t) for k, t in enumerate(texts)):
        assert [k for (k,) in rows] == list(range(at, at + len(sizes)))
        alone = [lm.words_and_buckets(t) for t in texts[at : at + len(sizes)]]
        assert sizes.tolist() == [len(w) for w, _ in alone]
        assert words.tolist() == [h for w, _ in alone for h in w.tolist()]
        history = np.concatenate([lm.history_rows(w, b) for w, b in alone], axis=1)
        assert (lm.history_rows(words, buckets, sizes) == history).all()
        pairs = np.concatenate([lm.pair_codes(w, classes[b], b) for w, b in alone])
        assert (lm.pair_codes(words, classes[buckets], buckets, sizes) == pairs).all()
        at += len(sizes)
    assert at == len(texts)


def test_used_steps_are_removed(documents, two_languages, tmp_path):
    """Training leaves the tables that scoring reads, and nothing else."""
    docs = documents(two_languages[:30])
    folder = Path(common.new_folder(docs.sparkSession, "x").removeprefix("file:")).parent
    before = set(folder.iterdir()) if folder.exists() else set()
    lm.train(docs)
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert left == {"word-counts", "pair-weights"}


def test_language_model_of_no_texts(documents):
    none = documents([(1, "a")]).limit(0)
    model, counts, pairs = lm.train(none)
    assert lm.score(none, model, counts, pairs, F.lit(False)).count() == 0
    r = lm.score(documents([(1, "a b")]), model, counts, pairs, F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0)


# ---- pipeline ----


def test_stages_against_brute_force(spark):
    """Every stage's decisions, on its own input, against what they should have been."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == columns and dict(out.dtypes) == dict(docs.dtypes)
        before = {r.doc_id: r for r in docs.collect()}
        # Written and read again, as between stages.
        path = f"{spark.conf.get('spark.checkpoint.dir')}/{name}-{random.getrandbits(60):x}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = before, {r.doc_id: r for r in docs.collect()}
    before, after = seen["quality_rules"]
    assert all(plain_counts(r.text)[0] >= 20 for r in after.values())
    assert all(after[i] == before[i] for i in after) and 0.5 * len(before) < len(after) < len(before)
    before, after = seen["line_dedup"]
    expected = {i: t for i, t, _ in plain_dedup([(r.doc_id, r.text) for r in before.values()])}
    assert {i: r.text for i, r in after.items()} == expected
    assert all(r.n_chars == len(r.text) for r in after.values())
    before, after = seen["simhash_dedup"]
    from test_pairs import plain_fingerprint, roots

    prints = {i: plain_fingerprint(r.text) for i, r in before.items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    assert set(after) == set(roots(prints, links).values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    check_packed(pieces, {r.doc_id: r.text for r in docs.collect()})


def test_duckdb_reads_the_same_tables():
    assert duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/documents.parquet'").fetchall()[0][0] > 0
