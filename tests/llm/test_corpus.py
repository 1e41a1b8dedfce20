"""Suffix sort, Merkle manifest and collocations against brute force and SQL."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import documents, odd_rows  # noqa: F401

from appkpi.llm import collocations, merkle, queries, sql, suffixes

SF_DIR = "/root/testdata/sf0.001"
NEW = ("op11_suffixes", "op12_merkle", "op13_collocations")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship(spark)


@pytest.mark.parametrize("name", NEW)
def test_registered_query_equals_its_sql(spark, name):
    d = duckdb.connect()
    d.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    found = queries.QUERIES[name](spark, SF_DIR)
    wanted = d.execute(queries.ORACLE[name])
    assert found.columns == [c[0] for c in wanted.description]
    assert sorted(map(tuple, found.collect())) == sorted(wanted.fetchall())


# Suffixes


def plain_cuts(rows, width=50):
    """(id, bytes, spans, bytes left) by looking at every window."""
    key = lambda i: (i is None, i or 0)
    least = {}
    for i, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - width + 1):
            w = raw[k : k + width]
            least[w] = min(least.get(w, (True, 1)), key(i))
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw) + 1)
        for k in range(len(raw) - width + 1):
            if least[raw[k : k + width]] < key(i):
                gone[k : k + width] = b"\1" * width
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i, len(raw), spans, bytes(x for x, g in zip(raw, gone, strict=False) if not g)))
    return sorted(out, key=str)


def found_cuts(df):
    rows = df.collect()
    return sorted(
        ((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in rows), key=str
    )


@pytest.fixture(scope="module")
def passages():
    """Texts that share passages, hold repeats of their own, and exist as copies."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 9)))
    shared = [" ".join(word() for _ in range(rng.randint(6, 40))) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else " ".join(word() for _ in range(30)))
        rows.append((i * 7 % 121, " ".join(parts)))
    rows += [(200 + k, rows[k][1]) for k in range(20)]
    # A text with itself inside, one byte many times, just under, at and over the width.
    rows += [(300, "z" * 400), (301, "z" * 130), (302, "z" * 49), (303, "z" * 50), (304, "y" * 51 + "z" * 60)]
    return rows


@pytest.mark.parametrize("chunk_bytes, hot", [(1 << 20, 256), (4000, 1), (1500, 3), (1, 256)])
def test_cuts_against_brute_force(documents, passages, chunk_bytes, hot):
    found = suffixes.cut_repeats(documents(passages), chunk_bytes=chunk_bytes, hot_chunks=hot)
    assert found_cuts(found) == plain_cuts(passages)


@pytest.mark.parametrize("width", [16, 33, 70])
def test_other_widths(documents, passages, width):
    found = suffixes.cut_repeats(documents(passages), width, chunk_bytes=5000)
    assert found_cuts(found) == plain_cuts(passages, width)


def test_cuts_of_odd_rows(documents, odd_rows):
    rows = [*odd_rows, (None, "x" * 60), (9, "x" * 60)]
    docs = documents(rows).selectExpr("*", "lang chunk", "lang spans", "lang ids", "lang kept")
    # Rows with one id take nothing from each other, rows without an id come last.
    assert found_cuts(suffixes.cut_repeats(docs)) == plain_cuts(rows)
    assert suffixes.cut_repeats(docs.limit(0)).count() == 0


def test_long_text_is_read_in_pieces(monkeypatch):
    rng = random.Random(1)
    raw = bytes(rng.choices(b"abc ", k=5000))
    whole = suffixes.runs(raw)
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 700)
    parts = suffixes.runs(raw)
    # Every window is in one run, and has the same first digit.
    for found in (whole, parts):
        assert found[2].tolist() == [0, *(found[2] + found[3])[:-1].tolist()]
    digits = [dict(zip((a + k for a, n in zip(f[2], f[3]) for k in range(n)), f[0].repeat(f[3]))) for f in (whole, parts)]
    assert digits[0] == digits[1] and len(digits[0]) == len(raw) - 49


def test_radix_finds_equal_windows_with_a_smaller_id():
    rng = random.Random(2)
    bodies = [bytes(rng.choices(b"ab", k=rng.randint(20, 60))) for _ in range(80)]
    ids, groups = [rng.randint(0, 20) for _ in bodies], [rng.randint(0, 2) for _ in bodies]
    windows = [(g, i, b[k : k + 20]) for b, i, g in zip(bodies, ids, groups) for k in range(len(b) - 19)]
    wanted = [any(g == h and w == v and j < i for h, j, v in windows) for g, i, w in windows]
    flat, sizes = np.frombuffer(b"".join(bodies), np.uint8), np.array([len(b) for b in bodies])
    found = suffixes.radix(flat, np.cumsum(sizes) - sizes, sizes, np.array(ids), np.array(groups), 20)
    assert found.tolist() == wanted and any(wanted)


# Merkle


def digest(text):
    return sha256(text.encode()).hexdigest()


def plain_proofs(rows):
    """(leaf, subroot, root, proof, folded root) of rows (doc_id, text, lang, source, n_chars)."""

    def leaf(row, text):
        values = (row[0], row[3], row[2], row[4], text)
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
        return out

    def path(tree, i):
        out = []
        for level in tree[:-1]:
            first = i - i % 3
            out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
            i //= 3
        return out

    by_source = defaultdict(list)
    for row in rows:
        by_source[row[3]].append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for own in by_source.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: levels([leaf(r, r[1]) for r in by_source[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, row in enumerate(by_source[s]):
            siblings = path(trees[s], i) + path(top, k)
            text = row[1]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(row, text)
            for a, b in siblings:
                folded = digest(a + folded + b)
            proof = digest("".join(a + b for a, b in siblings))
            out.append((row[0], leaf(row, row[1]), trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def found_proofs(docs, height):
    later = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    return sorted((tuple(r) for r in merkle.verify(docs, later, height).drop("source").collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_proofs_against_brute_force(spark, height):
    rng = random.Random(height)
    # A hot source, sources of one row, null, empty and non-ASCII names.
    sources = [None, "", "a", "é", "zz", *["hot"] * 12]
    rows = [(i, rng.choice(["x\ny", "plain", "", None, "\n"]), "en", rng.choice(sources), i) for i in range(300)]
    rows += [(1000 + i, "x", None, f"s{i}", None) for i in range(11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = found_proofs(docs.repartition(7), height)
    assert found == plain_proofs(rows)
    assert {r[-1] for r in found} == {True, False}


def test_proofs_of_odd_rows(documents, odd_rows):
    rows = [(i, t, "en", "test", None if t is None else len(t)) for i, t in odd_rows]
    docs = documents(odd_rows).selectExpr("*", "lang grp", "lang key", "lang block", "lang leaf")
    assert found_proofs(docs, 1) == plain_proofs(rows)
    assert found_proofs(docs.limit(0), 1) == []
    alone = docs.where("doc_id = 4")
    assert found_proofs(alone, 6) == plain_proofs(rows[3:4])
    # Fields that are not there count as null.
    assert merkle.verify(alone.select("doc_id", "text"), F.lit(None).cast("string")).first().verified


def test_blocks_are_in_van_emde_boas_order():
    for height in range(6):
        assert sorted(a for row in merkle.addresses(height) for a in row) == list(range(merkle.subtree_nodes(height + 1)))
    # Height 3: two levels of nodes above, then nine subtrees of two, each in one stretch of four.
    top, *_, leaves = merkle.addresses(3)
    assert top == [0] and leaves[:4] == [5, 6, 7, 9] and leaves[-1] == 39


def test_a_changed_block_is_noticed():
    leaves = [sha256(bytes([i])).digest() for i in range(7)]
    nodes = merkle.lay_out(leaves, 2)
    for k, own in enumerate(merkle.entry_paths(nodes, 7, 2)):
        folded = leaves[k].hex().encode()
        for a, b in own:
            folded = sha256(a + folded + b).hexdigest().encode()
        assert folded.decode() == nodes[:32].hex()
    assert merkle.lay_out([leaves[1], leaves[0], *leaves[2:]], 2)[:32] != nodes[:32]


# Collocations


def plain_collocations(rows, least, longest, most):
    """The SQL's result by counting in Python; rows are (text, lang)."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        own, kept = total[lang], []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for q, b in candidates.items():
            for part in {q[i:j] for i in range(len(q)) for j in range(i + 1, len(q) + 1)} - {q}:
                around[part] = max(around[part], b)
        for p, a in candidates.items():
            if around[p] >= a:
                continue
            score, k = min((1000 * a * own // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), p, f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, _, left, right) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, own, -score))
    return sorted(out)


def found_collocations(docs, least, longest=5, chunk_bytes=1 << 20, most=10_000):
    found = collocations.top(collocations.collocations(docs, least, longest, chunk_bytes), most)
    return sorted(map(tuple, found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.fixture(scope="module")
def phrases(spark):
    rng = random.Random(8)
    words = ["the", "The", "of", "a", "Paris", "x,y", "été", "\u3000wide", "no.", "one\ttwo", "\x01odd", "\n", "?"]
    fixed = ["in the end of it all", "New York City", "a a a a", "once upon a time"]
    rows = []
    for _ in range(150):
        text = " ".join(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 40)))
        rows.append((text, rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", "de"), ("word", "fr")]


@pytest.mark.parametrize("least, longest, chunk_bytes", [(3, 5, 1 << 20), (2, 5, 300), (5, 3, 1), (3, 2, 900)])
def test_collocations_against_brute_force(spark, phrases, least, longest, chunk_bytes):
    docs = spark.createDataFrame(phrases, "text string, lang string").withColumn("doc_id", F.lit(None).cast("long"))
    found = found_collocations(docs, least, longest, chunk_bytes)
    assert found == plain_collocations(phrases, least, longest, 10_000) and found


def test_limit_and_ties(spark, phrases):
    docs = spark.createDataFrame(phrases, "text string, lang string")
    assert found_collocations(docs, 3, most=5) == plain_collocations(phrases, 3, 5, 5)


def test_order_of_words_not_of_characters(spark, monkeypatch):
    """Partitions that begin inside the phrases of one word; a word sorts below a blank."""
    monkeypatch.setattr(collocations, "TASK_ROWS", 2)
    rows = [("a b c d e", "en"), ("a b", "en"), ("a \x01 b", "en"), ("a\x01 b", "en"), ("b c", "en")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert found_collocations(docs, 3) == plain_collocations(rows, 3, 5, 10_000)


def test_collocations_of_odd_rows(documents, odd_rows):
    docs = documents(odd_rows).selectExpr("*", "lang words", "lang f", "lang n", "lang chunk", "lang part")
    assert found_collocations(docs, 2) == plain_collocations([(t, "en") for _, t in odd_rows], 2, 5, 10_000)
    assert found_collocations(docs.limit(0), 2) == []


def test_scores_beyond_64_bits():
    n, a = 10**13, 10**12 - 1
    assert 1000 * a * n > 2**63
    # Both cuts floor to one score: the earlier counts.
    assert collocations.lowest_cut(a, [a + 5, a + 5], [a + 5, a + 5], n, 3) == (1000 * a * n // (a + 5) ** 2, 1)
    assert collocations.lowest_cut(a, [10**12, 2 * 10**12], [10**12, 10**12], n, 3)[1] == 2


def test_long_words_and_pieces(monkeypatch):
    raw = b"ab cd. " + b"x" * 300 + b" ab " + b"y" * 90 + b"\tab"
    whole = collocations.tokens(raw)
    monkeypatch.setattr(collocations, "PIECE_BYTES", 128)
    parts = collocations.tokens(raw)
    assert [w.tolist() for w in whole[1:]] == [w.tolist() for w in parts[1:]]
    keys = parts[0].tolist()
    assert keys[0] == keys[3] == keys[5] and len(set(keys)) == 4
    assert whole[3].tolist() == [False, True, False, True, True, True]


def test_sql_is_of_whole_tables():
    for text in (sql.REPEATS, sql.VERIFY, sql.COLLOCATIONS):
        assert "LIMIT" not in text.upper().replace("{TOP}", "") and "SAMPLE" not in text.upper()
