"""SimHash and embedding near-duplicates against all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from rows import documents, odd_rows  # noqa: F401

from appkpi.llm import common, embeddings, simhash


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(3)
    rows, vocabulary = [], [f"w{i}" for i in range(300)]
    for group in range(12):
        words = rng.choices(vocabulary, k=rng.randint(5, 120))
        for _ in range(rng.randint(1, 9)):
            own = list(words)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 101 + 1000 * group, " ".join(own)))
    return rows


def test_fingerprint_is_the_majority_of_shingles(near_copies, odd_rows):
    for _, text in near_copies + odd_rows[:5] + odd_rows[7:]:
        assert simhash.fingerprint(text) & (2**64 - 1) == plain_fingerprint(text)


def test_components_are_those_of_all_pairs(documents, near_copies):
    found = {r.doc_id: r for r in simhash.near_duplicates(documents(near_copies)).collect()}
    prints = {i: plain_fingerprint(t) for i, t in near_copies}
    links = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert links
    expected = roots(prints, links)
    assert {i: (r.fingerprint, r.component_id) for i, r in found.items()} == {
        i: (f"{prints[i]:016x}", expected[i]) for i in prints
    }


@pytest.mark.parametrize("seed", range(4))
def test_every_link_within_four_bits_shares_a_bucket_and_passes_its_chain(seed):
    rng = random.Random(seed)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        met = 0
        for chain in range(2 * simhash.SEGMENTS):
            start, half = divmod(chain, 2)
            bounds = simhash.segment_bounds()
            at, width = bounds[start]
            then, wide = bounds[(start + 1) % simhash.SEGMENTS]
            cut = (then, wide // 2) if not half else (then + wide // 2, wide - wide // 2)
            if all((a ^ b) >> p & ((1 << w) - 1) == 0 for p, w in ((at, width), cut)):
                met += bool(simhash.link_block(np.array([a, b], np.uint64), chain))
        assert met


def test_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    # 60 fingerprints in one chain of links, all in the same buckets of the upper segments.
    fps = [0]
    for i in range(59):
        fps.append(fps[-1] ^ (0b111 << (i % 10)))
    fps = sorted(set(fps))
    monkeypatch.setattr(simhash, "in_blocks", lambda df, keys, spread: common.in_blocks(df, keys, spread, 7))
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    wanted = [(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 4]
    assert roots(fps, [(r.a, r.b) for r in found]) == roots(fps, wanted)


def test_keep_first_leaves_one_row_of_each_group(documents, near_copies, odd_rows):
    odd = [(None if i is None else 50_000 + i, t) for i, t in odd_rows]
    docs = documents(near_copies + odd + [(60_000, near_copies[0][1])])
    kept = simhash.keep_first(docs).collect()
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect() if r.doc_id}
    assert len(kept) == len({r.doc_id for r in kept})
    assert {r.doc_id for r in kept if r.doc_id} == {i for i, c in found.items() if i == c}
    assert kept[0].asDict().keys() == set(docs.columns)


def test_odd_rows_and_extra_columns(spark, documents, odd_rows):
    docs = documents(odd_rows).selectExpr("*", "lang fp", "lang node", "lang root", "lang h")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(odd_rows)
    by_id = {r.doc_id: r for r in found}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[1].fingerprint == "0" * 16
    assert len(simhash.keep_first(docs).columns) == len(docs.columns)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(200, 240)]
    links += [(7, 7), (9, 8), (8, 9), (None, 3)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(5)
    found = {r.node: r.root for r in common.components(frame).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert found == roots({x for e in real for x in e}, real)


def all_links(rows, least=0.98):
    unit = {}
    for k, (_, values, label) in enumerate(rows):
        if label is None or values is None or None in values:
            continue
        x = np.array(values, float)
        if len(x) and np.isfinite(x).all() and x.any():
            unit[k] = (label, x / np.linalg.norm(x))
    return [
        (a, b) for a, b in combinations(unit, 2)
        if unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1])
        and unit[a][1] @ unit[b][1] >= least
    ]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def check_vectors(found, rows):
    links = all_links(rows)
    n_links = {r[0]: 0 for r in rows}
    for a, b in links:
        n_links[rows[a][0]] += 1
        n_links[rows[b][0]] += 1
    expected = roots([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == {
        i: (n_links[i], expected[i], expected[i] == i) for i in n_links
    }


@pytest.mark.parametrize("block", [2000, 6])
def test_links_are_those_of_all_pairs(spark, monkeypatch, block):
    rng = np.random.default_rng(1)
    rows = []
    for group in range(15):
        centre = rng.normal(size=64)
        for _ in range(rng.integers(1, 14)):
            vector = centre + rng.normal(size=64) * 0.11
            rows.append((len(rows) * 11 % 997, vector.tolist(), group % 3))
    rows += [(2000 + k, rows[0][1], rows[0][2]) for k in range(4)]
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in rows]
    monkeypatch.setattr(embeddings, "in_blocks", lambda df, keys, spread: common.in_blocks(df, keys, spread, block))
    assert len(all_links(rows)) > 100
    check_vectors(embeddings.near_duplicates(vectors(spark, rows)).collect(), rows)


def test_odd_vectors_link_with_nothing(spark):
    one = [1.0, 0.5, 0.25]
    rows = [
        (1, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 0.25], 1), (9, [1.0, float("nan"), 0.25], 1),
        (10, [1.0, float("inf"), 0.25], 1), (11, [*one, 0.0], 1), (12, [2.0, 1.0, 0.5], 1),
        (13, [1e30, 5e29, 2.5e29], 1),
    ]
    frame = vectors(spark, rows).selectExpr("*", "label node", "label root", "label unit")
    check_vectors(embeddings.near_duplicates(frame).collect(), rows)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_multiprobe_recall_at_the_limit():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * side
    for rows in (1000, 10**9):
        hashes, tables = embeddings.shape_for(rows)
        a, b = (embeddings.probes(v, hashes, tables) for v in (x, y))
        met = ((a == b[:, :, :1]).any(axis=2) | (b == a[:, :, :1]).any(axis=2)).any(axis=1)
        assert met.mean() > 0.999
