"""Repeated passages by a depth-limited radix sort of suffixes.

A window is a string of ``WIDTH`` bytes. A window that also starts in a text with a smaller doc_id
is cut out. Suffixes are ordered only as far as their first ``WIDTH`` bytes, most significant digit
first, and a group that has come down to one document is not looked at again:

1. The first digit of a window is the least hash of the ``GRAM``-byte strings inside it. Equal windows
   have it in common, and neighbouring windows mostly share it, so a text has one such digit for about
   ten windows (a run). Each chunk of texts sends its digits, and is told which of them other chunks have.
2. Only runs with a digit that two documents have are sent on, as the bytes they cover, and meet by
   digit. Runs with the same bytes are settled by the smallest id.
3. What is left is sorted in numpy by digits of 8 bytes until the threshold is reached (``radix``).
   Groups that are equal through ``WIDTH`` bytes are exactly the repeated windows.

A digit that very many chunks have is sent on window by window, once per chunk, so that the texts around
a frequent passage don't meet in one group. Texts that are whole copies are settled before all this.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appkpi.llm.chunks import CHUNK_BYTES, NO_ID, bucket_count, by_bucket, pack_texts, unpack_texts
from appkpi.llm.common import by_group, map_rows, settle
from appkpi.llm.words import mix

WIDTH = 50
GRAM = 32
# Windows of one run: longer runs, of texts that repeat themselves, are cut.
RUN_WINDOWS = 64
PIECE_BYTES = 1 << 18
# A digit of more chunks than this is sent on window by window.
HOT_CHUNKS = 256
# Runs that are sorted in one numpy pass.
PASS_RUNS = 20_000
BASE = 0x9E3779B97F4A7C15 | 1

_powers: list = []


def _tables():
    import numpy as np

    if not _powers:
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            table = np.full(PIECE_BYTES + 256, base, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers


def runs(raw: bytes, width: int = WIDTH, gram: int = GRAM):
    """First digit, hash of the bytes covered, first window and number of windows of each run."""
    import numpy as np

    found = [
        _runs(raw[at : at + PIECE_BYTES + width - 1], at, width, gram)
        for at in range(0, len(raw) - width + 1, PIECE_BYTES)
    ]
    if len(found) == 1:
        return found[0]
    if not found:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _runs(raw: bytes, base: int, width: int, gram: int):
    import numpy as np

    up, down = _tables()
    b = np.frombuffer(raw, np.uint8)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    least = mix((sums[gram:] - sums[:-gram]) * down[: len(b) - gram + 1])
    # The minimum over the grams of a window, by doubling.
    wide, have = width - gram + 1, 1
    while 2 * have <= wide:
        least, have = np.minimum(least[:-have], least[have:]), 2 * have
    if have < wide:
        least = np.minimum(least[: len(least) - (wide - have)], least[wide - have :])
    begins = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=begins[1:])
    first = np.flatnonzero(begins)
    ends = np.append(first[1:], len(least))
    if (ends - first).max() > RUN_WINDOWS:
        for k in np.flatnonzero(ends - first > RUN_WINDOWS).tolist():
            begins[first[k] : ends[k] : RUN_WINDOWS] = True
        first = np.flatnonzero(begins)
        ends = np.append(first[1:], len(least))
    size = ends - first
    covered = mix(((sums[ends + width - 1] - sums[first]) * down[first]) ^ size.astype(np.uint64))
    return least[first], covered, first + base, size


def shared_digits(chunks: DataFrame, width: int, gram: int, hot: int) -> tuple[DataFrame, int]:
    """``chunk`` and, by bucket, the first digits that other chunks have as well; the number of buckets."""
    buckets = bucket_count(chunks)

    def send(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        for chunk, sizes, copies, data in found:
            later = set(copies)
            own = [runs(t, width, gram)[0] for k, t in enumerate(unpack_texts(sizes, data)) if k not in later]
            keys = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
            for b, at in by_bucket(keys, buckets):
                yield b, chunk, keys[at].astype("<u4").tobytes()

    sent = map_rows(chunks, ["chunk", "sizes", "copies", "data"], "bucket long, chunk long, digits binary", send)
    placed = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def answer(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        for (b,), rows in by_group(found, 1):
            own = [np.frombuffer(r[1], "<u4") for r in rows]
            digits, counts = np.unique(np.concatenate(own), return_counts=True)
            shared, frequent = digits[counts > 1], digits[counts > hot]
            for (chunk, _), mine in zip(rows, own, strict=True):
                known = mine[np.isin(mine, shared, assume_unique=True)]
                if len(known):
                    often = known[np.isin(known, frequent, assume_unique=True)]
                    yield chunk, b, known.tobytes(), often.tobytes()

    schema = "chunk long, bucket long, shared binary, hot binary"
    told = map_rows(placed, ["bucket", "chunk", "digits"], schema, answer)
    return settle(
        told.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "shared", "hot")).alias("known")), "shared-digits"
    ), buckets


def _lookup(known: list, field: str, buckets: int, keys):
    """Which of ``keys`` are among the answers of a chunk."""
    import numpy as np

    if not known:
        return np.zeros(len(keys), bool)
    told = np.concatenate(
        [(np.uint64(r["bucket"]) << np.uint64(32)) | np.frombuffer(r[field], "<u4").astype(np.uint64) for r in known]
    )
    low = keys & np.uint64(0xFFFFFFFF)
    return np.isin((((keys >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | low, told)


RUNS = "bucket long, chunk long, columns binary, bodies binary"
# Of each run that is sent: low half of the digit, doc_id, place in the chunk, first window, windows.
COLUMNS = [("digit", "<u4"), ("id", "<i8"), ("pos", "<u4"), ("first", "<u4"), ("n", "<u2")]


def _pack_runs(columns: list, bodies: list[bytes]) -> tuple[bytes, bytes]:
    import numpy as np
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3)
    raw = b"".join(np.asarray(c).astype(t).tobytes() for c, (_, t) in zip(columns, COLUMNS, strict=True))
    return squeeze.compress(raw), squeeze.compress(b"".join(bodies))


def _unpack_runs(columns: bytes, bodies: bytes) -> tuple[list, bytes]:
    import numpy as np
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(columns)
    count, at, out = len(raw) // sum(np.dtype(t).itemsize for _, t in COLUMNS), 0, []
    for _, kind in COLUMNS:
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    return out, zstandard.ZstdDecompressor().decompress(bodies)


def _firsts(new):
    """Where the groups begin, and the group of each row, from marks of new groups."""
    import numpy as np

    return np.flatnonzero(new), np.cumsum(new) - 1


def _send_runs(found: Iterator[tuple], width: int, gram: int, buckets: int) -> Iterator[tuple]:
    """Of each chunk the runs to compare, by bucket, and what its own texts settle (with no columns)."""
    import numpy as np
    from xxhash import xxh64_intdigest

    for chunk, ids, sizes, copies, data, known in found:
        texts, later = unpack_texts(sizes, data), set(copies)
        own = [(k, *runs(t, width, gram)) for k, t in enumerate(texts) if k not in later and len(t) >= width]
        if not own:
            continue
        pos = np.concatenate([np.full(len(r[1]), r[0]) for r in own])
        digit, covered, first, size = (np.concatenate(x) for x in list(zip(*own, strict=True))[1:])
        doc = np.array(ids, np.int64)[pos]
        alive, hot = (_lookup(known, name, buckets, digit) for name in ("shared", "hot"))
        # Digits of two documents of this chunk.
        order = np.argsort(digit, kind="stable")
        new = np.append(True, digit[order[1:]] != digit[order[:-1]])
        edges, group = _firsts(new)
        several = np.minimum.reduceat(doc[order], edges) < np.maximum.reduceat(doc[order], edges)
        alive[order] |= several[group]
        at = np.flatnonzero(alive)
        if not len(at):
            continue
        at = at[np.lexsort((doc[at], covered[at], digit[at]))]
        edges, group = _firsts(
            np.append(True, (digit[at[1:]] != digit[at[:-1]]) | (covered[at[1:]] != covered[at[:-1]]))
        )
        gone = doc[at] > doc[at[edges]][group]
        settled = [np.stack([pos[at[gone]], first[at[gone]], first[at[gone]] + size[at[gone]] + width - 1], axis=1)]
        at = at[~gone]
        often, at = at[hot[at]], at[~hot[at]]
        # Frequent digits go on window by window, each once.
        windows: dict[bytes, list] = {}
        for k in often.tolist():
            for j in range(first[k], first[k] + size[k]):
                windows.setdefault(texts[pos[k]][j : j + width], []).append((int(doc[k]), int(pos[k]), int(j)))
        extra = []
        for window, asked in windows.items():
            least = min(asked)[0]
            settled.append(np.array([(p, j, j + width) for i, p, j in asked if i > least], np.int64).reshape(-1, 3))
            extra += [(xxh64_intdigest(window), *x, window) for x in asked if x[0] == least]
        key = np.concatenate([digit[at], np.array([x[0] for x in extra], np.uint64)])
        columns = [
            np.concatenate([a, np.array([x[k] for x in extra], np.int64)])
            for k, a in enumerate((doc[at], pos[at], first[at]), 1)
        ]
        count = np.concatenate([size[at], np.ones(len(extra), np.int64)])
        for b, rows in by_bucket(key, buckets):
            picked = [c[rows] for c in (key & np.uint64(0xFFFFFFFF), *columns, count)]
            spans = zip(*(c.tolist() for c in picked[2:]), strict=True)
            yield b, chunk, *_pack_runs(picked, [texts[p][a : a + n + width - 1] for p, a, n in spans])
        settled = np.concatenate(settled)
        if len(settled):
            yield chunk % buckets, chunk, None, settled.astype("<i4").tobytes()


def radix(flat, begin, sizes, ids, groups, width: int = WIDTH):
    """For every window of the bodies in ``flat``, body by body, whether an equal one has a smaller id in its group.

    Windows are sorted by 8 bytes at a time, most significant first. After each pass the groups that
    hold one id only are dropped.
    """
    import numpy as np

    count = sizes - width + 1
    window = np.arange(count.sum())
    body = np.repeat(np.arange(len(sizes)), count)
    start = window - np.repeat(np.cumsum(count) - count, count) + begin[body]
    group, doc = groups[body], ids[body]
    repeated = np.zeros(len(window), bool)
    step, eight = min(8, width), np.arange(min(8, width))
    # The last digit begins early enough to end at the threshold.
    depths = [*range(0, width - step, step), width - step]
    for depth in depths:
        if not len(window):
            break
        bytes_of = np.zeros((len(window), 8), np.uint8)
        bytes_of[:, :step] = flat[(start + depth)[:, None] + eight]
        digit = bytes_of.view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((digit, group))
        window, start, doc, group, digit = (x[order] for x in (window, start, doc, group, digit))
        edges, group = _firsts(np.append(True, (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])))
        least, most = np.minimum.reduceat(doc, edges), np.maximum.reduceat(doc, edges)
        if depth == depths[-1]:
            repeated[window[doc > least[group]]] = True
        keep = (least < most)[group]
        window, start, doc, group = window[keep], start[keep], doc[keep], group[keep]
    return repeated


def _compare(found: Iterator[tuple], width: int) -> Iterator[tuple]:
    """Spans to cut, as (place in the chunk, first byte, end), from the runs of each bucket."""
    import numpy as np

    for _, rows in by_group(found, 1):
        held, bodies, whose = [], [], []
        for chunk, columns, body in rows:
            if columns is None:
                yield chunk, body
                continue
            own, raw = _unpack_runs(columns, body)
            held.append(own)
            bodies.append(raw)
            whose.append(chunk)
        if not held:
            continue
        flat = np.frombuffer(b"".join(bodies), np.uint8)
        digit, ids, pos, first, n = (np.concatenate(c).astype(np.int64) for c in zip(*held, strict=True))
        source = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])
        sizes = n + width - 1
        begin = np.cumsum(sizes) - sizes
        order = np.argsort(digit, kind="stable")
        # Whole digits at a time, about as many as are sorted in one pass.
        edges = np.flatnonzero(np.append(True, digit[order[1:]] != digit[order[:-1]]))
        cuts = edges[np.append(True, np.diff(edges // PASS_RUNS) > 0)]
        for a, z in zip(cuts, [*cuts[1:], len(order)], strict=True):
            at = order[a:z]
            spans = []
            for k, i, j in _settle(flat, begin[at], sizes[at], ids[at], digit[at], width):
                k = at[k]
                spans.append(np.stack([source[k], pos[k], first[k] + i, first[k] + j + width - 1], axis=1))
            if not spans:
                continue
            spans = np.concatenate(spans)
            if not len(spans):
                continue
            spans = spans[np.argsort(spans[:, 0], kind="stable")]
            ends = np.append(np.flatnonzero(np.diff(spans[:, 0])) + 1, len(spans))
            at = 0
            for end in ends.tolist():
                yield whose[spans[at, 0]], spans[at:end, 1:].astype("<i4").tobytes()
                at = end


def _settle(flat, begin, sizes, ids, digit, width: int) -> Iterator[tuple]:
    """Runs, and in each the first and the end of windows that repeat, for runs in order of digit."""
    import numpy as np

    up, down = _tables()
    # The bodies side by side, each hashed as a whole.
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = flat[inside + np.repeat(begin, sizes)]
    place = np.cumsum(sizes) - sizes
    terms = (own.astype(np.uint64) + np.uint64(1)) * up[inside]
    whole = mix(np.add.reduceat(terms, place) ^ sizes.astype(np.uint64))
    order = np.lexsort((ids, whole, digit))
    d, w = digit[order], whole[order]
    edges, group = _firsts(np.append(True, (d[1:] != d[:-1]) | (w[1:] != w[:-1])))
    later = ids[order] > ids[order[edges]][group]
    k = order[later]
    if len(k):
        yield k, np.zeros(len(k), np.int64), sizes[k] - width + 1
    # Of each body the smallest id; digits with one body are done.
    k = np.sort(order[~later])
    kinds, counts = np.unique(d[edges], return_counts=True)
    several = kinds[counts > 1]
    k = k[np.isin(digit[k], several)]
    if not len(k):
        return
    repeated = radix(own, place[k], sizes[k], ids[k], digit[k], width).astype(np.int8)
    count = sizes[k] - width + 1
    starts = np.cumsum(count) - count
    # A run of repeated windows ends with its body.
    before = np.append(0, repeated[:-1])
    before[starts] = 0
    after = np.append(repeated[1:], 0)
    after[starts[1:] - 1] = 0
    i = np.flatnonzero((repeated == 1) & (before == 0))
    j = np.flatnonzero((repeated == 1) & (after == 0)) + 1
    body = np.searchsorted(starts, i, side="right") - 1
    yield k[body], i - starts[body], j - starts[body]


CUT = "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>"


def _cut(found: Iterator[tuple], width: int) -> Iterator[tuple]:
    import numpy as np

    for ids, sizes, copies, data, spans in found:
        texts, later = unpack_texts(sizes, data), set(copies)
        own = np.concatenate([np.frombuffer(s, "<i4").reshape(-1, 3) for s in spans or ()] or [np.zeros((0, 3), "<i4")])
        own = own[np.lexsort((own[:, 1], own[:, 0]))].astype(np.int64)
        # One line for all texts of the chunk, with a gap after each.
        base = np.cumsum([0, *sizes]) + np.arange(len(sizes) + 1)
        begin, end = own[:, 1] + base[own[:, 0]], np.maximum.accumulate(own[:, 2] + base[own[:, 0]])
        new = np.ones(len(own), bool)
        new[1:] = begin[1:] > end[:-1]
        begin, end = begin[new], end[np.append(np.flatnonzero(new)[1:], len(own)) - 1] if len(own) else end
        edges = np.searchsorted(begin, base)
        for k, text in enumerate(texts):
            if k in later and len(text) >= width:
                cuts = [(0, len(text))]
            else:
                here = slice(edges[k], edges[k + 1])
                cuts = list(zip((begin[here] - base[k]).tolist(), (end[here] - base[k]).tolist(), strict=True))
            kept, at = [], 0
            for a, z in cuts:
                kept.append(text[at:a])
                at = z
            kept.append(text[at:])
            yield None if ids[k] == NO_ID else ids[k], len(text), b"".join(kept), cuts


def cut_repeats(
    docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK_BYTES, hot_chunks: int = HOT_CHUNKS
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``kept`` (the bytes left) and ``spans`` (what was cut) of every row.

    A byte goes if it lies in a string of ``width`` bytes that also starts in a text with a smaller
    doc_id. Strings are judged on the input. One row per row: a null text is an empty one, a text of
    fewer bytes stays as it is, and rows with one doc_id take nothing from each other. A null doc_id
    counts as larger than any. ``spans`` are maximal and in order. What is left may end inside a
    character. An empty table gives no rows; columns other than doc_id and text are not read.
    """
    if not 16 <= width <= 256:
        raise ValueError("width must be between 16 and 256 bytes")
    gram = min(width - 1, max(8, GRAM * width // WIDTH))
    chunks = pack_texts(docs.select("doc_id", "text"), chunk_bytes, find_copies=True)
    known, buckets = shared_digits(chunks, width, gram, hot_chunks)
    # The same columns for both joins, so that Spark shuffles the texts once.
    texts = chunks.select("chunk", "ids", "sizes", "copies", "data")
    sent = map_rows(
        texts.join(known.hint("merge"), "chunk", "left"), ["chunk", "ids", "sizes", "copies", "data", "known"], RUNS,
        lambda found: _send_runs(found, width, gram, buckets),
    )
    placed = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")
    spans = map_rows(
        placed, ["bucket", "chunk", "columns", "bodies"], "chunk long, spans binary",
        lambda found: _compare(found, width),
    )
    by_chunk = spans.groupBy("chunk").agg(F.collect_list("spans").alias("spans"))
    return map_rows(
        texts.join(by_chunk.hint("merge"), "chunk", "left"),
        ["ids", "sizes", "copies", "data", "spans"], CUT, lambda found: _cut(found, width),
    )
