"""Phrase collocations from count streams in prefix and suffix order.

Counting goes by order. A chunk of texts (some MB) sends its distinct n-grams and their counts, one row per
bucket of hashes; the buckets add up and tell each chunk which of its n-grams occur ``least`` times or more
in the corpus. Only n-grams whose two shorter parts do are counted at the next order, so nothing rare is
carried on. Of the chunks that hold a frequent n-gram one is asked to spell it.

What comes out is one stream of (language, words, count). It is sorted twice, by words and by words read
backwards. In the first order the beginnings of a phrase stand right before it, in the second its ends, so
one pass with a stack of at most four entries gives the counts of all first and last parts of a phrase, and
the largest count of a phrase that is one word longer. Both orders are then merge-joined on the phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from appkpi.llm.chunks import bucket_count, by_bucket, pack_texts, unpack_texts
from appkpi.llm.common import by_group, map_rows, settle
from appkpi.llm.words import mix

LONGEST = 5
LEAST = 100
TOP = 2000
NO_LANG = "und"
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
# Fixed by the definition of a piece and of a word.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
PIECE_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
# Rows of the count stream that one task puts in order.
TASK_ROWS = 500_000

_tables: list = []


def _lookup_tables():
    import numpy as np

    if not _tables:
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            table = np.full(2 * PIECE_BYTES, base, np.uint64)
            table[0] = 1
            _tables.append(np.multiply.accumulate(table))
        kind = np.zeros(256, np.int8)
        kind[list(BLANKS)] = 1
        kind[list(ENDS)] = 2
        _tables.append(kind)
    return _tables


def tokens(raw: bytes):
    """Hash, first byte and end of every word, and whether it follows the one before in the same piece."""
    import numpy as np
    from xxhash import xxh64_intdigest

    up, down, kind = _lookup_tables()
    b = np.frombuffer(raw, np.uint8)
    kinds = kind[b]
    edge = np.flatnonzero(np.diff(kinds == 0, prepend=False, append=False))
    first, end = edge[::2], edge[1::2]
    stops = np.cumsum(kinds == 2, dtype=np.int32)[first] if len(first) else first
    follows = np.zeros(len(first), bool)
    np.equal(stops[1:], stops[:-1], out=follows[1:])
    size = end - first
    keys = np.zeros(len(first), np.uint64)
    edges = np.searchsorted(first, np.arange(0, len(b) + PIECE_BYTES, PIECE_BYTES))
    for piece, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        at, own = piece * PIECE_BYTES, np.arange(i, j)
        own = own[size[own] < PIECE_BYTES]
        if not len(own):
            continue
        part = b[at : int(end[own[-1]])].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        a, z = first[own] - at, end[own] - at
        keys[own] = mix(((sums[z] - sums[a]) * down[a]) ^ size[own].astype(np.uint64))
    for k in np.flatnonzero(size >= PIECE_BYTES).tolist():
        keys[k] = xxh64_intdigest(raw[first[k] : end[k]])
    return keys, first, end, follows


class Chunk:
    """The words of a chunk's texts, and its n-grams as 64-bit keys that differ between languages."""

    def __init__(self, langs: list[str | None], sizes: list[int], data: bytes) -> None:
        import numpy as np
        from xxhash import xxh64_intdigest

        # A line end between two texts keeps their words apart.
        self.raw = b"\n".join(unpack_texts(sizes, data)).lower()
        words, self.first, self.end, self.follows = tokens(self.raw)
        self.langs = [NO_LANG if x is None else x for x in langs]
        doc = np.searchsorted(np.cumsum([n + 1 for n in sizes]), self.first, side="right")
        self.doc = doc.astype(np.int32)
        seeds = np.array([xxh64_intdigest(x) for x in self.langs], np.uint64)
        self.words = mix(words ^ seeds[doc]) if len(doc) else words

    def keys(self, order: int):
        """Key of the n-gram that begins at each word; without the last ``order`` - 1 words."""
        import numpy as np

        n = max(0, len(self.words) - order + 1)
        key = self.words[:n]
        for k in range(1, order):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + self.words[k : k + n])
        return key

    def whole(self, order: int):
        """Whether the n-gram that begins at each word lies in one piece."""
        import numpy as np

        n = max(0, len(self.words) - order + 1)
        ok = np.ones(n, bool)
        for k in range(1, order):
            ok &= self.follows[k : k + n]
        return ok

    def spell(self, at: int, order: int) -> tuple[str, list[str]]:
        raw = self.raw[self.first[at] : self.end[at + order - 1]]
        words = raw.decode("utf-8", "replace").replace("\t", " ").split(" ")
        return self.langs[self.doc[at]], [w for w in words if w]


SENT = (
    "bucket long, order int, chunk long, keys binary, counts binary, "
    "spelled array<struct<lang: string, words: array<string>, f: long>>"
)
TOLD = (
    "chunk long, order int, frequent binary, asked binary, totals binary, "
    "spelled array<struct<lang: string, words: array<string>, f: long>>"
)


def _send(chunk: int, order: int, keys, buckets: int) -> Iterator[tuple]:
    import numpy as np

    keys, counts = np.unique(keys, return_counts=True)
    for b, at in by_bucket(keys, buckets):
        yield b, order, chunk, keys[at].tobytes(), counts[at].astype("<u4").tobytes(), None


def _spell(own: Chunk, order: int, told: list):
    """The n-grams that the chunk was asked to spell, with their counts in the corpus."""
    import numpy as np

    asked = np.concatenate([np.frombuffer(r["asked"], np.uint64) for r in told] or [np.zeros(0, np.uint64)])
    totals = np.concatenate([np.frombuffer(r["totals"], np.int64) for r in told] or [np.zeros(0, np.int64)])
    keys = own.keys(order)
    at = np.flatnonzero(own.whole(order))
    at = at[np.isin(keys[at], asked)]
    key, first = np.unique(keys[at], return_index=True)
    f = totals[np.argsort(asked)]
    return [(*own.spell(i, order), n) for i, n in zip(at[first].tolist(), f.tolist(), strict=True)]


def _count_order(found: Iterator[tuple], orders: tuple[int, ...], longest: int, buckets: int) -> Iterator[tuple]:
    """Spells the n-grams of ``orders`` and sends those of the next, of which both parts are frequent."""
    import numpy as np

    for chunk, langs, sizes, data, told in found:
        own, told = Chunk(langs, sizes, data), told or []
        for order in orders:
            spelled = _spell(own, order, [r for r in told if r["order"] == order])
            if spelled:
                yield chunk % buckets, 0, chunk, None, None, spelled
        order = orders[-1]
        if order >= longest:
            continue
        frequent = [np.frombuffer(r["frequent"], np.uint64) for r in told if r["order"] == order]
        if not frequent:
            continue
        good = np.isin(own.keys(order), np.concatenate(frequent)) & own.whole(order)
        yield from _send(chunk, order + 1, own.keys(order + 1)[good[:-1] & good[1:] & own.whole(order + 1)], buckets)


def _count_first(found: Iterator[tuple], longest: int, buckets: int) -> Iterator[tuple]:
    """Sends words and pairs, and how many words each language has."""
    import numpy as np

    for chunk, langs, sizes, data in found:
        own = Chunk(langs, sizes, data)
        words = np.bincount(own.doc, minlength=len(langs)).tolist()
        totals: dict[str, int] = {}
        for lang, n in zip(own.langs, words, strict=True):
            totals[lang] = totals.get(lang, 0) + n
        yield chunk % buckets, 0, chunk, None, None, [(lang, None, n) for lang, n in totals.items()]
        yield from _send(chunk, 1, own.words, buckets)
        if longest > 1:
            yield from _send(chunk, 2, own.keys(2)[own.whole(2)], buckets)


def _add_up(found: Iterator[tuple], least: int) -> Iterator[tuple]:
    """Sums of a bucket's keys, and for each chunk which of its own are frequent."""
    import numpy as np

    for (_, order), rows in by_group(found, 2):
        if not order:
            for chunk, *_, spelled in rows:
                yield chunk, 0, None, None, None, spelled
            continue
        own = [np.frombuffer(r[1], np.uint64) for r in rows]
        counts = np.concatenate([np.frombuffer(r[2], "<u4") for r in rows]).astype(np.int64)
        whose = np.repeat(np.arange(len(rows)), [len(k) for k in own])
        keys = np.concatenate(own)
        by_key = np.argsort(keys, kind="stable")
        keys, whose = keys[by_key], whose[by_key]
        edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        totals = np.add.reduceat(counts[by_key], edges)
        kept = totals >= least
        keys, asked, totals = keys[edges][kept], whose[edges][kept], totals[kept]
        for k, (chunk, *_) in enumerate(rows):
            mine = own[k][np.isin(own[k], keys, assume_unique=True)]
            if len(mine):
                spell = asked == k
                yield chunk, order, mine.tobytes(), keys[spell].tobytes(), totals[spell].tobytes(), None


def count_stream(docs: DataFrame, least: int, longest: int, chunk_bytes: int) -> tuple[DataFrame, DataFrame]:
    """All n-grams of up to ``longest`` words that occur ``least`` times or more in their language.

    The first table has lang, words, f, the second lang and n, the words of a language.
    """
    chunks = pack_texts(docs, chunk_bytes)
    buckets = bucket_count(chunks, BUCKET_BYTES)

    def add_up(sent: DataFrame) -> DataFrame:
        placed = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "order", "chunk")
        names = ["bucket", "order", "chunk", "keys", "counts", "spelled"]
        return settle(map_rows(placed, names, TOLD, lambda found: _add_up(found, least)), "ngrams")

    names = ["chunk", "langs", "sizes", "data"]
    told = add_up(map_rows(chunks, names, SENT, lambda found: _count_first(found, longest, buckets)))
    spelled = told.where("order = 0").select(F.explode("spelled").alias("s")).select("s.*")
    words = spelled.groupBy("lang").agg(F.sum("f").alias("n")).where("n > 0")
    streams = []
    rounds: list[tuple[int, ...]] = [(1, 2)] if longest > 1 else [(1,)]
    rounds += [(k,) for k in range(3, longest + 1)]
    for orders in rounds:
        answers = told.where("order > 0").groupBy("chunk").agg(
            F.collect_list(F.struct("order", "frequent", "asked", "totals")).alias("told")
        )
        sent = map_rows(
            # The same join at every size.
            chunks.join(answers.hint("merge"), "chunk"), [*names, "told"], SENT,
            lambda found, orders=orders: _count_order(found, orders, longest, buckets),
        )
        told = add_up(sent)
        streams.append(told.where("order = 0").select(F.explode("spelled").alias("s")).select("s.*"))
    stream = streams[0]
    for more in streams[1:]:
        stream = stream.unionByName(more)
    return settle(stream, "count-stream"), settle(words, "language-words")


SCANNED = "lang string, words array<string>, f long, parts array<long>, longer long"


def scan(stream: DataFrame, words: Column) -> DataFrame:
    """In the order of ``words``: the counts of all shorter beginnings of a phrase (``parts``, shortest first),
    and the largest count of a phrase one word longer (``longer``, null if there is none).

    Range partitions begin anywhere, so each is given the beginnings of its first row. ``longer`` of those is
    told by every partition that holds some of their phrases.
    """
    tasks = max(stream.sparkSession.sparkContext.defaultParallelism, stream.count() // TASK_ROWS)
    ordered = settle(
        stream.select("lang", words.alias("words"), "f")
        .repartitionByRange(tasks, "lang", "words")
        .sortWithinPartitions("lang", "words")
        .withColumn("part", F.spark_partition_id()),
        "ordered-counts",
    )
    # One row per task, and at most four beginnings of each.
    first = ordered.groupBy("part").agg(F.min(F.struct("lang", "words")).alias("r")).select("part", "r.*")
    shorter = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.slice("words", 1, k))
    asked = first.where("size(words) > 1").select("part", "lang", F.explode(shorter).alias("words"))
    given: dict[int, list] = {}
    for row in ordered.drop("part").join(F.broadcast(asked), ["lang", "words"]).collect():
        given.setdefault(row["part"], []).append((row["lang"], row["words"], row["f"]))

    placed = ordered.repartitionByRange(tasks, "part").sortWithinPartitions("part", "lang", "words")

    def run(found: Iterator[tuple]) -> Iterator[tuple]:
        stack: list[list] = []
        part = None
        for lang, own, f, at in found:
            if at != part:
                while stack:
                    yield tuple(stack.pop()[:5])
                part = at
                stack = [[lg, w, None, None, None, n] for lg, w, n in sorted(given.get(at, ()), key=lambda x: len(x[1]))]
            while stack and (stack[-1][0] != lang or stack[-1][1] != own[: len(stack[-1][1])]):
                yield tuple(stack.pop()[:5])
            if stack:
                stack[-1][4] = max(f, stack[-1][4] or 0)
            stack.append([lang, own, f, [s[5] for s in stack], None, f])
        while stack:
            yield tuple(stack.pop()[:5])

    return map_rows(placed, ["lang", "words", "f", "part"], SCANNED, run)


def lowest_cut(a: int, firsts: list[int], lasts: list[int], n: int, size: int) -> tuple[int, int]:
    """The least floor(1000 a n / (l r)) over the cuts of a phrase of ``size`` words, and the earliest such cut.

    Whole numbers of any size; ``firsts`` and ``lasts`` are the counts of its beginnings and ends, shortest first.
    """
    return min((1000 * a * n // (firsts[k - 1] * lasts[size - k - 1]), k) for k in range(1, size))


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Phrases of 2 to ``longest`` words that occur ``least`` times or more, with their lowest-scoring cut.

    ``lang``, ``words``, ``phrase``, ``a`` (occurrences), ``l`` and ``r`` (of the two parts), ``n`` (words of the
    language), ``score`` = floor(1000 a n / (l r)), ``cut`` (words before it). Phrases that lie in a longer one
    which occurs as often are left out. Texts are lower-cased (A-Z); a phrase lies within a piece. A null text
    is an empty one, a null language ``und``; rows are counted however often they repeat, ids are not read. An
    empty table gives no rows. Words and n-grams are told apart by 64-bit hashes.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    read = docs.select(F.lit(None).cast("long").alias("doc_id"), lang.alias("lang"), "text")
    stream, words = count_stream(read, least, longest, chunk_bytes)

    def whole(scanned: DataFrame, name: str) -> DataFrame:
        """One row a phrase, whatever partitions have told about it."""
        return scanned.groupBy("lang", "words").agg(
            F.max("f").alias("a"), F.max("parts").alias(name), F.max("longer").alias(f"more_{name}")
        )

    ahead = whole(scan(stream, F.col("words")), "firsts")
    back = scan(stream, F.reverse("words")).withColumn("words", F.reverse("words"))
    both = ahead.join(whole(back, "lasts").drop("a").hint("merge"), ["lang", "words"])
    kept = both.where(
        (F.size("words") > 1)
        & (F.coalesce(F.greatest("more_firsts", "more_lasts"), F.lit(0)) < F.col("a"))
    ).join(words, "lang")

    def score(found: Iterator[tuple]) -> Iterator[tuple]:
        for lg, own, a, firsts, lasts, n in found:
            value, k = lowest_cut(a, firsts, lasts, n, len(own))
            yield lg, own, " ".join(own), a, firsts[k - 1], lasts[len(own) - k - 1], n, value, k

    schema = "lang string, words array<string>, phrase string, a long, l long, r long, n long, score long, cut int"
    return map_rows(kept, ["lang", "words", "a", "firsts", "lasts", "n"], schema, score)


def top(found: DataFrame, most: int = TOP) -> DataFrame:
    """The first ``most`` phrases of each language by score, then occurrences, then phrase, with their ``rank``."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
