"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(bucket | class, last word) * P(word | bucket). A word's
bucket is a hash of the whole word; buckets are clustered into classes by the texts they occur in.

P(class | history) is a softmax over weights of hashed features of the history: the last word
(2-gram), the last two words (3-gram), and the second and third last words alone (skips).
P(bucket | class, last word) is a softmax as well: each bucket starts from its share of the class,
and each pair of last word and bucket that occurs has a weight of its own, so these weights grow
with the corpus. They lie in a table of shards by the pair's hash; no task holds more than a shard.
P(word | bucket) is the share of the word among the bucket's training tokens, with one more for each
word and one for all unseen ones. The end of a text is a token, a bucket and a class of its own.

Counts come from all training texts, and all weights are trained on all of them. Class weights:
every task takes gradient steps over its texts, and the weights of all tasks are averaged, each row
by how often the tasks met it. Pair weights: all pairs of a last word and a class meet in one shard,
which takes gradient steps on their counts. Words are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.llm.common import discard, map_rows, pack, settle, unpack
from appkpi.llm.words import hash_texts, hash_words, mix

BUCKET_BITS = 13
PROFILE = 16
CLASSES = 12
PAIR_BITS = 14
ROUNDS = 1
BATCH_TOKENS = 8192
STEP = 0.3
# Words that every task knows by heart: 16 bytes each. The others are joined.
HOT_WORDS = 200_000
# Pairs and contexts with at least this share of all tokens, so at most so many: every task knows their weights.
HOT_SHARE = 200_000
# Words whose counts a task holds before it passes them on.
FLUSH_TOKENS = 4_000_000
# Texts that are hashed and scored together: so many bytes (a longer text stands alone), so many rows.
GROUP_BYTES = 1 << 16
GROUP_ROWS = 1 << 12
# Words of the texts that are looked up together.
SCORE_TOKENS = 1_000_000
# Rows of weights that are averaged together.
SLICE_ROWS = 512
# Shards of the word counts; shards of the pairs, of which there are more where they would pass SHARD_TOKENS.
WORD_SHARDS = 1024
PAIR_SHARDS = 64
SHARD_TOKENS = 1 << 21
# Shards that share the rare pairs of a frequent context.
SPREAD = 16
PAIR_STEPS = 6
PAIR_PULL = 0.3

BUCKETS = 1 << BUCKET_BITS
# Rows of weights: three history places, each with a row for "before the text", then word pairs.
HISTORY_ROWS = 3 * (BUCKETS + 1)
ROWS = HISTORY_ROWS + (1 << PAIR_BITS)


def words_and_buckets(text: str | None):
    """Word hashes and buckets of a text in lower case (A-Z)."""
    words = hash_words((text or "").encode().lower())
    return words, buckets_of(words)


def in_groups(found: Iterator[tuple]) -> Iterator[tuple]:
    """(rows without their text, word hashes, buckets, words of each text) of some texts at a time; the text is last."""

    def together() -> tuple:
        words, sizes = hash_texts(raws)
        return rows, words, buckets_of(words), sizes

    rows, raws, size = [], [], 0
    for *row, text in found:
        raw = (text or "").encode().lower()
        if raws and (size + len(raw) > GROUP_BYTES or len(raws) >= GROUP_ROWS):
            yield together()
            rows, raws, size = [], [], 0
        rows.append(row)
        raws.append(raw)
        size += len(raw) + 1
    if raws:
        yield together()


def with_ends(values, sizes, end):
    """The values of the words of some texts, with ``end`` after each text."""
    import numpy as np

    tokens = np.full(len(values) + len(sizes), end, values.dtype)
    tokens[np.arange(len(values)) + np.repeat(np.arange(len(sizes)), sizes)] = values
    return tokens


def buckets_of(words):
    import numpy as np

    return (mix(words) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def pair_codes(words, classes, buckets, sizes=None):
    """For each word the hash of its pair: last word and class, with the bucket in the low bits.

    The words are those of one text, or of texts with ``sizes`` words each.
    """
    import numpy as np

    last = np.zeros(len(words), np.uint64)
    last[1:] = words[:-1]
    if sizes is not None:
        last[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    context = mix(last + (classes + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return context_of(context) | buckets.astype(np.uint64)


def context_of(codes):
    import numpy as np

    return codes & np.uint64((1 << 64) - BUCKETS)


def shard_of(hashes, shards: int):
    import numpy as np

    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def spread_shard(shard, codes, shards: int):
    """The shard of a pair whose context is frequent: one of the ``SPREAD`` that follow its context's."""
    import numpy as np

    return (shard + (mix(codes) % np.uint64(SPREAD)).astype(np.int64)) % shards


def in_shard(codes, shard):
    """Pairs as their shard knows them: 40 bits of the hash, and the shard. Shards, so hashes, grow with the corpus."""
    import numpy as np

    high = np.asarray(shard, np.int64).astype(np.uint64) << np.uint64(40)
    return codes & np.uint64((1 << 40) - 1) | high


def packed(codes) -> bytes:
    """The 40 bits of each pair."""
    import numpy as np

    return np.ascontiguousarray(codes, "<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpacked(raw: bytes, shard: int):
    import numpy as np

    codes = np.zeros((len(raw) // 5, 8), np.uint8)
    codes[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return in_shard(codes.view("<u8").ravel(), shard)


def counted(hashes, times=None):
    """Distinct hashes in order, and how often each occurs."""
    import numpy as np

    if times is None:
        return np.unique(hashes, return_counts=True)
    order = np.argsort(hashes)
    hashes, times = hashes[order], times[order]
    first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
    return hashes[first], np.add.reduceat(times, first) if len(first) else times


def in_shards(hashes, times, shards: int, pairs: bool = False) -> Iterator[tuple]:
    """(shard, hashes, times) of hashes in order, as bytes."""
    import numpy as np

    edges = np.searchsorted(shard_of(hashes, shards), np.arange(shards + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        own = slice(edges[k], edges[k + 1])
        yield k, packed(hashes[own]) if pairs else hashes[own].tobytes(), times[own].astype(np.uint32).tobytes()


def of_shards(found: Iterator[tuple], pairs: bool = False) -> Iterator[tuple]:
    """(shard, hashes, times) with each hash once, from rows in order of shard."""
    import numpy as np

    shard, held, size = None, [], 0

    def together():
        return counted(*(np.concatenate(x) for x in zip(*held, strict=True)))

    for at, hashes, times in found:
        if at != shard:
            if held:
                yield shard, *together()
            shard, held, size = at, [], 0
        hashes = unpacked(hashes, at) if pairs else np.frombuffer(hashes, np.uint64)
        held.append((hashes, np.frombuffer(times, np.uint32).astype(np.int64)))
        size += len(hashes)
        if size >= FLUSH_TOKENS and len(held) > 1:
            held = [together()]
            # What stays is not counted again, so that it isn't merged at every step.
            size = 0
    if held:
        yield shard, *together()


def by_shard(parts: DataFrame) -> DataFrame:
    return parts.repartition("shard").sortWithinPartitions("shard")


def count_texts(training: DataFrame) -> tuple[DataFrame, list[tuple]]:
    """``word`` (hash), ``bucket`` and ``n`` of every word, and slices of the buckets' profiles.

    A bucket's profile is the mean mix of buckets, in ``PROFILE`` groups, of the texts it occurs in.
    """

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        def flush() -> Iterator[tuple]:
            for shard, words, times in in_shards(*counted(np.concatenate(held)), WORD_SHARDS):
                yield shard, words, times, None

        total = np.zeros((BUCKETS, PROFILE), np.float32)
        held, size = [], 0
        for _, words, bucket, sizes in in_groups(found):
            if not len(words):
                continue
            text = np.repeat(np.arange(len(sizes)), sizes)
            share = np.bincount(text * PROFILE + bucket % PROFILE, minlength=len(sizes) * PROFILE)
            share = share.reshape(-1, PROFILE).astype(np.float32) / np.maximum(sizes, 1)[:, None].astype(np.float32)
            order = np.argsort(bucket.astype(np.uint16), kind="stable")
            kinds, first = np.unique(bucket[order], return_index=True)
            total[kinds] += np.add.reduceat(np.take(share, text[order], axis=0), first, axis=0)
            held.append(words)
            size += len(words)
            if size >= FLUSH_TOKENS or len(held) >= 100_000:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
        for at in range(0, BUCKETS, SLICE_ROWS):
            yield at // SLICE_ROWS, None, None, total[at : at + SLICE_ROWS].tobytes()

    def merge(found: Iterator[tuple]) -> Iterator[tuple]:
        for _, words, times in of_shards(found):
            yield from zip(words.view("int64").tolist(), buckets_of(words).tolist(), times.tolist(), strict=True)

    parts = settle(
        map_rows(training, ["text"], "shard int, words binary, times binary, value binary", rows), "text-counts"
    )
    words = by_shard(parts.where("value is null").select("shard", "words", "times"))
    counts = map_rows(words, ["shard", "words", "times"], "word long, bucket int, n long", merge)
    counts = settle(counts, "word-counts")
    slices = _summed(parts.where("value is not null").select(F.col("shard").alias("slice"), "value"), 1)
    discard(parts)
    return counts, slices


def _summed(parts: DataFrame, columns: int) -> list[tuple]:
    """Slices and their arrays summed over all tasks, in order of slice; they have a fixed size."""
    import numpy as np

    names = ["value", "weight"][:columns]

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        total: dict[int, list] = {}
        for at, *values in found:
            arrays = [np.frombuffer(values[-1], np.float32).astype(np.float64)]
            if columns == 2:
                # Weights travel in half precision and count as often as their row was met.
                value = np.frombuffer(values[0], np.float16).reshape(len(arrays[0]), -1)
                arrays.insert(0, (value * arrays[0][:, None]).ravel())
            own = total.setdefault(at, [np.zeros_like(a) for a in arrays])
            for a, b in zip(own, arrays, strict=True):
                a += b
        for at, arrays in total.items():
            yield at, *(a.astype(np.float32).tobytes() for a in arrays)

    schema = ", ".join(["slice int", *(f"{c} binary" for c in names)])
    # Twice, so that no task reads a slice of every task of a large table.
    first = map_rows(
        parts.repartition("slice", F.pmod(F.spark_partition_id(), F.lit(16))), ["slice", *names], schema, rows
    )
    halves = first.select("slice", *names)

    def again(found: Iterator[tuple]) -> Iterator[tuple]:
        total: dict[int, list] = {}
        for at, *values in found:
            arrays = [np.frombuffer(v, np.float32) for v in values]
            own = total.setdefault(at, [np.zeros(len(a)) for a in arrays])
            for a, b in zip(own, arrays, strict=True):
                a += b
        for at, arrays in total.items():
            yield at, *(a.tobytes() for a in arrays)

    last = map_rows(halves.repartition("slice"), ["slice", *names], schema, again)
    found = sorted(last.collect())
    return [(r[0], *(np.frombuffer(v, np.float64) for v in r[1:])) for r in found]


def cluster(profile, tokens):
    """A class for each bucket: k-means on profiles, buckets weighing as their tokens."""
    import numpy as np

    mean = profile.sum(axis=0) / max(1e-9, profile.sum())
    share = profile / np.maximum(1e-9, profile.sum(axis=1, keepdims=True))
    x = np.log((share + 1e-4) / (mean + 1e-4))
    weigh = np.sqrt(tokens)
    # Centres far from one another to begin with, then the usual rounds.
    centres = [x[tokens.argmax()]]
    away = ((x - centres[0]) ** 2).sum(axis=1)
    for _ in range(CLASSES - 1):
        centres.append(x[(away * tokens).argmax()])
        away = np.minimum(away, ((x - centres[-1]) ** 2).sum(axis=1))
    centres = np.array(centres)
    for _ in range(20):
        near = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(CLASSES):
            own = near == c
            if weigh[own].sum() > 0:
                centres[c] = (x[own] * weigh[own, None]).sum(axis=0) / weigh[own].sum()
    return near


def history_rows(words, buckets, sizes=None):
    """For each token of a text and its end, the four rows of weights of its history.

    The words are those of one text, or of texts with ``sizes`` words each; every text has an end.
    """
    import numpy as np

    sizes = np.array([len(words)]) if sizes is None else sizes
    words, buckets = with_ends(words, sizes, 0), with_ends(buckets, sizes, BUCKETS)
    n = len(words)
    starts = np.cumsum(sizes + 1) - sizes - 1
    rows = np.empty((4, n), np.int64)
    for back in range(1, 4):
        own = rows[back - 1]
        own[:back] = BUCKETS
        own[back:] = buckets[: max(0, n - back)]
        # Ends and the first places of a text have none of its words before them.
        for k in range(back):
            own[np.minimum(starts + k, starts + sizes)] = BUCKETS
        own += (back - 1) * (BUCKETS + 1)
    pair = np.zeros(n, np.uint64)
    pair[2:] = words[: max(0, n - 2)] * np.uint64(3)
    pair[starts] = 0
    pair[1:] += words[:-1]
    rows[3] = HISTORY_ROWS + (mix(pair) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
    return rows


@dataclass
class Model:
    """Weights by row and class, class of each bucket, log10 of the mass of each class, and counts."""

    weights: object
    prior: object
    classes: object
    log_mass: object
    tokens: int
    kinds: int
    texts: int
    hot: object
    hot_counts: object
    # Share of each bucket in its class, natural log of what frequent contexts and pairs add, shards of the rest.
    share: object
    contexts: object = None
    context_logs: object = None
    pairs: object = None
    pair_logs: object = None
    shards: int = PAIR_SHARDS

    def classes_of(self, buckets, sizes=None):
        """Classes of the words and ends of one text, or of texts with ``sizes`` words each."""
        import numpy as np

        return with_ends(self.classes[buckets], np.array([len(buckets)]) if sizes is None else sizes, CLASSES)

    def pulls(self, rows):
        """What each class (first axis) of each history has in the exponent, the largest being zero."""
        import numpy as np

        z = np.take(self.weights, rows[0], axis=0)
        for own in rows[1:]:
            z += np.take(self.weights, own, axis=0)
        # Thirteen classes: sums and maxima over long rows are ten times as fast.
        z = np.ascontiguousarray(z.T)
        z += self.prior[:, None]
        z -= z.max(axis=0)
        return z

    def log_probabilities(self, rows, classes):
        """Natural log of P(class | history) of one class for each history."""
        import numpy as np

        z = self.pulls(rows)
        own = z[classes, np.arange(len(classes))]
        return own - np.log(np.exp(z, out=z).sum(axis=0))


def descend(model: Model, past, rows, classes, met) -> None:
    """One gradient step over a batch of histories and the classes that followed."""
    import numpy as np

    n = len(classes)
    pull = model.pulls(rows)
    np.exp(pull, out=pull)
    pull /= pull.sum(axis=0)
    pull[classes, np.arange(n)] -= 1
    pull = np.ascontiguousarray(pull.T)
    for own in rows:
        # As 16-bit numbers where they fit, which are sorted by their digits.
        own = own.astype(np.uint16 if ROWS <= 1 << 16 else np.uint32)
        order = np.argsort(own, kind="stable")
        own = own[order]
        first = np.flatnonzero(own[1:] != own[:-1]) + 1
        first = np.concatenate([np.zeros(1, first.dtype), first])
        row = own[first].astype(np.int64)
        slope = np.add.reduceat(np.take(pull, order, axis=0), first, axis=0)
        weight = np.take(model.weights, row, axis=0)
        slope += 0.02 * weight
        so_far = np.take(past, row, axis=0)
        so_far += slope * slope
        past[row] = so_far
        slope *= STEP
        slope /= np.sqrt(so_far, out=so_far)
        model.weights[row] = weight - slope
        met[row] += np.diff(first, append=n)


def train_weights(training: DataFrame, model: Model):
    """Weights after a pass of all tasks over their texts, averaged, and the table with counts of the pairs met."""
    import numpy as np

    start = training.sparkSession.sparkContext.broadcast(model)

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        from dataclasses import replace

        own = replace(start.value, weights=start.value.weights.copy())
        past = np.ones_like(own.weights)
        met = np.zeros(ROWS, np.float32)
        held, size = [], 0
        codes, pairs = [], 0

        def flush() -> Iterator[tuple]:
            for shard, *values in in_shards(*counted(np.concatenate(codes)), own.shards, True):
                yield shard, *values, True

        def step(last: bool = False) -> None:
            at, classes = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
            done = len(classes) if last else len(classes) // BATCH_TOKENS * BATCH_TOKENS
            for a in range(0, done, BATCH_TOKENS):
                descend(own, past, at[:, a : a + BATCH_TOKENS], classes[a : a + BATCH_TOKENS], met)
            held[:] = [(at[:, done:], classes[done:])]

        for _, words, buckets, sizes in in_groups(found):
            classes = own.classes_of(buckets, sizes)
            held.append((history_rows(words, buckets, sizes), classes))
            codes.append(pair_codes(words, own.classes[buckets], buckets, sizes))
            size, pairs = size + len(classes), pairs + len(words)
            if pairs >= FLUSH_TOKENS or len(codes) >= 100_000:
                yield from flush()
                codes, pairs = [], 0
            if size >= BATCH_TOKENS:
                step()
                size = len(held[0][1])
        if size:
            step(last=True)
        if codes:
            yield from flush()
        for at in range(0, ROWS, SLICE_ROWS):
            n = met[at : at + SLICE_ROWS]
            if n.any():
                value = np.where(n[:, None] > 0, own.weights[at : at + SLICE_ROWS], 0)
                yield at // SLICE_ROWS, value.astype(np.float16).tobytes(), n.tobytes(), False

    schema = "slice int, value binary, weight binary, pairs boolean"
    parts = settle(map_rows(training, ["text"], schema, rows), "trained")
    slices = _summed(parts.where("not pairs"), 2)
    if not slices:
        return model.weights, parts
    weights = model.weights.copy()
    for at, value, n in slices:
        own = weights[at * SLICE_ROWS : (at + 1) * SLICE_ROWS]
        own[n > 0] = (value.reshape(len(n), -1) / np.maximum(n, 1)[:, None])[n > 0]
    return weights, parts


def fit_pairs(share, codes, times):
    """(context, log of its normaliser, its tokens) and the weight of each pair, of pairs in order.

    P(bucket | context) is share * exp(weight) / normaliser, where pairs never met have weight zero.
    Each step follows the gradient of the likelihood, drawn to zero, scaled by its curvature: first
    every weight by itself, then all weights of a context together.
    """
    import numpy as np

    first = np.flatnonzero(np.diff(context_of(codes), prepend=~codes[:1]))
    size = np.diff(first, append=len(codes))
    total = np.add.reduceat(times, first)
    own, n = share[(codes & np.uint64(BUCKETS - 1)).astype(np.int64)], np.repeat(total, size)
    weight = np.log((times + PAIR_PULL) / (n * own + PAIR_PULL))
    rest = np.maximum(1e-9, 1 - np.add.reduceat(own, first))

    def masses():
        met = own * np.exp(weight)
        return met, rest + np.add.reduceat(met, first)

    for _ in range(PAIR_STEPS):
        met, norm = masses()
        due = n * met / np.repeat(norm, size)
        weight += np.clip((times - due - PAIR_PULL * weight) / (due + PAIR_PULL), -1, 1)
        met, norm = masses()
        left = rest / norm
        slope = total * left - PAIR_PULL * np.add.reduceat(weight, first)
        weight += np.repeat(np.clip(slope / (total * left * (1 - left) + PAIR_PULL * size), -1, 1), size)
    return context_of(codes[first]), np.log(masses()[1]), total, weight


PAIRS = "shard int, codes binary, logs binary, contexts binary, context_logs binary, hot boolean"


def train_pairs(met: DataFrame, model: Model) -> DataFrame:
    """Weights of all pairs counted in ``met``, by shard. Rows marked ``hot`` are for every task; they are few, whatever the corpus."""
    shared = met.sparkSession.sparkContext.broadcast((model.share, model.shards, max(1, model.tokens / HOT_SHARE)))

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        share, shards, least = shared.value
        for shard, codes, times in of_shards(found, True):
            contexts, log_z, total, weight = fit_pairs(share, codes, times)
            frequent = total >= least
            size = np.diff(np.searchsorted(context_of(codes), contexts), append=len(codes))
            in_frequent, hot = np.repeat(frequent, size), times >= least
            # A pair of a context that is not frequent holds all it adds; in a frequent one the task adds the rest.
            logs = weight - np.where(in_frequent, 0, np.repeat(log_z, size))

            def row(k, pairs, of=None, hot=False):
                of = np.zeros(len(contexts), bool) if of is None else of
                return (
                    k, codes[pairs].tobytes() if hot else packed(codes[pairs]), logs[pairs].astype(np.float32).tobytes(),
                    contexts[of].tobytes(), (-log_z[of]).astype(np.float32).tobytes(), hot,
                )

            yield row(shard, ~in_frequent, ~frequent)
            if frequent.any():
                yield row(shard, hot, frequent, True)
                rest = in_frequent & ~hot
                place = spread_shard(shard, codes, shards)
                for k in np.unique(place[rest]).tolist():
                    yield row(k, rest & (place == k))

    names = ["shard", "value", "weight"]
    met = met.where("pairs").select(F.col("slice").alias("shard"), "value", "weight")
    return settle(map_rows(by_shard(met), names, PAIRS, rows), "pair-weights")


def at_places(table, keys):
    """Places of ``keys`` in an ordered table, and whether they are there."""
    import numpy as np

    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, table[at] == keys


def train(training: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame, DataFrame]:
    """The model of the ``text`` column, the counts of all its words and the weights of all its pairs.

    Null and empty texts are one token, the end. Repeated rows count as often as they stand there. A
    table without rows gives counts of zero. Columns other than ``text`` are not read.
    """
    import numpy as np

    training = training.select("text")
    counts, slices = count_texts(training)
    texts = training.count()
    # One row per bucket: a fixed number.
    of_bucket = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()
    tokens, kinds = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in of_bucket:
        tokens[r["bucket"]], kinds[r["bucket"]] = r["n"], r["kinds"]
    classes = np.zeros(BUCKETS, np.int64)
    if slices and tokens.any():
        classes = cluster(np.concatenate([x for _, x in slices]).reshape(BUCKETS, PROFILE), tokens)
    # Each bucket has a place for unseen words.
    of_buckets = tokens + kinds + 1
    mass = np.zeros(CLASSES + 1)
    np.add.at(mass, classes, of_buckets)
    # The end of a text is the only word of its class.
    mass[CLASSES] = texts + 1
    hot = hot_words(counts)
    all_tokens = int(tokens.sum()) + texts
    model = Model(
        weights=np.zeros((ROWS, CLASSES + 1), np.float32),
        prior=np.log(np.maximum(mass, 1e-9) / mass.sum()).astype(np.float32),
        classes=classes,
        log_mass=np.log10(np.maximum(mass, 1e-9)),
        tokens=all_tokens,
        kinds=int(kinds.sum()) + (texts > 0),
        texts=texts,
        hot=hot[0],
        hot_counts=hot[1],
        share=of_buckets / mass[classes],
        shards=max(PAIR_SHARDS, -(-all_tokens // SHARD_TOKENS)),
    )
    met = None
    for _ in range(max(1, rounds)):
        if met is not None:
            discard(met)
        model.weights, met = train_weights(training, model)
    pairs = train_pairs(met, model)
    discard(met)
    for names, kind in ((("contexts", "context_logs"), "contexts"), (("codes", "logs"), "pairs")):
        # At most ``HOT_SHARE`` of each.
        found = pairs.where("hot").select(*names).collect()
        keys = np.frombuffer(b"".join(r[0] for r in found), np.uint64)
        logs, order = np.frombuffer(b"".join(r[1] for r in found), np.float32), np.argsort(keys)
        setattr(model, kind, keys[order])
        setattr(model, "context_logs" if kind == "contexts" else "pair_logs", logs[order])
    return model, counts, pairs.where("not hot").drop("hot")


def hot_words(counts: DataFrame, most: int = HOT_WORDS):
    """Hashes, in order, and counts of the most frequent words: ``most`` at the most."""
    import numpy as np

    level = F.floor(8 * F.log2("n")).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()
    least, left = None, most
    for r in sorted(levels, reverse=True):
        left -= r["words"]
        if left < 0:
            break
        least = r["level"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = counts.where(level >= least).select("word", "n").toArrow()
    word, n = found["word"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(word)
    return word[order], n[order]


ASKED = (
    "shard int, kind int, row long, codes binary, a binary, b binary, c binary, "
    "doc_id long, held_out boolean, n_tokens long, known long, log_part double, base_log double"
)
# What a row of ASKED is: weights or counts of a shard, a question to them, or a text's own part.
KNOWN, QUESTION, TEXT = 0, 1, 2
FOUND = "row long, doc_id long, held_out boolean, n_tokens long, known long, log_part double, base_log double"


def known_words(counts: DataFrame, shards: int) -> DataFrame:
    """The counts of all words as rows of ``ASKED``: their shards follow those of the pairs."""
    from appkpi.llm.common import _arrow_schema, in_small_batches

    target = _arrow_schema(counts.sparkSession, ASKED)

    def rows(batches) -> Iterator[tuple]:
        import numpy as np

        def flush() -> Iterator[tuple]:
            words, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(words)
            words, n = words[order], n[order]
            edges = np.searchsorted(shard_of(words, WORD_SHARDS), np.arange(WORD_SHARDS + 1))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                own = slice(edges[k], edges[k + 1])
                yield shards + k, KNOWN, None, words[own].tobytes(), n[own].tobytes(), *[None] * 8

        held, size = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= FLUSH_TOKENS:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def run(batches):
        yield from pack(rows(batches), target)

    return in_small_batches(counts.select("word", "n")).mapInArrow(run, ASKED)


def look_up(known: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """Parts of the rows' scores: those the texts have themselves, and those of the shards they ask.

    Shards below ``shards`` hold pairs, those from there on words.
    """
    from appkpi.llm.common import _arrow_schema, in_small_batches

    both = known.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "kind")
    target = _arrow_schema(asked.sparkSession, FOUND)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def ordered(keys, values):
            keys, values = (np.concatenate(x or [np.zeros(0, np.uint64)]) for x in (keys, values))
            order = np.argsort(keys)
            return keys[order], values[order]

        def own_parts():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*texts, strict=True), target, strict=True)], schema=target
            )

        shard, tables, held, texts = None, None, ([], [], [], []), []
        for at, kind, row, codes, a, b, c, *text in unpack(batches):
            if at != shard:
                shard, tables, held = at, None, ([], [], [], [])
            of_words = at >= shards
            if kind == TEXT:
                texts.append((row, *text))
                if len(texts) >= 10_000:
                    yield own_parts()
                    texts = []
                continue
            codes = np.frombuffer(codes, np.uint64) if of_words else unpacked(codes, at)
            if kind == KNOWN:
                given = (codes, np.frombuffer(a, np.int64 if of_words else np.float32))
                if not of_words:
                    given += (np.frombuffer(b, np.uint64), np.frombuffer(c, np.float32))
                for own, x in zip(held, given, strict=False):
                    own.append(x)
                continue
            if tables is None:
                tables = ordered(*held[:2]), ordered(*held[2:])
            (keys, values), (contexts, context_logs) = tables
            doc, own = np.unique(np.frombuffer(a, np.uint32).cumsum(), return_inverse=True)
            place, found = at_places(keys, codes)
            value, none = np.zeros(len(codes)), np.zeros(len(doc))
            if of_words:
                value[found] = np.log10(values[place[found]] + 1.0)
                met = np.bincount(own[found], minlength=len(doc)).astype(np.int64)
                parts = met, none, np.bincount(own, value, len(doc))
            else:
                near, there = at_places(contexts, context_of(codes))
                value[there] = context_logs[near[there]]
                value[found] = values[place[found]]
                parts = none.astype(np.int64), np.bincount(own, value, len(doc)) / np.log(10), none
            nothing = [pa.nulls(len(doc), target.field(k).type) for k in range(1, 4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + doc.astype(np.int64)), *nothing, *map(pa.array, parts)], schema=target
            )
        if texts:
            yield own_parts()

    return in_small_batches(both).mapInArrow(run, FOUND)


def score(docs: DataFrame, model: Model, counts: DataFrame, pairs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row's text.

    Null texts count as empty: one token, the end. What a task does not know by heart it asks for: words and
    pairs go to the shards that hold their counts and weights, some million tokens of texts at a time, and the
    texts' own parts travel with them. Rows may repeat or lack ids; without one, ``held_out`` may be null.
    Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np
        from pyspark import TaskContext

        model = shared.value
        row = TaskContext.get().partitionId() << 40
        pairs, words, size, start = [], [], 0, row

        def questions(held, first, as_bytes) -> Iterator[tuple]:
            shard, codes, place = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(shard * (row - start) + place)
            shard, place, codes = shard[order], place[order], codes[order]
            edges = [*np.flatnonzero(np.diff(shard, prepend=-1)).tolist(), len(codes)]
            for a, b in pairwise(edges):
                # Places as steps, which are small numbers.
                steps = np.diff(place[a:b], prepend=0).astype(np.uint32)
                yield first + int(shard[a]), QUESTION, start, as_bytes(codes[a:b]), steps.tobytes(), *[None] * 8

        def flush() -> Iterator[tuple]:
            yield from questions(pairs, 0, packed)
            yield from questions(words, model.shards, lambda codes: codes.tobytes())

        hot_logs = np.log10(model.hot_counts + 1.0)
        for texts, hashes, buckets, sizes in in_groups(found):
            classes, history = model.classes_of(buckets, sizes), history_rows(hashes, buckets, sizes)
            part = -model.log_mass[classes]
            for at in range(0, len(classes), BATCH_TOKENS):
                ends = slice(at, at + BATCH_TOKENS)
                part[ends] += model.log_probabilities(history[:, ends], classes[ends]) / np.log(10)
            part = np.add.reduceat(part, np.cumsum(sizes + 1) - sizes - 1)
            text = np.repeat(np.arange(len(sizes)), sizes)

            # Equal pairs and words side by side: tables are walked in their order.
            codes = pair_codes(hashes, model.classes[buckets], buckets, sizes)
            order = np.argsort(codes)
            codes, of = codes[order], text[order]
            shard = shard_of(codes, model.shards)
            codes = in_shard(codes, shard)
            at, frequent = at_places(model.contexts, context_of(codes))
            logs = np.where(frequent, model.context_logs[at] if len(model.contexts) else 0.0, 0.0).astype(np.float64)
            at, there = at_places(model.pairs, codes)
            logs[there] += model.pair_logs[at[there]]
            part += np.bincount(of, logs, len(sizes)) / np.log(10)
            shard = np.where(frequent, spread_shard(shard, codes, model.shards), shard)
            pairs.append((shard[~there], codes[~there], of[~there] + (row - start)))

            order = np.argsort(hashes)
            word, of = hashes[order], text[order]
            at, hot = at_places(model.hot, word.view(np.int64))
            hot_log = np.bincount(of[hot], hot_logs[at[hot]], len(sizes))
            known = np.bincount(of[hot], minlength=len(sizes))
            rare = word[~hot]
            words.append((shard_of(rare, WORD_SHARDS), rare, of[~hot] + (row - start)))
            size += len(pairs[-1][0]) + len(rare)
            own_parts = (sizes + 1).tolist(), known.tolist(), part.tolist(), hot_log.tolist()
            for (doc_id, is_held), *own in zip(texts, *own_parts, strict=True):
                # A text's own part goes to any shard: it meets the others by its row.
                yield int(row % model.shards), TEXT, row, *[None] * 4, doc_id, is_held, *own
                row += 1
            if size >= SCORE_TOKENS or row - start >= 100_000:
                yield from flush()
                pairs, words, size, start = [], [], 0, row
        if size:
            yield from flush()

    names = ["doc_id", "held_out", "text"]
    asked = map_rows(docs.select("doc_id", held_out.alias("held_out"), "text"), names, ASKED, rows)
    empty = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in ASKED.split(", ")[7:])]
    of_pairs = pairs.select(
        "shard", F.lit(KNOWN).alias("kind"), F.lit(None).cast("long").alias("row"), "codes", F.col("logs").alias("a"),
        F.col("contexts").alias("b"), F.col("context_logs").alias("c"), *empty,
    )
    found = look_up(of_pairs.unionByName(known_words(counts, model.shards)), asked, model.shards)
    end_log, ends_known = F.log10(F.lit(model.texts + 1.0)), F.lit(int(model.texts > 0))
    space = F.log10(F.lit(float(model.tokens + model.kinds + 1)))
    whole = found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum("known").alias("known"),
        F.sum("log_part").alias("log_part"),
        (F.sum("base_log") + end_log).alias("logs"),
    )
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + ends_known).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * space).alias("base_score"),
        (F.col("logs") + F.col("log_part")).alias("score"),
    )
