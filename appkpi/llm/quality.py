"""Quality rules: counts with fixed limits, then a calibrated classifier on hashed n-grams.

The classifier is a logistic regression on the shares that hashed word 1- and 2-grams and byte 3-
and 5-grams have in a text. It is fitted on all labelled rows: shards of them are fitted in numpy side by
side and averaged. Rows that the weights have not seen turn margins into probabilities (Platt scaling).
Scoring reads the whole text and needs nothing but the weights, so it is one map over the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.llm.common import discard, in_small_batches, map_rows, settle
from appkpi.llm.labelled import (
    BLOCK,
    CALIBRATION_SHARE,
    averaged,
    changed_blocks,
    class_counts,
    labelled_rows,
)
from appkpi.llm.words import hash_words

# Fixed limits.
LEAST_WORDS = 20
REPEAT_WINDOW = 8
MOST_REPEATED_PERCENT = 30
LEAST_PROBABILITY = 0.5
SYMBOLS = "#*$%&|<>"

BLANKS = " \t\n\r\x0b\x0c"
BUCKET_BITS = 16
# Labelled rows that are fitted together, about.
SHARD_ROWS = 1500
STEPS = 48
# Buckets of some rows that a step goes over at a time.
PIECE_SHARES = 1 << 17
# Margins are counted in steps of this size before they become probabilities.
MARGIN_STEP = 2.0**-8


def base_counts(text: str, hashes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text with these word hashes."""
    import numpy as np

    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    n, size = len(hashes), REPEAT_WINDOW
    repeated = 0
    if n > size:
        runs = np.zeros(n - size + 1, np.uint64)
        for j in range(size):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n - size + 1 + j]
        order = np.sort(runs)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            # Every word that lies in a window found twice.
            step = np.zeros(n + 1, np.int64)
            starts = np.flatnonzero(np.isin(runs, twice))
            np.add.at(step, starts, 1)
            np.add.at(step, starts + size, -1)
            repeated = int(np.count_nonzero(np.cumsum(step)[:n]))
    return (
        n,
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
    )


def features(raw: bytes, hashes) -> list:
    """Bucket numbers of each kind of n-gram, in kinds of one space each."""
    import numpy as np

    shift, mix = np.uint64(64 - BUCKET_BITS), np.uint64(0x9E3779B97F4A7C15)
    b = np.frombuffer(raw, np.uint8).astype(np.uint64)
    three = b[:-2] | b[1:-1] << np.uint64(8) | b[2:] << np.uint64(16) if len(b) > 2 else b[:0]
    five = three[:-2] | b[3:-1] << np.uint64(24) | b[4:] << np.uint64(32) if len(b) > 4 else b[:0]
    two = hashes[:-1] * np.uint64(3) + hashes[1:]
    kinds = (hashes, two, three, five)
    return [((k * mix) >> shift).astype(np.int32) for k in kinds]


@dataclass
class Model:
    """Weights by kind and bucket; probability = sigmoid(slope * margin + offset)."""

    weights: object
    bias: float
    slope: float
    offset: float

    def margin(self, raw: bytes, hashes) -> float:
        margin = self.bias
        for w, at in zip(self.weights, features(raw, hashes), strict=True):
            if len(at):
                margin += float(w[at].mean())
        return margin

    def probability(self, raw: bytes, hashes) -> float:
        import math

        z = self.slope * self.margin(raw, hashes) + self.offset
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def bucket_shares(rows: Iterator[tuple[str, int]]) -> tuple:
    """Bucket and share of every bucket of every (text, label), in rows, how many each row has, and the labels."""
    import numpy as np

    size = 1 << BUCKET_BITS
    at, value, sizes, y = [], [], [], []
    for text, label in rows:
        raw = text.encode()
        n = 0
        for kind, found in enumerate(features(raw, hash_words(raw))):
            bucket, count = np.unique(found, return_counts=True)
            at.append((bucket + kind * size).astype(np.int32))
            value.append((count / max(1, len(found))).astype(np.float32))
            n += len(bucket)
        sizes.append(n)
        y.append(label)
    joined = []
    for parts, kind in ((at, np.int32), (value, np.float32)):
        joined.append(np.concatenate([np.zeros(0, kind), *parts]))
        parts.clear()
    return *joined, np.array(sizes, np.int64), np.array(y, np.int64)


def in_pieces(at, value, sizes) -> Iterator[tuple]:
    """Rows in pieces of about ``PIECE_SHARES`` buckets: the first row, rows of the entries, buckets, shares, how many rows."""
    import numpy as np

    ends = np.cumsum(sizes)
    row = 0
    while row < len(sizes):
        begin = int(ends[row] - sizes[row])
        stop = max(row + 1, int(np.searchsorted(ends, begin + PIECE_SHARES, "right")))
        own = np.repeat(np.arange(stop - row), sizes[row:stop])
        end = int(ends[stop - 1])
        yield row, own, at[begin:end], value[begin:end], stop - row
        row = stop


def margins_of(weights, bias, at, value, sizes):
    import numpy as np

    out = np.zeros(len(sizes))
    for row, own, bucket, share, n in in_pieces(at, value, sizes):
        out[row : row + n] = np.bincount(own, weights[bucket] * share, n)
    return out + bias


def descend(at, value, sizes, y, balance) -> tuple:
    """Weights and bias by gradient steps; ``balance`` is what each row weighs."""
    import numpy as np

    weights = np.zeros(4 << BUCKET_BITS)
    bias, slow, fast = 0.0, np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        slope = np.zeros_like(weights)
        total = np.zeros(len(y))
        for row, own, bucket, share, n in in_pieces(at, value, sizes):
            rows = slice(row, row + n)
            margin = np.bincount(own, weights[bucket] * share, n) + bias
            total[rows] = pull = balance[rows] * (1 / (1 + np.exp(-margin)) - y[rows])
            # Adds one after another, in order, as one sum over all pieces would.
            np.add.at(slope, bucket, pull[own] * share)
        slope += 1e-7 * weights
        slow, fast = 0.9 * slow + 0.1 * slope, 0.99 * fast + 0.01 * slope**2
        weights -= 0.5 * slow / (1 - 0.9**step) / (np.sqrt(fast / (1 - 0.99**step)) + 1e-6)
        bias -= 0.5 * total.sum()
    return weights, float(bias)


def fit(rows: Iterator[tuple[str, int]]) -> Model:
    """Fitted on rows in memory: weights on four fifths of them, calibrated on the rest."""
    import numpy as np

    at, value, sizes, y = bucket_shares(rows)
    if len(set(y.tolist())) < 2:
        # Nothing to tell apart: every text is as good as the rows seen.
        return Model(np.zeros((4, 1 << BUCKET_BITS)), 0.0, 0.0, 20.0 if not len(y) or y[0] else -20.0)
    seen = np.arange(len(y)) % CALIBRATION_SHARE != 0
    if len(set(y[seen])) < 2 or len(set(y[~seen])) < 2:
        seen[:] = True
    balance = np.where(y == 1, 0.5 / max(1, (y[seen] == 1).sum()), 0.5 / max(1, (y[seen] == 0).sum()))
    weights, bias = descend(at, value, sizes, y, np.where(seen, balance, 0.0))
    margin = margins_of(weights, bias, at, value, sizes)
    held = ~seen if (~seen).any() else seen
    a, b = platt(margin[held], y[held])
    return Model(weights.astype(np.float32).reshape(4, -1), bias, a, b)


def platt(margin, y, rows=None) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, both classes weighing the same.

    ``rows`` says how many rows each margin stands for, one if not given.
    """
    import numpy as np

    rows = np.ones(len(y)) if rows is None else rows
    scale = max(1e-9, float(np.average(np.abs(margin), weights=rows)))
    x = np.stack([margin / scale, np.ones_like(margin)], 1)
    ones, zeros = rows[y == 1].sum(), rows[y == 0].sum()
    aim = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    weigh = rows * np.where(y == 1, 0.5 / max(1, ones), 0.5 / max(1, zeros))
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weigh * (p - aim)) + 1e-4 * theta
        bend = (x * (weigh * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        theta = theta - np.linalg.solve(bend, slope)
    return float(max(theta[0], 0.0) / scale), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None,
          shard_rows: int = SHARD_ROWS) -> Model:
    """Fits on all labelled rows, in shards of about ``shard_rows``; the weights (1 MB) come back."""
    import numpy as np

    allowed = F.lit(True) if allowed is None else allowed
    rows = settle(labelled_rows(docs, labels, "quality", allowed, shard_rows).drop("lang"), "labelled-texts")
    counts = class_counts(rows)
    total = [sum(n for (_, y), n in counts.items() if y == own) for own in (0, 1)]
    if not all(total):
        discard(rows)
        return fit(("", y) for y in (0, 1) if total[y])
    # Where a class has too few rows to be parted, all rows do both.
    parted = len(counts) == 4
    seen, held = (rows.where("not held"), rows.where("held")) if parted else (rows, rows)
    weigh = [sum(total) / total[0], sum(total) / total[1]]

    def learn(shard: int, found: list[tuple]) -> Iterator[tuple]:
        *shares, y = bucket_shares(found)
        balance = 0.5 * np.array(weigh)[y] / len(y)
        weights, bias = descend(*shares, y, balance)
        after = np.append(weights, [bias] + [0.0] * (BLOCK - 1)).reshape(-1, BLOCK)
        return changed_blocks(np.zeros_like(after), after)

    blocks, change = averaged(seen, ["text", "y"], BLOCK, learn, "quality-weights")
    fitted = np.zeros(((4 << BUCKET_BITS) // BLOCK + 1, BLOCK))
    fitted[blocks] = change
    weights = fitted[:-1].astype(np.float32).reshape(4, -1)
    model = Model(weights, float(fitted[-1, 0]), 1.0, 0.0)
    begun = docs.sparkSession.sparkContext.broadcast(model)

    def margins(found: Iterator[tuple]) -> Iterator[tuple]:
        for text, y in found:
            raw = text.encode()
            margin = begun.value.margin(raw, hash_words(raw))
            yield y, int(np.clip(np.rint(margin / MARGIN_STEP), -(2**16), 2**16))

    scored = map_rows(held, ["text", "y"], "y int, step int", margins).groupBy("y", "step").count()
    # At most two rows for each of 2**17 steps.
    found = scored.orderBy("y", "step").toArrow()
    y, step, n = (found[c].to_numpy() for c in ("y", "step", "count"))
    model.slope, model.offset = platt(step * MARGIN_STEP, y, n)
    discard(rows)
    return model


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, probability double, kept boolean"
)


def verdict(text: str | None, model: Model) -> tuple:
    text = text or ""
    raw = text.encode()
    hashes = hash_words(raw)
    counts = base_counts(text, hashes)
    failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED_PERCENT * counts[0]
    p = model.probability(raw, hashes)
    return *counts, failed, p, not failed and p >= LEAST_PROBABILITY


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, ``base_failed``, ``probability`` and ``kept``.

    A null text counts as an empty one, which fails for its lack of words. Other columns are not
    read; ids may be null or repeat.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in found:
            yield doc_id, *verdict(text, weights.value)

    return map_rows(docs, ["doc_id", "text"], f"doc_id long, {VERDICT}", rows)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that ``score_quality`` keeps, all their columns unchanged."""
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text")
            kept = [verdict(texts[i].as_py(), weights.value)[-1] for i in range(batch.num_rows)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return in_small_batches(docs).mapInArrow(run, docs.schema)
