"""Toxicity: a convolutional classifier over hashed word embeddings, in numpy.

A word is the sum of two rows of a hashed table, so a rare clash of one row does not make a word
look like another, and of a row of its first bytes, which words of one stem share. Filters of widths 1, 2 and 3 slide over the words, each keeps its highest
response in the text (max pooling), and a logistic layer weighs them. It is fitted on all labelled
rows: shards of them train side by side and are averaged after every round. Rows that the weights
have not seen set one threshold for each language. Scores depend on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.llm.common import discard, in_small_batches, map_rows, settle
from appkpi.llm.labelled import BLOCK, averaged, changed_blocks, class_counts, labelled_rows
from appkpi.llm.words import hash_words_and_starts, mix

TABLE_BITS = 16
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
# Labelled rows that train a copy of the model together, about.
SHARD_ROWS = 2000
# How often the copies are averaged.
ROUNDS = 2
# Small shards are gone over more often.
LEAST_VISITS = 6000
STEP = 0.05
# Words are hidden with this chance while training.
HIDDEN_SHARE = 0.3
# Words of fewer different texts are not learned.
LEAST_TEXTS = 4
# A language with fewer unseen rows of a class than this keeps the threshold 0.5.
LEAST_CALIBRATION_ROWS = 10
# Words that go through the filters at a time; texts may be longer.
CHUNK_WORDS = 8192
# First bytes of a word that have a row of their own.
PREFIX_BYTES = 5
# The row of words that are not learned: always zeros.
UNKNOWN = 1 << TABLE_BITS
# Thresholds are 1 / (1 + 2**-k) for k from -CUTS to CUTS.
CUTS = 6
# A clean text flagged costs as much as this many toxic ones passed over.
FALSE_ALARM_COST = 3
# Signs that part words like blanks.
SPLIT = bytes(32 if chr(b) in ".,;:!?\"'()[]{}*#$%&|<>-" else b for b in range(256))


def table_rows(text: str):
    """The table rows of each word: two of the word, one of its first bytes, whatever its case."""
    import numpy as np

    raw = text.lower().encode().translate(SPLIT)
    hashes, starts = hash_words_and_starts(raw, PREFIX_BYTES)
    if not len(hashes):
        hashes = starts = np.zeros(1, np.uint64)
    top = np.uint64(64 - TABLE_BITS)
    word = [hashes >> top, (hashes << np.uint64(TABLE_BITS)) >> top, mix(starts) >> top]
    return np.stack(word).astype(np.int64)


@dataclass
class Model:
    table: object
    filters: list
    shifts: list
    weights: object
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, rows):
        """Highest response of each filter, and where its window begins."""
        import numpy as np

        wide, n = max(WIDTHS), rows.shape[1]
        pools = len(WIDTHS) * FILTERS
        # All filters as one matrix over the words of the widest window.
        every = np.zeros((wide, DIMENSIONS, pools), np.float32)
        for k, (width, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            every[:width, :, k * FILTERS : (k + 1) * FILTERS] = f
        every = every.reshape(wide * DIMENSIONS, pools)
        best = np.full(pools, -np.inf, np.float32)
        where = np.zeros(pools, np.int64)
        for at in range(0, n, CHUNK_WORDS):
            m = min(CHUNK_WORDS, n - at)
            # Windows may reach over the end of the text, where there are zeros.
            words = np.zeros((m + wide - 1, DIMENSIONS), np.float32)
            part = rows[:, at : at + m + wide - 1]
            words[: part.shape[1]] = self.table[part[0]] + self.table[part[1]] + self.table[part[2]]
            out = np.concatenate([words[j : j + m] for j in range(wide)], axis=1) @ every
            top = out.argmax(axis=0)
            value = out[top, np.arange(pools)]
            better = value > best
            best = np.where(better, value, best)
            where = np.where(better, at + top, where)
        return best + np.concatenate(self.shifts), where

    def score(self, rows) -> float:
        import numpy as np

        best, _ = self.pooled(rows)
        z = float(np.maximum(best, 0) @ self.weights) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def common_words(sample: list) -> list:
    """For each text, which of its words are in ``LEAST_TEXTS`` different texts or more."""
    import numpy as np

    words = [(at[0] << TABLE_BITS) | at[1] for at in sample]
    first = {w.tobytes(): i for i, w in enumerate(words)}
    found = np.concatenate([different(words[i]) for i in first.values()] or [np.zeros(0, np.int64)])
    word, texts = np.unique(found, return_counts=True)
    # The last one stands for all that are greater; no word is that great.
    usual = np.append(word[texts >= LEAST_TEXTS], np.iinfo(np.int64).max)
    return [usual[np.searchsorted(usual, w)] == w for w in words]


def different(words):
    """The different words of a text, sorted. ``np.unique`` hashes them, which takes some ten times as long."""
    import numpy as np

    words = np.sort(words)
    first = np.ones(len(words), bool)
    first[1:] = words[1:] != words[:-1]
    return words[first]


def new_model() -> Model:
    import numpy as np

    random = np.random.default_rng(7)
    pools = len(WIDTHS) * FILTERS
    return Model(
        # Words not seen in training are zeros, and so say nothing either way.
        np.zeros((UNKNOWN + 1, DIMENSIONS), np.float32),
        [random.normal(0, 0.5, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.full(FILTERS, 0.05, np.float32) for _ in WIDTHS],
        random.normal(0, 0.5, pools).astype(np.float32),
        0.0,
    )


def as_blocks(model: Model):
    """All that is trained, as rows of ``BLOCK`` numbers: a word's row keeps its number."""
    import numpy as np

    rest = np.concatenate(
        [*[f.ravel() for f in model.filters], *model.shifts, model.weights, [model.bias]]
    ).astype(np.float64)
    rest = np.pad(rest, (0, -len(rest) % BLOCK)).reshape(-1, BLOCK)
    return np.concatenate([model.table.astype(np.float64), rest])


def from_blocks(blocks) -> Model:
    import numpy as np

    rest = blocks[UNKNOWN + 1 :].ravel()
    sizes = [w * DIMENSIONS * FILTERS for w in WIDTHS] + [FILTERS] * len(WIDTHS) + [len(WIDTHS) * FILTERS]
    *parts, tail = np.split(rest, np.cumsum(sizes))
    parts = [p.astype(np.float32) for p in parts]
    n = len(WIDTHS)
    filters = [p.reshape(w, DIMENSIONS, FILTERS) for w, p in zip(WIDTHS, parts[:n], strict=True)]
    return Model(blocks[: UNKNOWN + 1].astype(np.float32), filters, parts[n : 2 * n], parts[-1], float(tail[0]))


def visit(model: Model, past: Model, seen: list, weigh: dict[int, float], times: int, seed: list[int]) -> None:
    """Trains the model on (table rows, y) in place. ``past`` holds the squared slopes so far."""
    import numpy as np

    usual = common_words([at for at, _ in seen])
    random = np.random.default_rng(seed)
    for _ in range(times):
        for i in random.permutation(len(seen)):
            at, y = seen[i]
            # Some words are hidden at every visit, so that no text hangs on one of them.
            at = np.where(usual[i], at, [[UNKNOWN], [UNKNOWN], [0]] + at * [[0], [0], [1]])
            at = at[:, random.random(at.shape[1]) >= HIDDEN_SHARE]
            if not at.shape[1]:
                continue
            best, where = model.pooled(at)
            z = float(np.maximum(best, 0) @ model.weights) + model.bias
            pull = weigh[y] * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
            if abs(pull) < 1e-3:
                continue
            back = np.where(best > 0, pull * model.weights, 0).astype(np.float32)
            # Small weights are worth less than they cost: fewer words are learned by heart.
            slope = pull * np.maximum(best, 0) + 1e-4 * model.weights
            past.weights += slope**2
            model.weights -= STEP * slope / np.sqrt(past.weights)
            past.bias += pull**2
            model.bias -= STEP * pull / np.sqrt(past.bias)
            n = at.shape[1]
            for k, width in enumerate(WIDTHS):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                live = np.flatnonzero(back[own])
                if not len(live):
                    continue
                f, g = model.filters[k], back[own][live]
                f_slope = np.zeros_like(f)
                for j in range(width):
                    place = where[own][live] + j
                    inside = place < n
                    pair = at[:, np.minimum(place, n - 1)]
                    words = model.table[pair].sum(axis=0) * inside[:, None]
                    f_slope[j][:, live] = (words * g[:, None]).T
                    push = (f[j][:, live] * g).T * inside[:, None]
                    for side in pair:
                        np.add.at(past.table, side, push**2)
                        np.add.at(model.table, side, -STEP * push / np.sqrt(past.table[side]))
                model.table[UNKNOWN] = 0
                past.filters[k] += f_slope**2
                f -= STEP * f_slope / np.sqrt(past.filters[k])
                s_slope = back[own]
                past.shifts[k] += s_slope**2
                model.shifts[k] -= STEP * s_slope / np.sqrt(past.shifts[k])


def best_cut(counts: dict[tuple[int, int], int], shift: int = 0) -> int:
    """The k whose threshold costs least over (y, step of the score); of equal ones that nearest the middle.

    A score of step s reaches the thresholds up to k = s - shift.
    """
    n = [sum(c for (y, _), c in counts.items() if y == own) for own in (0, 1)]

    def cost(k: int) -> float:
        alarms = sum(c for (y, s), c in counts.items() if not y and s >= k + shift)
        missed = sum(c for (y, s), c in counts.items() if y and s < k + shift)
        return FALSE_ALARM_COST * alarms / n[0] + missed / n[1]

    cuts = range(-CUTS, CUTS + 1)
    least = min(map(cost, cuts))
    return min((k for k in cuts if cost(k) <= least + 1e-12), key=abs)


def calibrate(model: Model, held: DataFrame) -> None:
    """Sets the bias and a threshold per language by all rows that trained nothing."""
    import numpy as np

    weights = held.sparkSession.sparkContext.broadcast(model)

    def steps(found: Iterator[tuple]) -> Iterator[tuple]:
        for words, lang, y in found:
            p = weights.value.score(unpacked(words))
            step = np.floor(np.log2(p / (1 - p))) if p < 1 else 2 * CUTS
            yield lang, y, int(np.clip(step, -2 * CUTS - 1, 2 * CUTS))

    scored = map_rows(held, ["words", "lang", "y"], "lang string, y int, step int", steps)
    counts = settle(scored.groupBy("lang", "y", "step").agg(F.count("*").alias("n")), "toxicity-steps")
    every = {(r.y, r.step): r.n for r in counts.groupBy("y", "step").agg(F.sum("n").alias("n")).collect()}
    if {y for y, _ in every} != {0, 1}:
        discard(counts)
        return
    shift = best_cut(every)
    model.bias -= shift * float(np.log(2))
    enough = [F.sum(F.when(F.col("y") == y, F.col("n"))) >= LEAST_CALIBRATION_ROWS for y in (0, 1)]
    by_lang = counts.groupBy("lang").agg(
        F.collect_list(F.struct("y", "step", "n")).alias("steps"), (enough[0] & enough[1]).alias("enough")
    )
    for r in by_lang.where("enough").collect():
        k = best_cut({(y, s): n for y, s, n in r.steps}, shift)
        model.thresholds[r.lang] = 1 / (1 + 2.0**-k)
    discard(counts)


def packed(rows) -> bytes:
    """Table rows as bytes; each is below 2**16."""
    import numpy as np

    return rows.astype(np.uint16).tobytes()


def unpacked(words: bytes):
    import numpy as np

    return np.frombuffer(words, np.uint16).reshape(3, -1).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None,
          shard_rows: int = SHARD_ROWS) -> Model:
    """Fits on all labelled rows, in shards of about ``shard_rows``; the weights (2 MB) come back."""
    import numpy as np

    allowed = F.lit(True) if allowed is None else allowed

    def words(found: Iterator[tuple]) -> Iterator[tuple]:
        for *head, text in found:
            yield *head, packed(table_rows(text))

    head = {"shard": "int", "doc_id": "long", "held": "boolean", "lang": "string", "y": "int"}
    schema = ", ".join(f"{c} {t}" for c, t in {**head, "words": "binary"}.items())
    chosen = labelled_rows(docs, labels, "toxic", allowed, shard_rows)
    rows = settle(map_rows(chosen, [*head, "text"], schema, words), "labelled-words")
    counts = class_counts(rows)
    zeros, ones = (counts.get((False, y), 0) for y in (0, 1))
    model = new_model()
    if not zeros or not ones:
        discard(rows)
        model.weights[:] = 0
        model.bias = -8.0 if not ones else 8.0
        return model
    weigh = {1: 0.5 * (zeros + ones) / ones, 0: 0.5 * (zeros + ones) / zeros}
    state = as_blocks(model)
    # The weights and, beside them, the squared slopes so far, by which each weight's step is divided.
    state = np.concatenate([state, np.full_like(state, 1e-4)], axis=1).astype(np.float32)
    for turn in range(ROUNDS):
        begun = docs.sparkSession.sparkContext.broadcast(state)

        def learn(shard: int, found: list[tuple], begun=begun, turn=turn) -> Iterator[tuple]:
            before = begun.value.astype(np.float64)
            model, past = from_blocks(before[:, :BLOCK]), from_blocks(before[:, BLOCK:])
            seen = [(unpacked(words), y) for words, y in found]
            times = max(1, LEAST_VISITS // (ROUNDS * len(seen)))
            visit(model, past, seen, weigh, times, [11, turn, shard])
            after = np.concatenate([as_blocks(model), as_blocks(past)], axis=1)
            return changed_blocks(before, after)

        seen = rows.where("not held")
        blocks, change = averaged(seen, ["words", "y"], 2 * BLOCK, learn, "toxicity-round")
        state[blocks] += change.astype(np.float32)
    model = from_blocks(state[:, :BLOCK])
    calibrate(model, rows.where("held"))
    discard(rows)
    return model


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``score``, ``threshold`` of its language and ``flagged``.

    A null text is scored as an empty one. The score comes from the text alone; ``lang``, where
    ``docs`` has it, only picks the threshold (0.5 for null and for languages without enough rows).
    """
    weights = docs.sparkSession.sparkContext.broadcast(model)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        model = weights.value
        for doc_id, text, lang in found:
            score = model.score(table_rows(text or ""))
            limit = model.thresholds.get(lang, 0.5)
            yield doc_id, score, limit, score >= limit

    return map_rows(
        docs.select("doc_id", "text", lang.alias("lang")),
        ["doc_id", "text", "lang"],
        "doc_id long, score double, threshold double, flagged boolean",
        rows,
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not flagged, all their columns unchanged."""
    weights = docs.sparkSession.sparkContext.broadcast(model)
    has_lang = "lang" in docs.columns

    def run(batches):
        import pyarrow as pa

        model = weights.value
        for batch in batches:
            texts = batch.column("text")
            langs = batch.column("lang") if has_lang else None
            kept = [
                model.score(table_rows(texts[i].as_py() or ""))
                < model.thresholds.get(langs[i].as_py() if has_lang else None, 0.5)
                for i in range(batch.num_rows)
            ]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return in_small_batches(docs).mapInArrow(run, docs.schema)
