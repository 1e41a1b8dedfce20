"""Token-id files: blocks of interleaved range ANS under one shared frequency table.

A file set is a folder with two tables. ``table`` holds the frequency of every id that occurs,
scaled to 2**20. ``blocks`` holds blocks of at most 65,536 ids, each coded by itself: its ids are
dealt over ``LANES`` coders, and all of them write to one stream of 32-bit words. Every
``MARK_STEPS`` ids per lane a checkpoint keeps the states and the place in the stream, so a block
can be decoded from several places at once. A block lists the documents whose ids it holds, and has
checksums of its ids and of its coded bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appkpi.llm.common import map_rows, part_starts, settle
from appkpi.llm.tokens import encoded, library_coder

BLOCK_IDS = 1 << 16
LANES = 128
MARK_STEPS = 128
SCALE_BITS = 20
END_ID = 2
# Blocks that go through the coder side by side.
TOGETHER = 16

DOCS = "doc_ids array<long>, doc_nos array<long>, skips array<long>, lengths array<long>"
RAW = f"part long, block long, inside long, n long, {DOCS}, ids binary"
CODED = (
    f"part long, block long, start long, n long, {DOCS}, words binary, marks binary, "
    "mark_words array<long>, ids_crc long, coded_crc long"
)


def raw_blocks(docs: DataFrame, path: str, end: int = END_ID) -> DataFrame:
    """Ids of all texts in ascending doc_id, cut into blocks; a document may span several.

    Null texts count as empty. Null ids come first; rows with one id go by a hash of their text.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = (
        docs.select("doc_id", "text").repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    )

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        from pyspark import TaskContext

        part, coder, stop = TaskContext.get().partitionId(), library_coder(path), end.to_bytes(2, "little")
        block = inside = room = 0
        held: list[tuple] = []
        pieces: list[bytes] = []

        def flush() -> tuple:
            n = sum(x[3] for x in held)
            columns = [list(c) for c in zip(*held, strict=True)]
            return (part, block, inside, n, *columns, b"".join(pieces))

        room = BLOCK_IDS
        for number, (doc_id, raw) in enumerate(encoded(coder, found)):
            ids = memoryview(raw + stop)
            skip, n = 0, len(ids) // 2
            while skip < n:
                take = min(room, n - skip)
                held.append((doc_id, number, skip, take))
                pieces.append(ids[2 * skip : 2 * (skip + take)])
                skip, room = skip + take, room - take
                if not room:
                    yield flush()
                    block, inside, room = block + 1, inside + BLOCK_IDS, BLOCK_IDS
                    held, pieces = [], []
        if held:
            yield flush()

    return map_rows(ranged, ["doc_id", "text"], RAW, rows)


def frequencies(blocks: DataFrame) -> list[tuple[int, int]]:
    """(id, frequency) of every id that occurs, scaled to sum to 2**20. At most 65,536 rows."""

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        seen = np.zeros(1 << 16, np.int64)
        for (ids,) in found:
            seen += np.bincount(np.frombuffer(ids, "<u2"), minlength=1 << 16)
        at = np.flatnonzero(seen)
        yield from zip(at.tolist(), seen[at].tolist(), strict=True)

    counts = map_rows(blocks, ["ids"], "id int, n long", rows).groupBy("id").agg(F.sum("n").alias("n"))
    return scaled(sorted((r["id"], r["n"]) for r in counts.collect()))


def scaled(counts: list[tuple[int, int]], bits: int = SCALE_BITS) -> list[tuple[int, int]]:
    if not counts:
        return []
    total, spare = sum(n for _, n in counts), (1 << bits) - len(counts)
    out = {i: 1 + n * spare // total for i, n in counts}
    largest = max(counts, key=lambda c: (c[1], -c[0]))[0]
    out[largest] += (1 << bits) - sum(out.values())
    return sorted(out.items())


class Coder:
    """Codes and decodes blocks side by side with one frequency table."""

    def __init__(self, table: list[tuple[int, int]]) -> None:
        import numpy as np

        ids, freq = (np.array(c, np.int64) for c in zip(*table, strict=True))
        self.freq = np.zeros(1 << 16, np.uint64)
        self.freq[ids] = freq
        first = np.zeros(1 << 16, np.uint64)
        first[ids] = np.cumsum(freq) - freq
        self.first = first
        self.slot_id = np.repeat(ids, freq).astype(np.uint16)
        self.filler = int(ids[freq.argmax()])

    def encode(self, blocks: list[bytes]) -> list[tuple[bytes, bytes, list[int]]]:
        """(words, states at the marks, words before each mark) of blocks that need equal steps."""
        import numpy as np

        ids = [np.frombuffer(b, "<u2") for b in blocks]
        steps = -(-len(ids[0]) // LANES)
        padded = np.full((len(ids), steps * LANES), self.filler, np.uint16)
        for row, own in zip(padded, ids, strict=True):
            row[: len(own)] = own
        symbols = padded.reshape(len(ids), steps, LANES).transpose(1, 0, 2)
        state = np.full(symbols.shape[1:], 1 << 31, np.uint64)
        low = np.zeros(symbols.shape, np.uint32)
        out = np.zeros(symbols.shape, bool)
        marks = []
        scale, word, room = np.uint64(SCALE_BITS), np.uint64(32), np.uint64(63 - SCALE_BITS)
        for t in range(steps - 1, -1, -1):
            f, c = self.freq[symbols[t]], self.first[symbols[t]]
            full = state >= f << room
            out[t], low[t] = full, state.astype(np.uint32)
            state = np.where(full, state >> word, state)
            times = state // f
            state = (times << scale) + (state - times * f) + c
            if t % MARK_STEPS == 0:
                marks.append(state)
        marks.reverse()
        spent = np.concatenate([[np.zeros(len(ids), np.int64)], out.sum(axis=2).cumsum(axis=0)])
        return [
            (
                low[:, i][out[:, i]].astype("<u4").tobytes(),
                np.stack([m[i] for m in marks]).astype("<u8").tobytes(),
                spent[: steps : MARK_STEPS, i].tolist(),
            )
            for i in range(len(ids))
        ]

    def decode(self, coded: list[tuple[bytes, bytes, list[int], int]]) -> list:
        """Ids of blocks (words, states, words before each mark, number of ids), from all marks at once."""
        import numpy as np

        ids = [np.zeros(-(-n // LANES) * LANES, np.uint16) for *_, n in coded]
        stream, at, runs = [], 0, {}
        for k, (words, states, before, n) in enumerate(coded):
            stream.append(np.frombuffer(words, "<u4"))
            for m, (state, spent) in enumerate(
                zip(np.frombuffer(states, "<u8").reshape(-1, LANES), before, strict=True)
            ):
                steps = min(MARK_STEPS, -(-n // LANES) - m * MARK_STEPS)
                runs.setdefault(steps, []).append((k, m, state, at + spent))
            at += len(stream[-1])
        # Lanes that need no word read one all the same, maybe past the end.
        stream = np.concatenate([*stream, np.zeros(LANES + 1, np.uint32)]).astype(np.uint64)
        scale, word, mask = np.uint64(SCALE_BITS), np.uint64(32), np.uint64((1 << SCALE_BITS) - 1)
        for steps, run in runs.items():
            state = np.stack([r[2] for r in run]).astype(np.uint64)
            place = np.array([r[3] for r in run])[:, None]
            made = np.zeros((steps, *state.shape), np.uint16)
            for t in range(steps):
                slot = state & mask
                made[t] = symbol = self.slot_id[slot]
                state = self.freq[symbol] * (state >> scale) + slot - self.first[symbol]
                short = state < np.uint64(1 << 31)
                order = short.cumsum(axis=1)
                state = np.where(short, state << word | stream[place + order - short], state)
                place = place + order[:, -1:]
            for j, (k, m, *_) in enumerate(run):
                begin = m * MARK_STEPS * LANES
                ids[k][begin : begin + steps * LANES] = made[:, j].ravel()
        return [x[:n] for x, (*_, n) in zip(ids, coded, strict=True)]


def _by_steps(rows: Iterator[tuple], n_at: int) -> Iterator[list[tuple]]:
    """Rows of blocks that need equally many steps, ``TOGETHER`` at a time."""
    waiting: dict[int, list[tuple]] = {}
    for row in rows:
        held = waiting.setdefault(-(-row[n_at] // LANES), [])
        held.append(row)
        if len(held) == TOGETHER or sum(map(len, waiting.values())) > 4 * TOGETHER:
            yield waiting.pop(-(-row[n_at] // LANES))
    yield from waiting.values()


def write(docs: DataFrame, folder: str, path: str, end: int = END_ID) -> None:
    """Writes the ids of all texts, each followed by ``end``, as a file set in ``folder``.

    Rows, null texts and ties: see ``raw_blocks``. An empty table makes an empty file set.
    """
    spark = docs.sparkSession
    raw = settle(raw_blocks(docs, path, end), "token-blocks")
    table = frequencies(raw)
    spark.createDataFrame(table, "id int, frequency int").coalesce(1).write.parquet(f"{folder}/table")
    starts = part_starts(raw.groupBy("part").agg(F.sum("n").alias("total")))
    # One row per task that wrote blocks.
    placed = raw.join(F.broadcast(starts), "part").withColumn("start", F.col("base") + F.col("inside"))
    names = ["part", "block", "start", "n", "doc_ids", "doc_nos", "skips", "lengths", "ids"]
    shared = spark.sparkContext.broadcast(table)

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        coder = None
        for group in _by_steps(found, 3):
            coder = coder or Coder(shared.value)
            for row, (words, marks, before) in zip(group, coder.encode([r[-1] for r in group]), strict=True):
                yield *row[:-1], words, marks, before, zlib.crc32(row[-1]), zlib.crc32(marks, zlib.crc32(words))

    map_rows(placed, names, CODED, rows).write.parquet(f"{folder}/blocks")


PIECES = "doc_id long, part long, doc_no long, skip long, length long, start long, ids binary"


def read_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded pieces of documents: ids (16-bit), how many ids of the document and of all came before.

    A block whose coded bytes or ids don't match their checksum is an error.
    """
    table = sorted(map(tuple, spark.read.parquet(f"{folder}/table").collect()))
    shared = spark.sparkContext.broadcast(table)
    names = [c.split()[0] for c in CODED.split(", ")]

    def rows(found: Iterator[tuple]) -> Iterator[tuple]:
        coder = None
        for group in _by_steps(found, 3):
            coder = coder or Coder(shared.value)
            for row in group:
                if zlib.crc32(row[9], zlib.crc32(row[8])) != row[12]:
                    raise ValueError(f"coded bytes of block {row[:2]} are damaged")
            for row, ids in zip(group, coder.decode([(r[8], r[9], r[10], r[3]) for r in group]), strict=True):
                part, block, start, n, doc_ids, doc_nos, skips, lengths = row[:8]
                raw = ids.tobytes()
                if zlib.crc32(raw) != row[11]:
                    raise ValueError(f"ids of block {(part, block)} are damaged")
                at = 0
                for doc_id, doc_no, skip, length in zip(doc_ids, doc_nos, skips, lengths, strict=True):
                    yield doc_id, part, doc_no, skip, length, start + at, raw[2 * at : 2 * (at + length)]
                    at += length

    return map_rows(spark.read.parquet(f"{folder}/blocks"), names, PIECES, rows)


def join_crc(left: int, right: int, right_bytes: int) -> int:
    """CRC-32 of two byte strings in a row from theirs, the checksum being linear in its input."""
    zeros = bytes(right_bytes)
    return zlib.crc32(zeros, left) ^ zlib.crc32(zeros) ^ right


def digests(pieces: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of 32-bit ids) of each document, from its pieces."""

    def sums(found: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        for *left, ids in found:
            yield *left, zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())

    names = ["doc_id", "part", "doc_no", "skip", "length", "start", "ids"]
    schema = "doc_id long, part long, doc_no long, skip long, length long, start long, crc long"
    whole = (
        map_rows(pieces, names, schema, sums)
        .groupBy("part", "doc_no")
        # As many entries as the document has blocks.
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.sort_array(F.collect_list(F.struct("skip", "length", "start", "crc"))).alias("pieces"),
        )
    )

    def joined(found: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, pieces in found:
            crc = 0
            for p in pieces:
                crc = join_crc(crc, p["crc"], 4 * p["length"])
            yield doc_id, pieces[0]["start"], sum(p["length"] for p in pieces), crc

    return map_rows(
        whole, ["doc_id", "pieces"], "doc_id long, start long, n_tokens long, ids_crc32 long", joined
    )
