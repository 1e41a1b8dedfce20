"""What the operators share: tables in the shared folder, task-side maps, running totals, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a key that are compared in one piece. A larger key is cut into blocks of about this
# many rows, and every pair of blocks is a task group of its own.
BLOCK_ROWS = 2000

# Texts may be long, so batches leave a task after this many bytes, however few rows they have.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 500


def shared_folder(spark: SparkSession) -> str:
    """The folder driver and executors share; the warehouse where no checkpoint folder is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or spark.conf.get("spark.sql.warehouse.dir") + "/_steps").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Shuffle files of a finished write are of no use: the table is read from then on.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table: a step that is not computed again, whoever is lost."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._settled_in = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``settle`` returned. What was made of them must be written by now."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._settled_in)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands rows to Python tasks some hundred at a time.

    Texts may be long: Spark's own batches of 10,000 rows would hold tens of MB, or thousands.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def map_rows(
    df: DataFrame,
    columns: list[str],
    schema: str,
    rows: Callable[[Iterator[tuple]], Iterable[tuple]],
) -> DataFrame:
    """``rows`` turns a task's input tuples into output tuples, a bounded batch at a time."""
    target = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pack(rows(unpack(batches)), target)

    return in_small_batches(df).select(*columns).mapInArrow(run, schema)


def unpack(batches: Iterable[pa.RecordBatch], step: int = 64) -> Iterator[tuple]:
    """Rows as tuples; ``step`` of them are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def pack(
    rows: Iterable[tuple], schema: pa.Schema, most: int = 10_000
) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if len(held) >= most or size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def by_group(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with the same first ``width`` values. Groups here are bounded blocks."""
    key: tuple | None = None
    held: list[tuple] = []
    for row in rows:
        if row[:width] != key:
            if held:
                yield key, held
            key, held = row[:width], []
        held.append(row[width:])
    if held:
        yield key, held


def numbered(df: DataFrame, order: list[Column], size: Column) -> DataFrame:
    """Rows in ``order`` with ``part``, ``place`` in it and ``before``, the sizes of all earlier rows.

    Range partitions are summed inside their tasks; across them only one total per partition is
    added up. Equal sort keys may lie on either side of a border, so no key is too large.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = df.columns
    ranged = (
        df.withColumn("_size", size.cast("long"))
        .repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema]
    schema = ", ".join([*fields, "part long", "place long", "inside long"])
    target = _arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        part, place, inside = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column("_size").to_numpy(zero_copy_only=False)
            ends = inside + np.cumsum(sizes)
            n = batch.num_rows
            extra = [
                pa.array(np.full(n, part, np.int64)),
                pa.array(np.arange(place, place + n, dtype=np.int64)),
                pa.array(ends - sizes),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], schema=target)
            if n:
                place, inside = place + n, int(ends[-1])

    placed = settle(in_small_batches(ranged).mapInArrow(run, schema), "placed")
    return placed.join(
        F.broadcast(part_starts(placed.groupBy("part").agg(F.sum("_size").alias("total")))), "part"
    ).select(*names, "part", "place", (F.col("inside") + F.col("base")).alias("before"))


def part_starts(totals: DataFrame) -> DataFrame:
    """``base``, the totals of all earlier parts. There is one row per task of a stage."""
    from pyspark.sql import Window

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).cast("long").alias("base")
    )


def in_blocks(
    df: DataFrame, keys: list[str], spread: Column, limit: int = BLOCK_ROWS, weight: Column | None = None
) -> DataFrame:
    """Rows of keys that occur twice or more, with the cells in which they meet.

    A key of up to ``limit`` rows has the one cell (0, 0). A larger one is dealt over b blocks by
    ``spread``; its rows go to the b cells of their block, so that any two rows meet in the cell
    of their two blocks, and nowhere else. ``block`` is the row's own. ``weight`` is what a row counts
    towards ``limit``, one if not given.
    """
    total = F.count("*") if weight is None else F.sum(weight)
    counts = settle(
        df.groupBy(*keys)
        .agg(F.count("*").alias("_rows"), total.alias("_n"))
        .where("_rows > 1")
        .drop("_rows"),
        "key-counts",
    )
    blocks = F.ceil(F.col("_n") / limit).cast("int")
    return (
        df.join(counts, keys)
        .withColumn("_b", blocks)
        .withColumn("block", F.pmod(spread, F.col("_b")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
        .withColumn("cell_a", F.least("block", "_other"))
        .withColumn("cell_b", F.greatest("block", "_other"))
        .drop("_n", "_b", "_other")
    )


class Forest:
    """Union by smallest number over small integers, as one flat label array."""

    def __init__(self, n: int) -> None:
        import numpy as np

        self.label = np.arange(n)
        self.joined: list[tuple[int, int]] = []

    def add(self, a, b) -> None:
        """Links a[i] with b[i]; of those that join two trees, one each is kept in ``joined``."""
        import numpy as np

        label = self.label
        ends = np.unique(np.stack([label[a], label[b]]), axis=1)
        ends = ends[:, ends[0] != ends[1]]
        if not ends.size:
            return
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        for x, y in ends.T.tolist():
            x, y = find(x), find(y)
            if x != y:
                low, high = min(x, y), max(x, y)
                root[high] = low
                self.joined.append((low, high))
        moved = np.arange(len(label))
        for x in root:
            moved[x] = find(x)
        self.label = moved[label]


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, from links ``a`` - ``b``.

    Links are first thinned inside each task, then turned into stars by turns: every node hangs
    its larger neighbours on its smallest one, then its smaller ones. Both need only a minimum per
    node and a join with it; no neighbourhood is gathered anywhere. Isolated nodes are not listed.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    plain = edges.where("a is not null and b is not null and a <> b").select(
        high.alias("u"), low.alias("v")
    )
    stars = settle(map_rows(plain, ["u", "v"], "u long, v long", _thin).distinct(), "links")
    state = _state(stars)
    while state[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(
            both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least"
        )
        large = settle(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            "large-star",
        )
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        stars = settle(
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "small-star",
        )
        now = _state(stars)
        if now == state:
            break
        state = now
    roots = stars.select(F.col("v").alias("node")).distinct()
    return settle(
        stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
            roots.select("node", F.col("node").alias("root"))
        ),
        "components",
    )


def _state(stars: DataFrame) -> tuple:
    row = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def _thin(rows: Iterator[tuple], most: int = 200_000) -> Iterator[tuple]:
    """A spanning forest of each run of links, as links to its smallest node."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = root[x]
        return x

    def stars() -> Iterator[tuple]:
        for x in list(root):
            if (top := find(x)) != x:
                yield x, top

    for u, v in rows:
        u, v = find(u), find(v)
        if u != v:
            root[max(u, v)] = min(u, v)
        if len(root) >= most:
            yield from stars()
            root = {}
    yield from stars()
