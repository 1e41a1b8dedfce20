"""Line dedup by overlapping three-line windows, with DataFrame functions only.

A document's lines that hold more than spaces are read as overlapping windows of three. A window
found more than once in the corpus, across documents or inside one, keeps its first occurrence,
by doc_id and place; the lines that later occurrences cover are merged and removed. A later occurrence
in the same document may overlap the first one: the lines they share stay. A line goes only where an
equal one stands earlier, so one of each stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appkpi.llm.common import settle

WINDOW_LINES = 3


def line_hashes(text: Column) -> Column:
    """Number and two 64-bit hashes of each line that holds more than spaces."""
    lines = F.transform(
        F.split(text, "\n", -1),
        lambda line, i: F.when(
            F.trim(line) != "",
            F.struct(
                i.alias("i"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")
            ),
        ),
    )
    return F.filter(lines, lambda x: x.isNotNull())


def windows(hashed: str, size: int = WINDOW_LINES) -> Column:
    """The windows over a column of ``line_hashes``: first and last line, and 128 bits of hash."""
    # The column beside itself, shifted: entry k of the zip is the window from line k on.
    shifted = [F.slice(hashed, j + 1, F.greatest(F.size(hashed), F.lit(1))) for j in range(size)]

    def window(x: Column) -> Column:
        run = [x[str(j)] for j in range(size)]
        return F.struct(
            run[0]["i"].alias("first"),
            run[-1]["i"].alias("last"),
            F.xxhash64(*[r["a"] for r in run]).alias("a"),
            F.xxhash64(*[r["b"] for r in run]).alias("b"),
        )

    zipped = F.arrays_zip(*[c.alias(str(j)) for j, c in enumerate(shifted)])
    return F.filter(F.transform(zipped, window), lambda w: w["last"].isNotNull())


def dedup_lines(docs: DataFrame, size: int = WINDOW_LINES) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``, and ``lines_removed``.

    One row per row. A document of fewer than three such lines, an empty and a null text stay as
    they are. Rows equal in doc_id and text lose and keep the same lines; a null doc_id comes first
    in order. A document may lose all its lines; its text is then empty. Columns of ``docs`` other
    than ``text`` pass through; one named ``lines_removed`` is replaced.
    """
    own = docs.select(
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("h"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    found = settle(
        # A column of its own, so that the hashes of a text are made once.
        own.select("id", "h", line_hashes(F.col("row.text")).alias("hashed"))
        .select("id", "h", F.explode(windows("hashed", size)).alias("w"))
        .select("id", "h", "w.first", "w.last", "w.a", "w.b"),
        "line-windows",
    )
    place = F.struct("id", "h", "first", "last")
    repeated = settle(
        found.groupBy("a", "b")
        .agg(F.min(place).alias("earliest"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "repeated-windows",
    )
    is_first = place.eqNullSafe(F.col("earliest"))
    # A window may overlap its own first occurrence, which begins earlier.
    same = F.struct("id", "h").eqNullSafe(F.struct("earliest.id", "earliest.h"))
    since = F.when(same, F.greatest("first", F.col("earliest.last") + 1)).otherwise(F.col("first"))
    cover = settle(
        found.join(repeated, ["a", "b"])
        .where(~is_first)
        .groupBy("id", "h")
        .agg(F.array_distinct(F.flatten(F.collect_list(F.sequence(since, "last")))).alias("gone"))
        .select(F.col("id").alias("cid"), F.col("h").alias("ch"), "gone"),
        "covered-lines",
    )
    # Columns of their own as well: a lambda makes what it refers to anew for every element.
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(F.col("kept"), lambda i: F.get(F.col("parts"), i)), "\n")
    )
    return (
        # The same plan at every size, whatever the share of documents with something to remove.
        own.join(cover.hint("merge"), own.id.eqNullSafe(cover.cid) & (own.h == cover.ch), "left")
        .withColumn("parts", F.when(F.col("gone").isNotNull(), F.split("row.text", "\n", -1)))
        .withColumn("kept", F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone")))
        .select(
            *[
                (text if c == "text" else F.col(f"row.`{c}`")).alias(c)
                for c in docs.columns
                if c != "lines_removed"
            ],
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("lines_removed"),
        )
    )


# The same for the ``documents`` view, by the lines themselves instead of their hashes.
DEDUP_SQL = """
WITH line AS (
  SELECT doc_id, pos - 1 AS pos, string_split(text, chr(10))[pos] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM {docs})
), run AS (
  SELECT doc_id, pos AS a, lead(pos, 2) OVER w AS z, line AS l1, lead(line) OVER w AS l2,
    lead(line, 2) OVER w AS l3
  FROM line WHERE trim(line, ' ') <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), placed AS (
  SELECT doc_id, a, z, row_number() OVER same AS k, first_value(doc_id) OVER same AS d, first_value(z) OVER same AS e
  FROM run WHERE z IS NOT NULL WINDOW same AS (PARTITION BY l1, l2, l3 ORDER BY doc_id, a)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = d THEN greatest(a, e + 1) ELSE a END, z + 1)) AS pos
  FROM placed WHERE k > 1
), cut AS (
  SELECT doc_id, count(g.pos) AS lines_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (g.pos IS NULL), '') AS text
  FROM line LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id
)
SELECT {columns} FROM {docs} d LEFT JOIN cut c USING (doc_id)
"""
