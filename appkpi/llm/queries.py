"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appkpi.llm import (
    bpe,
    collocations,
    embeddings,
    lines,
    lm,
    merkle,
    packing,
    quality,
    simhash,
    sql,
    suffixes,
    token_files,
    toxicity,
    warc,
)
from appkpi.llm.common import new_folder, read_table
from appkpi.llm.tokens import vocabulary_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the package to the tasks, once per application: executors need not share the driver's folders."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    # The driver hands the file to its executors, also to those that come later, so it stays until the end.
    folder = tempfile.mkdtemp()
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = Path(folder) / "appkpi.zip"
    with zipfile.ZipFile(package, "w") as z:
        for source in sorted((root / "appkpi").rglob("*.py")):
            z.write(source, source.relative_to(root))
    spark.sparkContext.addPyFile(str(package))
    _shipped.add(application)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLE[function.__name__] = sql
        return run

    return register


def fold(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query()
def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.piece_digests(packing.pack(docs, vocabulary_path(WORD_VOCABULARY)))


@query()
def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model, counts, pairs = lm.train(docs.where(fold(7) != 2))
    return lm.score(docs, model, counts, pairs, fold(7) == 2)


@query()
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), vocabulary_path(BYTE_VOCABULARY))


WARC_SQL = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), first AS (
  SELECT html, min(page_id) AS original FROM page WHERE n >= 100 GROUP BY html
)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM page LEFT JOIN first USING (html)
"""


@query(WARC_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(read_table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder)


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), fold(5) != 0)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        (fold(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        "flagged",
    )


@query()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write(
        read_table(spark, sf_dir, "documents"), folder, vocabulary_path(BYTE_VOCABULARY)
    )
    return token_files.digests(token_files.read_pieces(spark, folder))


@query(lines.DEDUP_SQL.format(
    docs="documents", columns="doc_id, coalesce(lines_removed, 0) AS lines_removed, c.text AS text"
))
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(sql.REPEATS)
def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.cut_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(sql.VERIFY)
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    # What is found later: half of the documents have lost their line ends.
    found = F.when(fold(2) == 0, F.replace("text", F.lit("\n"), F.lit("")))
    return merkle.verify(read_table(spark, sf_dir, "documents"), found).drop("source")


@query(sql.COLLOCATIONS.format(least=collocations.LEAST, top=collocations.TOP))
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(read_table(spark, sf_dir, "documents"))
    return collocations.top(found).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)
