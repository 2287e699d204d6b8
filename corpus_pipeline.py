"""The corpus pipeline: documents come in, packed training sequences go out.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet, and the
next stage reads that. Every stage but the last returns the columns of documents; whatever a
stage removes or changes stays so for all that follow. Stages read the other tables they need
(labels, benchmark) from ``sf_dir``.

Null and empty texts, repeated rows and empty tables go through as the operators define it;
other columns of ``docs`` than those of documents are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.bloom import split_by
from footfall.llm.common import TEXT_BYTES, staged, table
from footfall.llm.decontamination import contamination
from footfall.llm.jaccard_join import link_documents
from footfall.llm.line_dedup import dedup_lines
from footfall.llm.queries import packed_pieces
from footfall.llm.toxicity import score_toxicity

#: The columns of documents.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: What the stage takes for near copies, whatever op5 asks for: words of a shingle, and the
#: similarity as a fraction.
NEAR_SHINGLE, NEAR_SIMILARITY = 5, (80, 100)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``key`` for every row: its doc_id where that is its own, else a number beyond
    all ids. So a stage's decision about one row says nothing about another that has the same id,
    or none, and of equal rows one can stay. Ids are below 2^62."""
    docs = docs.select(*COLUMNS)
    counted = docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
    odd = staged(counted.select(F.col("doc_id").alias("odd_id")), "odd_ids")
    if odd.isEmpty():
        return docs.withColumn("key", F.col("doc_id").cast("long"))
    beyond = 1 + max(docs.agg(F.max("doc_id")).first()[0] or 0, 0)
    maybe, others = split_by(docs, F.col("doc_id"), odd, "odd_id")
    same = F.col("doc_id").eqNullSafe(F.col("odd_id"))
    own = others.unionByName(maybe.join(odd, same, "left_anti")).withColumn("key", F.col("doc_id").cast("long"))
    # Written, so that every reader sees the same numbers.
    numbered = maybe.join(odd, same, "left_semi").withColumn("key", F.lit(beyond) + F.monotonically_increasing_id())
    return own.unionByName(staged(numbered, "numbered"))


def _as_documents(rows: DataFrame) -> DataFrame:
    """What the operators take, by key."""
    return rows.select(F.col("key").alias("doc_id"), "text")


def _without(rows: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """Documents of ``rows`` whose key is not among ``rejected`` (doc_id). A filter keeps most
    rows, whose texts are long, out of the join."""
    rejected = staged(rejected.select(F.col("doc_id").alias("rejected_key")).distinct(), name, batch_bytes=TEXT_BYTES)
    maybe, others = split_by(rows, F.col("key"), rejected, "rejected_key")
    checked = maybe.join(rejected, F.col("key") == F.col("rejected_key"), "left_anti")
    return others.unionByName(checked).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar predicts to be toxic go. Labels are by doc_id, so rows
    without one of their own teach nothing."""
    rows = keyed(docs)
    scored = score_toxicity(_as_documents(rows), table(spark, sf_dir, "labels"))
    return _without(rows, scored.where("predicted = 1"), "toxic")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go, but in one of them; n_chars follows the text."""
    kept = dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles of five words and a similarity of 0.8 the one with the
    smallest doc_id stays; rows without an id of their own come after all others."""
    rows = keyed(docs)
    linked = link_documents(_as_documents(rows), size=NEAR_SHINGLE, similarity=NEAR_SIMILARITY)
    return _without(rows, linked.where("component_id <> doc_id"), "copies")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    rows = keyed(docs)
    found = contamination(_as_documents(rows), table(spark, sf_dir, "benchmark"))
    return _without(rows, found.where("contaminated"), "contaminated")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, with their sequences and places."""
    return packed_pieces(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL cannot express the trained grammar or the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
