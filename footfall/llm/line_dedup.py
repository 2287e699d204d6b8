"""Removal of lines that many documents share.

A text is split at newlines; a line's key is the line without blanks at its ends, A-Z
lower-cased. Keys of ``min_chars`` code points or more that at least ``min_documents``
documents hold lose all their lines but those of the largest doc_id.

Rows with the same doc_id are one document here; a null doc_id is one too, and smaller than
any other. A null text is an empty one, thus one empty line. Repeated rows stay repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.bloom import split_by
from footfall.llm.common import BLANKS, ascii_lower, packed, staged, unpacked

MIN_CHARS = 40
MIN_DOCUMENTS = 5


def _hash(key):
    """128 bits of SHA-256: short rows for the shuffles, no collisions to be expected."""
    return F.unhex(F.substring(F.sha2(key, 256), 1, 32))


def _lines(text: str):
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, pos, hash) of every line that is long enough."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(_lines("text")).alias("pos", "line"))
    # A line with fewer bytes than code points asked for is out before any key is made.
    keyed = lines.where(F.octet_length("line") >= min_chars).select(
        "doc_id", "text_hash", "pos", F.btrim(F.col("line"), F.lit(BLANKS)).alias("trimmed")
    )
    return keyed.where(F.char_length("trimmed") >= min_chars).select(
        "doc_id", "text_hash", "pos", _hash(ascii_lower(F.col("trimmed"))).alias("hash")
    )


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(hash, documents, last_doc_id) of every key that enough documents hold."""
    held = _long_lines(docs, min_chars).select("hash", "doc_id").distinct()
    counted = held.groupBy("hash").agg(F.count("*").alias("documents"), F.max("doc_id").alias("last_doc_id"))
    return counted.where(F.col("documents") >= min_documents)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` with the text that stays, and n_lines (before) and n_dropped.

    Only hashes travel to find the lines; each document gets back the positions it loses, and
    the lines left are put together in their order. Input columns named n_lines or n_dropped
    are replaced."""
    shared = staged(shared_lines(docs, min_chars, min_documents), "shared_lines")
    later_holder = F.col("last_doc_id").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last_doc_id")))
    lost = (
        _long_lines(docs, min_chars)
        .join(shared.select("hash", "last_doc_id"), "hash")
        .where(later_holder)
        .groupBy(F.col("doc_id").alias("lost_id"), F.col("text_hash").alias("lost_text"))
        .agg(F.collect_set("pos").alias("lost"))
    )
    lost = staged(lost, "lost_lines")
    columns = docs.columns
    rows = docs.select(packed(docs), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"))
    # Only texts that lose lines have to meet their positions; the others stay where they are.
    maybe, whole_rows = split_by(rows, F.col("text_hash"), lost, "lost_text")
    same_row = F.col("row.doc_id").eqNullSafe(F.col("lost_id")) & (F.col("text_hash") == F.col("lost_text"))
    joined = maybe.join(lost, same_row, "left").select("row", "lost")
    joined = joined.unionByName(whole_rows.select("row", F.lit(None).cast("array<int>").alias("lost")))
    numbered = joined.select("row", "lost", _lines("row.text").alias("lines"))
    whole = F.coalesce(F.col("row.text"), F.lit(""))
    return unpacked(
        numbered,
        columns,
        text=F.when(F.col("lost").isNull(), whole).otherwise(
            F.array_join(
                F.transform(
                    F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost")),
                    lambda i: F.get(F.col("lines"), i),
                ),
                "\n",
            )
        ),
        n_lines=F.size("lines").cast("long"),
        n_dropped=F.when(F.col("lost").isNull(), F.lit(0)).otherwise(F.size("lost")).cast("long"),
    )
