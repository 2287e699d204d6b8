"""Rows with labels, split into those to learn from and those held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def known_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, y) of all rows to learn from. Rows without id or label teach nothing; of
    several labels of an id the larger counts."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .where(fold("doc_id", folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )


def class_sample(known: DataFrame, per_class: int) -> DataFrame:
    """``known`` (doc_id, y, ...) with ``weight``: at most ``per_class`` rows of each class, chosen
    by a hash of the id, whatever their number; the weight makes up for the rows left out."""
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    others = [c for c in known.columns if c not in ("doc_id", "y")]
    parts = [
        known.where(F.col("y") == y)
        .orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id", *others)
        .limit(per_class)
        .withColumn("weight", F.lit(max(1.0, sizes.get(y, 0) / per_class)))
        for y in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int, per_class: int) -> DataFrame:
    """(doc_id, y, weight) of a sample of ``known_labels``."""
    return class_sample(known_labels(labels, label, folds, held_out), per_class)
