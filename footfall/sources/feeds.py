"""Readings from feeds whose layouts differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, matched by column name. A column that a feed lacks
    is null there; duplicates are kept."""
    if not feeds:
        raise ValueError("no feeds given")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
