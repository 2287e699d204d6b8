"""A blocked Bloom filter as one array of longs, built and asked with Spark's own functions.

A key's bits all lie in one 64-bit word. The filter is a scalar subquery of bounded size, so
rows that cannot have a partner are told apart without a shuffle. What passes has to be joined
exactly; beyond the largest filter more rows pass, and the result stays the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 16 bits a key keep false positives below one in a hundred; the largest filter has 8 MB.
BITS_PER_ITEM = 16
MIN_BLOCKS, MAX_BLOCKS = 16, 1 << 20
BITS_PER_KEY = 4


def blocks_for(keys: int) -> int:
    return min(MAX_BLOCKS, max(MIN_BLOCKS, -(-keys * BITS_PER_ITEM // 64)))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks).cast("int")


def _mask(key: Column) -> Column:
    """A few bits of one block, from hash bits that do not choose the block."""
    h = F.xxhash64(F.lit(1), key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(h, 6 * i), F.lit(64)).cast("int")) for i in range(BITS_PER_KEY)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def bloom_filter(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """One row with the filter's words, an array of ``blocks`` longs."""
    words = (
        keys.select(_block(F.col(column), F.lit(blocks)).alias("block"), _mask(F.col(column)).alias("mask"))
        .groupBy("block")
        .agg(F.bit_or("mask").alias("word"))
    )
    all_blocks = keys.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"))
    filled = all_blocks.join(words, "block", "left").select("block", F.coalesce("word", F.lit(0).cast("bigint")).alias("word"))
    return filled.agg(F.array_sort(F.collect_list(F.struct("block", "word"))).alias("s")).select(F.col("s.word").alias("words"))


def may_contain(words: Column, blocks: int, key: Column) -> Column:
    mask = _mask(key)
    return F.get(words, _block(key, F.lit(blocks))).bitwiseAND(mask) == mask


def split_by(rows: DataFrame, key: Column, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose key may be among ``keys``, and those whose key is not. ``keys`` is read
    twice, so it should be a written table."""
    blocks = blocks_for(keys.count())
    may = may_contain(bloom_filter(keys, column, blocks).scalar(), blocks, key)
    return rows.where(may), rows.where(~may)
