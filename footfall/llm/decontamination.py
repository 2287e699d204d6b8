"""Benchmark passages in documents, found with Wu-Manber multi-pattern search over words.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A pattern is a
window of 13 consecutive words of a benchmark item; an item with fewer words is one pattern.
All patterns of one search have the same length m. A block is two neighbouring words. The
shift table says how far the end of a window can be from a block, so a block that no pattern
holds lets the search skip m - 1 words; a shift of 0 selects the bucket of the patterns that
end in the block, and comparing all words confirms an occurrence.

Null texts have no words; items without words have no pattern; an item without an id marks
words but is not counted. Repeated items count once, repeated documents give repeated rows.
An empty benchmark hits nothing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import lean, staged

WINDOW = 13
#: Patterns searched for in one pass over the documents. A block of this many is about 100 MB
#: in a worker; larger benchmarks are searched for in several passes.
PATTERNS_PER_PASS = 100_000

_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

#: Bytes of words; everything else parts them.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def windows(item: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not item:
        return []
    return [tuple(item[i : i + size]) for i in range(max(len(item) - size, 0) + 1)]


class Search:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, patterns: Iterable[tuple[bytes, ...]]):
        patterns = set(patterns)
        self.length = len(next(iter(patterns)))
        self.block = min(2, self.length)
        self.skip = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], set[tuple[bytes, ...]]] = {}
        for p in patterns:
            for end in range(self.block, self.length + 1):
                block = p[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.skip), self.length - end)
            self.buckets.setdefault(p[-self.block :], set()).add(p)

    def ends(self, text: list[bytes]) -> Iterable[tuple[int, tuple[bytes, ...]]]:
        """(end, pattern) of every occurrence."""
        m, b, skip, shift, buckets, n = self.length, self.block, self.skip, self.shift, self.buckets, len(text)
        end = m
        while end <= n:
            block = tuple(text[end - b : end])
            step = shift.get(block, skip)
            if step:
                end += step
                continue
            found = tuple(text[end - m : end])
            if found in buckets[block]:
                yield end, found
            end += 1


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search(texts: DataFrame, patterns: dict[tuple[bytes, ...], set[str]]) -> DataFrame:
    """doc_id, text_hash, n_words, spans and item_ids of one pass. The patterns travel as one
    broadcast, whose size PATTERNS_PER_PASS bounds."""
    shared = texts.sparkSession.sparkContext.broadcast(patterns)

    @lean
    def run(batches):
        items = shared.value
        by_length: dict[int, list] = {}
        for p in items:
            by_length.setdefault(len(p), []).append(p)
        searches = [Search(ps) for ps in by_length.values()]
        for batch in batches:
            n_words, spans, ids = [], [], []
            for text in batch["text"]:
                ws = words(text.as_buffer().to_pybytes()) if text.is_valid else []
                hit, found = [], set()
                for search in searches:
                    for end, p in search.ends(ws):
                        hit.append((end - search.length, end))
                        found.add(p)
                n_words.append(len(ws))
                spans.append([{"first": a, "last": b} for a, b in _merged(hit)])
                ids.append(sorted(set().union(*(items[p] for p in found))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_hash"],
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, _SPANS),
                    pa.array(ids, pa.list_(pa.string())),
                ],
                ["doc_id", "text_hash", "n_words", "spans", "item_ids"],
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run,
        f"doc_id {id_type}, text_hash long, n_words long,"
        " spans array<struct<first: long, last: long>>, item_ids array<string>",
    )


def benchmark_patterns(benchmark: DataFrame, size: int) -> DataFrame:
    """(pattern, item_ids): the different windows of the benchmark, their words parted by a blank,
    with the ids of all items that have them."""

    @lean
    def run(batches):
        for batch in batches:
            patterns, ids = [], []
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
                found = {b" ".join(p) for p in windows(words(text), size)}
                patterns.extend(found)
                ids.extend([item] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.binary()), pa.array(ids, pa.string())], ["pattern", "item_id"])

    texts = benchmark.where("text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")
    )
    made = texts.mapInArrow(run, "pattern binary, item_id string")
    return made.groupBy("pattern").agg(F.collect_set("item_id").alias("item_ids"))


def _passes(benchmark: DataFrame, size: int, per_pass: int) -> Iterator[dict[tuple[bytes, ...], set[str]]]:
    """Patterns with the ids of their items, about ``per_pass`` at a time, whatever items they are of.
    Only these pass through the driver."""
    table = staged(benchmark_patterns(benchmark, size), "patterns")
    parts = max(1, -(-table.count() // per_pass))
    for part in range(parts):
        rows = table.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == part).collect()
        if rows:
            yield {tuple(bytes(r["pattern"]).split(b" ")): set(r["item_ids"]) for r in rows}


def find_passages(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, per_pass: int = PATTERNS_PER_PASS
) -> DataFrame:
    """Per row of ``docs`` (of which doc_id and text are read): doc_id, n_words, spans of hit
    words (first, and the one after the last; in order) and item_ids (as strings, sorted).

    One pass needs no shuffle. With several, only rows with hits of the later passes travel;
    they join the first by doc_id and text, and their spans may overlap."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    first, *more = [_search(texts, patterns) for patterns in _passes(benchmark, size, per_pass)] or [_search(texts, {})]
    if not more:
        return first.drop("text_hash")
    later = reduce(DataFrame.unionByName, more).where(F.size("spans") > 0)
    keys = F.col("doc_id").alias("later_id"), F.col("text_hash").alias("later_hash")
    later = later.groupBy(*keys).agg(
        F.flatten(F.collect_set("spans")).alias("later_spans"), F.flatten(F.collect_set("item_ids")).alias("later_ids")
    )
    same = F.col("doc_id").eqNullSafe(F.col("later_id")) & F.col("text_hash").eqNullSafe(F.col("later_hash"))

    def both(a: str, b: str):
        return F.array_sort(F.array_distinct(F.concat(F.col(a), F.coalesce(F.col(b), F.slice(a, 1, 0))))).alias(a)

    return first.join(later, same, "left").select(
        "doc_id", "n_words", both("spans", "later_spans"), both("item_ids", "later_ids")
    )


def hit_words(spans: str = "spans") -> Column:
    """Words inside any span of an ordered list."""
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        spans,
        start,
        lambda acc, s: F.struct(
            (acc.hit + F.greatest(F.lit(0), s.last - F.greatest(s.first, acc.upto))).alias("hit"),
            F.greatest(acc.upto, s.last).alias("upto"),
        ),
        lambda acc: acc.hit,
    )


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """find_passages with n_hit, n_items and contaminated: some word is hit, and at least one
    word of twenty."""
    found = find_passages(docs, benchmark, **options).withColumn("n_hit", hit_words())
    return found.withColumns(
        {
            "n_items": F.size("item_ids").cast("long"),
            "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
        }
    )
