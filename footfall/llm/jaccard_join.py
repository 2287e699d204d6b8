"""Documents linked by the Jaccard similarity of their word shingles, and their components.

Exact for any data; no pair of documents is ever a row. The steps:

1. Every text becomes its set of shingle hashes. Texts with the same words are one from here.
2. A text can only link if it shares most of its shingles: of its smallest hashes, a prefix
   long enough that a partner must share half of it. In buckets of hashes it is found which
   shingles two texts hold; texts with too few of them are done.
3. Of the texts left the whole sets are counted in the same way. Texts with too few shared
   shingles go, the others keep a prefix of their rarest ones, in which linked texts must meet.
   The components of this relation are found without listing its pairs.
4. Each such component is a block of the document by n-gram incidence matrix, a large one is
   several, taken two at a time. A task multiplies a block with its transpose row by row:
   overlaps are accumulated from the columns of a row's n-grams, pairs below the bound that
   their sizes give are discarded, and rows already connected leave the matrix. Only the
   edges of a spanning forest come out.

Texts without words have an empty set and link with nothing. Rows are grouped by words, so
repeated rows, ids or null ids are no special case: a row without an id is linked like any
other, and its component's id is the smallest that is not null."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.bloom import split_by
from footfall.llm.common import TEXT_BYTES, give_back, lean, staged
from footfall.llm.components import components
from footfall.llm.shingles import shingle_set, word_hashes

SHINGLE = 4
#: Similarity as a fraction, so that the comparison is exact: 85 of 100.
SIMILARITY = (85, 100)

#: Shingles of a task's share: of one bucket of hashes, one block of the matrix, and one
#: bucket of small components.
BUCKET = 1 << 20
BLOCK = 1 << 20
SMALL = 1 << 17


def least_overlap(size, num: int, den: int):
    """Shingles that a text of ``size`` shares with any partner, at least."""
    return -(-num * size // den)


def _prefix_matches(size, num: int, den: int):
    """Shared shingles asked of the long prefix of a text of ``size``: more than may differ."""
    return 1 + size - least_overlap(size, num, den)


def _long_prefix(size, num: int, den: int):
    return size - least_overlap(size, num, den) + _prefix_matches(size, num, den)


def _tag(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _hashed(docs: DataFrame) -> DataFrame:
    """With doc_id it names a row's text, to read one of its copies again."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))


def _shingled(docs: DataFrame, size: int, num: int, den: int, whole: bool) -> DataFrame:
    """doc_id, text_hash, key (of the words), tag (its first 8 bytes), n_shingles and hashes:
    the long prefix, or the whole set."""

    @lean
    def run(batches):
        for batch in batches:
            keys, counts, hashes = [], [], []
            for words in word_hashes(batch["text"]):
                s = shingle_set(words, size)
                keys.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
                counts.append(len(s))
                hashes.append((s if whole else s[: _long_prefix(len(s), num, den)]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(keys, pa.binary()), pa.array([_tag(k) for k in keys], pa.int64()), pa.array(counts, pa.int64()), pa.array(hashes, pa.binary())],
                ["doc_id", "text_hash", "key", "tag", "n_shingles", "hashes"],
            )

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text_hash", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc_id {doc_type}, text_hash long, key binary, tag long, n_shingles long, hashes binary")


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    if not len(sorted_values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return starts, np.diff(np.r_[starts, len(sorted_values)])


def _by_hash(hashes: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, tag), sorted, with the runs of equal hashes."""
    order = np.lexsort((tags, hashes))
    hashes, tags = hashes[order], tags[order]
    if len(hashes):
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (tags[1:] != tags[:-1])]
        hashes, tags = hashes[new], tags[new]
    return hashes, tags, *_runs(hashes)


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by the hash's middle bits; a set's smallest hashes all have the same first ones."""
    return ((hashes >> np.uint64(16)) & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)


def _blobs(bucket: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """The bucket numbers there are, and each column's values of a bucket as one binary."""
    order = np.argsort(bucket, kind="stable")
    starts, runs = _runs(bucket[order])
    parts = [order[a : a + n] for a, n in zip(starts, runs)]
    return [
        pa.array(bucket[order[starts]].astype(np.int32)),
        *[pa.array([column[part].tobytes() for part in parts], pa.binary()) for column in columns],
    ]


def _joined(column, kind) -> np.ndarray:
    """The values of all blobs of a column."""
    return np.frombuffer(b"".join(x.as_buffer().to_pybytes() for x in column), kind)


def _matches(rows: DataFrame, buckets: int) -> DataFrame:
    """(tag, matches): how many of a text's hashes other texts have, too. An upper bound where
    copies of a text are in several batches.

    A batch sends at most two texts of a shingle that several of its texts hold, as witnesses:
    a shingle of a third of all texts is two entries a batch."""

    @lean
    def spread(batches):
        for batch in batches:
            lengths = np.array([len(x.as_buffer()) // 8 for x in batch["hashes"]], np.int64)
            tags = np.repeat(batch["tag"].to_numpy(), lengths)
            hashes, tags, starts, runs = _by_hash(_joined(batch["hashes"], np.uint64), tags)
            place = np.arange(len(hashes)) - np.repeat(starts, runs)
            held_by = np.repeat(runs, runs)
            own, times = np.unique(tags[held_by > 1], return_counts=True)
            sent = place < 2
            told = (held_by > 1).astype(np.uint8)
            bucket, hashes, tags, told = _blobs(_bucket_of(hashes[sent], buckets).astype(np.int64), hashes[sent], tags[sent], told[sent])
            # What the batch has counted itself goes along with its first bucket.
            first, none = len(bucket) > 0, [b""] * max(0, len(bucket) - 1)
            own, times = (pa.array([x.astype(np.int64).tobytes()] * first + none, pa.binary()) for x in (own, times))
            yield pa.RecordBatch.from_arrays([bucket, hashes, tags, told, own, times], ["bucket", "hashes", "tags", "told", "own", "times"])

    def parted(ids: np.ndarray, n: np.ndarray) -> pa.Table:
        part, id_blobs, n_blobs = _blobs(_bucket_of(ids.view(np.uint64), buckets).astype(np.int64), ids, n)
        return pa.table({"part": part, "tags": id_blobs, "n": n_blobs})

    def added(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, places = np.unique(ids, return_inverse=True)
        return ids, np.bincount(places, n, len(ids)).astype(np.int64)

    def count(group: pa.Table) -> pa.Table:
        give_back()
        hashes, tags, told = (_joined(group[c], k) for c, k in (("hashes", np.uint64), ("tags", np.int64), ("told", np.uint8)))
        order = np.lexsort((-told.astype(np.int8), tags, hashes))
        hashes, tags, told = hashes[order], tags[order], told[order]
        starts, runs = _runs(hashes)
        new_text = np.r_[True, (hashes[1:] != hashes[:-1]) | (tags[1:] != tags[:-1])][: len(hashes)]
        texts = np.add.reduceat(new_text.astype(np.int64), starts) if len(starts) else starts
        alone = tags[(np.repeat(texts, runs) > 1) & new_text & (told == 0)]
        own, times = _joined(group["own"], np.int64), _joined(group["times"], np.int64)
        return parted(*added(np.r_[alone, own], np.r_[np.ones(len(alone), np.int64), times]))

    def total(group: pa.Table) -> pa.Table:
        ids, n = added(_joined(group["tags"], np.int64), _joined(group["n"], np.int64))
        return pa.table({"tag": pa.array(ids), "matches": pa.array(n)})

    blobs = rows.select("tag", "hashes").mapInArrow(
        spread, "bucket int, hashes binary, tags binary, told binary, own binary, times binary"
    )
    parts = blobs.groupBy("bucket").applyInArrow(count, "part int, tags binary, n binary")
    return parts.groupBy("part").applyInArrow(total, "tag long, matches long")


def _rarest(whole: DataFrame, blocks: int, num: int, den: int) -> DataFrame:
    """The texts of ``whole`` that share enough shingles with others of it, with ``prefix``:
    their rarest shingles, one more than may differ.

    Blocks of texts send their distinct hashes to buckets, get back how many texts have each,
    and order by that."""
    numbered = whole.withColumn("block", F.pmod("tag", F.lit(blocks)).cast("int"))

    def distinct(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, texts = np.unique(_joined(group["hashes"], np.uint64), return_counts=True)
        return hashes, texts, _bucket_of(hashes, blocks).astype(np.int64)

    def send(group: pa.Table) -> pa.Table:
        hashes, texts, bucket = distinct(group)
        numbers, hash_blobs, text_blobs = _blobs(bucket, hashes, texts)
        block = pa.array([group["block"][0].as_py()] * len(numbers), pa.int32())
        return pa.table({"block": block, "bucket": numbers, "hashes": hash_blobs, "n": text_blobs})

    def count(group: pa.Table) -> pa.Table:
        give_back()
        hashes, n = _joined(group["hashes"], np.uint64), _joined(group["n"], np.int64)
        _, places = np.unique(hashes, return_inverse=True)
        n = np.bincount(places, n)[places].astype(np.int64) if len(places) else n
        sizes = [len(x.as_buffer()) // 8 for x in group["hashes"]]
        parts = [x.tobytes() for x in np.split(n, np.cumsum(sizes)[:-1])]
        return pa.table({"block": group["block"], "bucket": group["bucket"], "n": pa.array(parts, pa.binary())})

    def order(texts: pa.Table, counts: pa.Table) -> pa.Table:
        give_back()
        hashes, _, bucket = distinct(texts)
        held = np.empty(len(hashes), np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        held[by_bucket] = _joined(counts.sort_by("bucket")["n"], np.int64)
        kept, prefixes = [], []
        for row, blob in enumerate(texts["hashes"]):
            own = np.frombuffer(blob.as_buffer(), np.uint64)
            n = held[np.searchsorted(hashes, own)]
            least = least_overlap(len(own), num, den)
            if (n > 1).sum() >= least:
                kept.append(row)
                prefixes.append(own[np.argsort(n, kind="stable")][: len(own) - least + 1].tobytes())
        return texts.drop_columns(["block"]).take(pa.array(kept, pa.int64())).append_column("prefix", pa.array(prefixes, pa.binary()))

    counts = numbered.groupBy("block").applyInArrow(send, "block int, bucket int, hashes binary, n binary")
    counts = counts.groupBy("bucket").applyInArrow(count, "block int, bucket int, n binary")
    pairs = numbered.groupBy("block").cogroup(counts.groupBy("block"))
    return pairs.applyInArrow(order, "key binary, tag long, n_shingles long, hashes binary, prefix binary")


class _Forest:
    """Joins numbers 0..n-1 into trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def _candidate_edges(texts: DataFrame, buckets: int) -> DataFrame:
    """(a, b) of tags: a forest whose trees hold all texts that share a shingle of ``prefix``."""

    @lean
    def spread(batches):
        for batch in batches:
            lengths = np.array([len(x.as_buffer()) // 8 for x in batch["prefix"]], np.int64)
            tags = np.repeat(batch["tag"].to_numpy(), lengths)
            hashes, tags, starts, runs = _by_hash(_joined(batch["prefix"], np.uint64), tags)
            # One text of each shingle stands for the batch's others, whose edges to it go along.
            held = np.repeat(tags[starts], runs)
            other = np.flatnonzero(tags != held)
            bucket = _bucket_of(hashes[starts], buckets).astype(np.int64)
            tied = np.unique(np.stack([held[other], tags[other]], 1), axis=0) if len(other) else np.empty((0, 2), np.int64)
            numbers, hash_blobs, tag_blobs = _blobs(bucket, hashes[starts], tags[starts])
            first, none = len(numbers) > 0, [b""] * max(0, len(numbers) - 1)
            tied = pa.array([tied.tobytes()] * first + none, pa.binary())
            yield pa.RecordBatch.from_arrays([numbers, hash_blobs, tag_blobs, tied], ["bucket", "hashes", "tags", "tied"])

    def forest(group: pa.Table) -> pa.Table:
        give_back()
        hashes, tags, starts, runs = _by_hash(_joined(group["hashes"], np.uint64), _joined(group["tags"], np.int64))
        held = np.repeat(tags[starts], runs)
        other = tags != held
        pairs = np.concatenate([np.stack([held[other], tags[other]], 1), _joined(group["tied"], np.int64).reshape(-1, 2)])
        ids, places = np.unique(pairs, return_inverse=True)
        trees = _Forest(len(ids))
        for x, y in places.reshape(-1, 2).tolist():
            trees.join(x, y)
        roots = np.array([trees.find(x) for x in range(len(ids))], np.int64)
        kept = np.flatnonzero(roots != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[roots[kept]]), "b": pa.array(ids[kept])})

    blobs = texts.select("tag", "prefix").mapInArrow(spread, "bucket int, hashes binary, tags binary, tied binary")
    return blobs.groupBy("bucket").applyInArrow(forest, "a long, b long")


def block_links(sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links in one block (all of one ``side``) or between two blocks.

    Rows of the incidence matrix times its transpose, a row at a time: the columns of the row's
    n-grams add up to its overlaps with all rows not yet connected. A row that links joins the
    row's tree and is multiplied next; the matrix shrinks as rows leave it."""
    sizes = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    _, columns = np.unique(np.concatenate(sets), return_inverse=True) if len(rows) else (None, rows)
    first = np.r_[0, np.cumsum(sizes)]
    two = len(np.unique(side)) > 1
    open_rows = np.ones(len(sets), bool)

    def by_column():
        live = open_rows[rows]
        order = np.argsort(columns[live], kind="stable")
        counts = np.bincount(columns[live], minlength=int(columns.max(initial=-1)) + 1)
        return rows[live][order], np.r_[0, np.cumsum(counts)], counts

    listed, starts, counts = by_column()
    left, built = len(sets), len(sets)
    for seed in range(len(sets)):
        if not open_rows[seed]:
            continue
        open_rows[seed] = False
        left -= 1
        queue = [seed]
        while queue and left:
            if 2 * left < built:
                listed, starts, counts = by_column()
                built = left
            x = queue.pop()
            own = columns[first[x] : first[x + 1]]
            n = counts[own]
            # The concatenated lists of the row's columns.
            at = np.repeat(starts[own] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            overlap = np.bincount(listed[at], minlength=len(sets))
            may = np.flatnonzero(overlap * (num + den) >= num * (sizes + sizes[x]))
            may = may[open_rows[may]]
            if two:
                may = may[side[may] != side[x]]
            for y in may.tolist():
                open_rows[y] = False
                left -= 1
                queue.append(y)
                yield seed, y


def _links(texts: DataFrame, blocks: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of keys: a forest of the links among texts of the same candidate component."""

    def product(group: pa.Table) -> pa.Table:
        give_back()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["hashes"]]
        side = group["block"].to_numpy()
        pairs = list(block_links(sets, side, num, den))
        keys = group["key"].combine_chunks() if group.num_rows else pa.array([], pa.binary())
        ends = [pa.array([keys[p[i]].as_py() for p in pairs], pa.binary()) for i in (0, 1)]
        return pa.table({"a": ends[0], "b": ends[1]})

    blocked = texts.join(blocks, "tag")
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("long")
    # Small components share a task's block; of a large one, every two blocks meet once.
    small = blocked.where("blocks = 1").select("key", "hashes", F.lit(0).cast("long").alias("block"), F.col("bucket").alias("c"), F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j"))
    large = blocked.where("blocks > 1").withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    large = large.withColumn("other", other).select("key", "hashes", "block", F.col("root").alias("c"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return small.unionByName(large).groupBy("c", "i", "j").applyInArrow(product, "a binary, b binary")


def link_documents(docs: DataFrame, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """One row per row of ``docs`` (of which doc_id and text are read): doc_id, n_shingles and
    component_id, the smallest doc_id reachable by links."""
    num, den = similarity
    sets = staged(_shingled(_hashed(docs), size, num, den, whole=False), "sets", batch_bytes=TEXT_BYTES)

    in_all = sets.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0
    n = F.col("n_shingles")
    least = F.expr(f"({num} * n_shingles + {den - 1}) div {den}")  # also the size of the smallest partner
    asked = 1 + least - F.expr(f"({num} * (({num} * n_shingles + {den - 1}) div {den}) + {den - 1}) div {den}")
    matches = _matches(sets.where(n > 0), 1 + in_all // (8 * BUCKET))
    one_row = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("one_row")
    copies = sets.where(n > 0).groupBy("key", "tag", "n_shingles")
    copies = staged(copies.agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), one_row), "copies")
    near = copies.join(matches, "tag").where(F.col("matches") >= asked)
    near = staged(near.select("key", F.col("one_row.doc_id").alias("near_id"), F.col("one_row.text_hash").alias("near_hash")), "near")

    # The whole sets of the texts left, each from one of the rows that have it.
    same_row = F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("text_hash") == F.col("near_hash"))
    maybe, _ = split_by(_hashed(docs), F.col("text_hash"), near, "near_hash")
    whole = _shingled(maybe.join(near, same_row, "left_semi"), size, num, den, whole=True)
    whole = whole.select("key", "tag", "n_shingles", "hashes")
    whole = staged(whole.dropDuplicates(["key"]), "whole", batch_bytes=TEXT_BYTES)

    left = whole.agg(F.sum("n_shingles")).first()[0] or 0
    whole = staged(_rarest(whole, 1 + left // BUCKET, num, den), "rarest")
    left = whole.agg(F.sum("n_shingles")).first()[0] or 0
    candidates = components(_candidate_edges(whole, 1 + left // (4 * BUCKET)))
    candidates = staged(candidates.select(F.col("node").alias("tag"), "root"), "candidates")
    weights = whole.join(candidates, "tag").groupBy("root").agg(F.sum("n_shingles").alias("weight"))
    blocks = weights.select("root", F.ceil(F.col("weight") / BLOCK).cast("long").alias("blocks"), F.pmod(F.xxhash64("root"), F.lit(1 + left // SMALL)).cast("long").alias("bucket"))
    blocks = staged(candidates.join(blocks, "root"), "blocks")
    labels = components(_links(whole, blocks, num, den)).select(F.col("node").alias("key"), "root")

    labelled = copies.join(staged(labels, "labels"), "key", "left")
    of_root = labelled.where("root is not null").groupBy("root").agg(F.min("first_id").alias("root_id"))
    named = labelled.where("copies > 1 or root is not null").join(of_root, "root", "left")
    named = staged(named.select("key", F.coalesce("root_id", "first_id").alias("component_id")), "named")
    return sets.join(named, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
