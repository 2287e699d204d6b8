"""Ranked lexical search: the best documents for each item by exact integer term scores.

An item's terms have weights, a document's terms have impacts, and a score is the sum of their
products. Scores are made as dense matrix products: the weights of a tile of items over its
compact vocabulary times the impacts of a tile of documents over the same vocabulary. The
products run in float64 over as many terms as keep every partial sum below 2^53, so each is a
whole number that float64 holds, and the partial sums are added up as 64-bit integers.

Documents are read into terms once for each group of items (one group, unless the items have
more than ``TERMS_PER_GROUP`` different pairs of item and term) and written with their term
numbers. A task keeps the best of each item over its own tiles, equal scores by document id, so
no tie is lost at a tile's edge; then the best of tasks and the best of all follow, and no group
ever holds more than a few rows of each task.

An item is all rows with its item_id, whose texts' terms are taken together; a null id is an id
like any other. Null and empty texts have no terms: such items have no result, and such
documents are in none. Repeated documents are ranked each, documents without an id after equal
ones with one. Ids of documents are integers. Empty tables give no rows. Other columns of either
table are left out."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import ascii_lower, staged, text_groups

RESULTS = 50
#: Pairs of item and term in one group, whose vocabulary is broadcast: some 20 MB at most. An
#: item is never divided, so a single longer one is a group of its own size.
TERMS_PER_GROUP = 200_000
#: Items, terms and documents of one product.
ITEM_TILE, TERM_TILE, DOC_TILE = 256, 4_096, 512
#: Bytes of text read into terms at once.
READ_BYTES = 1 << 20
#: Tasks whose best rows are compared first.
TASKS_TOGETHER = 64

#: Impacts are below 1e9 / 1000.
IMPACT_BOUND = 1_000_000
EXACT = 1 << 53

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Letters and digits stay, A-Z lower-cased, as do all bytes beyond ASCII; the rest are blanks.
_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()

# Fixed values of the score.
WEIGHT_SCALE, IMPACT_SCALE, FLAT, SHARE = 1000, 1_000_000_000, 20, 50


def terms(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each pair once."""
    found = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD), F.lit(0)))
    return items.select("item_id", F.explode(found).alias("term")).distinct()


def read_terms(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, times) of every row of ``docs``: its number of terms, and the numbers
    and counts of those in ``vocabulary``, a broadcast dict of term to number."""

    def run(batches):
        known = vocabulary.value
        size = max(1, len(known))
        for batch in batches:
            for first, group in text_groups(batch["text"], READ_BYTES):
                lists = [terms(t) for t in group]
                lengths = np.fromiter(map(len, lists), np.int64, len(lists))
                numbers = np.fromiter((known.get(w, -1) for words in lists for w in words), np.int64, int(lengths.sum()))
                rows = np.repeat(np.arange(len(lists)), lengths)
                there = numbers >= 0
                pairs, times = np.unique(rows[there] * size + numbers[there], return_counts=True)
                edges = np.searchsorted(pairs, np.arange(len(lists) + 1) * size).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, len(group)),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array((pairs % size).astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(times)),
                    ],
                    ["doc_id", "n", "terms", "times"],
                )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<long>")


def document_counts(read: DataFrame, size: int) -> np.ndarray:
    """For each term number, the documents that have it. Each task sends a row a term."""

    def run(batches):
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(batch["terms"].flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["term", "df"])

    found = read.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    counts = np.zeros(size, np.int64)
    for row in found.collect():  # at most `size` rows
        counts[row["term"]] = row["df"]
    return counts


def weights(counts: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * c + 1))) for c in counts.tolist()], np.int64)


def impacts(times: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Of a term found ``times`` times in a document of so many terms."""
    m = 100 - SHARE + SHARE * lengths * n_docs // n_terms
    return IMPACT_SCALE * times // (1000 * times + FLAT * m)


def term_tiles(weight: np.ndarray, width: int = TERM_TILE) -> list[slice]:
    """Terms in order, cut so that no item's partial sum over a tile can reach 2^53."""
    tiles, start, bound = [], 0, 0
    for i, w in enumerate(weight.tolist()):
        if i > start and (i - start == width or bound + w * IMPACT_BOUND >= EXACT):
            tiles.append(slice(start, i))
            start, bound = i, 0
        bound += w * IMPACT_BOUND
    return [*tiles, slice(start, len(weight))] if len(weight) else []


class ItemTile:
    """Some items' weights over the terms that any of them has."""

    def __init__(self, first: int, lists: list[np.ndarray], weight: np.ndarray):
        self.first = first
        self.vocabulary = np.unique(np.concatenate(lists))
        compact = weight[self.vocabulary]
        dense = np.zeros((len(lists), len(self.vocabulary)))
        for row, numbers in enumerate(lists):
            at = np.searchsorted(self.vocabulary, numbers)
            dense[row, at] = compact[at]
        self.parts = [(tile, np.ascontiguousarray(dense[:, tile])) for tile in term_tiles(compact)]

    def scores(self, numbers: np.ndarray, docs: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Items by documents, from the documents' entries (term number, document, impact)."""
        at = np.minimum(np.searchsorted(self.vocabulary, numbers), len(self.vocabulary) - 1)
        there = self.vocabulary[at] == numbers
        at, docs, impact = at[there], docs[there], impact[there]
        total = np.zeros((len(self.parts[0][1]), n_docs), np.int64)
        for tile, weight in self.parts:
            inside = (at >= tile.start) & (at < tile.stop)
            dense = np.zeros((weight.shape[1], n_docs))
            dense[at[inside] - tile.start, docs[inside]] = impact[inside]
            total += (weight @ dense).astype(np.int64)
        return total


class Best:
    """The best documents of each item so far: highest score first, then smallest id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores = [np.empty(0, np.int64)] * items
        self.ids = [np.empty(0, np.int64)] * items
        self.least = np.ones(items, np.int64)  # what a document must reach

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        least = self.least[first : first + len(scores)]
        for row in np.flatnonzero(scores.max(1, initial=0) >= least).tolist():
            item = first + row
            at = np.flatnonzero(scores[row] >= least[row])
            new_scores = np.concatenate([self.scores[item], scores[row, at]])
            new_ids = np.concatenate([self.ids[item], ids[at]])
            order = np.lexsort((new_ids, -new_scores))[: self.k]
            self.scores[item], self.ids[item] = new_scores[order], new_ids[order]
            if len(order) == self.k:
                self.least[item] = new_scores[order[-1]]


#: Stands for a null id, so that it comes after all others.
NO_ID = np.iinfo(np.int64).max


def _doc_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Ids and lengths of some documents, and their entries (term number, document, times)."""
    for batch in batches:
        for at in range(0, len(batch), DOC_TILE):
            part = batch.slice(at, DOC_TILE)
            sizes = part["terms"].value_lengths().to_numpy()
            yield (
                part["doc_id"].fill_null(NO_ID).to_numpy(),
                part["n"].to_numpy(),
                part["terms"].flatten().to_numpy(),
                np.repeat(np.arange(len(part)), sizes),
                part["times"].flatten().to_numpy(),
            )


def best_of_tasks(read: DataFrame, lists: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score, task): the best documents of each item in every task."""
    tiles = [ItemTile(at, lists[at : at + ITEM_TILE], weight) for at in range(0, len(lists), ITEM_TILE)]
    shared = read.sparkSession.sparkContext.broadcast((tiles, len(lists)))

    def run(batches):
        tiles, n_items = shared.value
        best = Best(n_items, k)
        for ids, lengths, numbers, rows, times in _doc_tiles(batches):
            if not len(numbers):
                continue
            impact = impacts(times, lengths[rows], n_docs, n_terms)
            for tile in tiles:
                best.add(tile.first, tile.scores(numbers, rows, impact, len(ids)), ids)
        items = np.repeat(np.arange(n_items), [len(s) for s in best.scores])
        ids = np.concatenate(best.ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items), pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate(best.scores)), pa.array(np.full(len(items), TaskContext.get().partitionId()))],
            ["item", "doc_id", "score", "task"],
        )

    return read.mapInArrow(run, "item long, doc_id long, score long, task long")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = RESULTS, terms_per_group: int = TERMS_PER_GROUP) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best rows of ``docs`` (doc_id, text)
    for each item of ``items`` (item_id, text), with scores above 0."""
    spark = docs.sparkSession
    wanted = staged(item_terms(items.select("item_id", "text")), "item_terms")
    groups = max(1, -(-wanted.count() // terms_per_group))
    number = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    results = []
    for group in range(groups):
        lists: dict = {}
        vocabulary: dict[bytes, int] = {}
        for row in wanted.where(number == group).orderBy("item_id", "term").collect():  # one group's bounded pairs
            lists.setdefault(row["item_id"], []).append(vocabulary.setdefault(row["term"].encode(), len(vocabulary)))
        shared = spark.sparkContext.broadcast(vocabulary)
        read = staged(read_terms(docs, shared), "read")
        n_docs, n_terms = read.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not lists or not n_docs:
            continue
        weight = weights(document_counts(read, len(vocabulary)), n_docs)
        found = best_of_tasks(read, [np.array(x) for x in lists.values()], weight, n_docs, n_terms, k)
        found = _ranked(found.withColumn("some", F.floor(F.col("task") / TASKS_TOGETHER)), ["item", "some"], k)
        ids = spark.createDataFrame(list(enumerate(lists)), f"item long, item_id {items.schema['item_id'].dataType.simpleString()}")
        results.append(_ranked(found.select("item", "doc_id", "score"), ["item"], k).join(F.broadcast(ids), "item"))
    if not results:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    every = results[0]
    for other in results[1:]:
        every = every.unionByName(other)
    return every.select("item_id", "rank", "doc_id", "score")
