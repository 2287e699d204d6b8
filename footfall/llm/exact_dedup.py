"""Exact duplicates by content-defined chunk recipes.

Texts are equal when identical after deleting all blanks. Each text is cut where a rolling
hash of its own bytes says so, so equal texts are cut alike. A chunk's identifier is a keyed
digest that one job verifies: chunks with the same digest are compared byte by byte, and if
two differ, everything is done again with longer digests. From then on only the short ordered
identifier lists travel, never the texts.

Of equal texts the row with the most code points stays, then the smallest doc_id (null after
all others), then the row read first. Null texts are empty, and equal to blank ones. Repeated
rows count as copies, of which one is kept. An empty table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import BLANKS, staged

WINDOW = 16
#: A cut on average every 2 KB; no chunk but a text's last is shorter than MIN_CHUNK, none
#: longer than MAX_CHUNK.
CUT_BITS = 11
MIN_CHUNK, MAX_CHUNK = 512, 16_384
DIGEST_BYTES = 16
#: Bytes hashed at once, which bounds the arrays of one step.
SEGMENT = 1 << 22

_FACTOR = 0x2545F491


def cut_points(data: bytes) -> np.ndarray:
    """Ascending positions after which the last WINDOW bytes ask for a cut."""
    found = []
    array = np.frombuffer(data, np.uint8)
    for start in range(0, max(len(data) - WINDOW + 1, 0), SEGMENT):
        h = array[start : start + SEGMENT + WINDOW - 1].astype(np.uint32)
        width, factor = 1, _FACTOR
        while width < WINDOW:  # from the hash of `width` bytes to that of twice as many
            h = h[:-width] * np.uint32(factor) + h[width:]
            width, factor = 2 * width, factor * factor % 2**32
        h *= np.uint32(0x9E3779B1)
        found.append(np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + start + WINDOW)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_bounds(length: int, cuts: list[int]) -> list[tuple[int, int]]:
    """Chunks of a text of ``length`` bytes, given its wanted cuts."""
    bounds, start = [], 0
    for cut in [*cuts, length]:
        while cut - start > MAX_CHUNK:
            bounds.append((start, start + MAX_CHUNK))
            start += MAX_CHUNK
        if cut - start >= MIN_CHUNK or cut == length and cut > start:
            bounds.append((start, cut))
            start = cut
    return bounds


def _normalised(texts: pa.Array) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Each text without blanks, and its chunks. Short texts are hashed together."""
    blanks = BLANKS.encode()
    pending: list[bytes] = []

    def cut(group: list[bytes]):
        ends = np.cumsum([len(x) for x in group])
        cuts = cut_points(b"".join(group))
        begin = 0
        for x, end in zip(group, ends):
            # A cut less than a window after the text's start was made by its neighbour.
            a, b = np.searchsorted(cuts, [begin + WINDOW, end])
            yield x, chunk_bounds(len(x), (cuts[a:b] - begin).tolist())
            begin = end

    size = 0
    for text in texts:
        pending.append((text.as_buffer().to_pybytes() if text.is_valid else b"").translate(None, blanks))
        size += len(pending[-1])
        if size >= SEGMENT:
            yield from cut(pending)
            pending, size = [], 0
    yield from cut(pending)


def _digest(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def _binary_texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.char_length(text).cast("long").alias("n_chars"), text.cast("binary").alias("text"))


def chunks(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """Distinct (digest, chunk) of all texts; batches drop their own repeats before the shuffle."""

    def run(batches):
        for batch in batches:
            seen: dict[bytes, set[bytes]] = {}
            for text, bounds in _normalised(batch["text"]):
                for a, b in bounds:
                    seen.setdefault(_digest(text[a:b], digest_bytes), set()).add(text[a:b])
            pairs = [(d, c) for d, cs in seen.items() for c in cs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["digest", "chunk"]
            )

    return _binary_texts(docs).select("text").mapInArrow(run, "digest binary, chunk binary").distinct()


def recipes(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """doc_id, n_chars, row_no, recipe (the identifiers in order) and text_sha256."""

    def run(batches):
        partition, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            recipe, whole = [], []
            for text, bounds in _normalised(batch["text"]):
                recipe.append(b"".join(_digest(text[a:b], digest_bytes) for a, b in bounds))
                whole.append(hashlib.sha256(text).hexdigest())
            n = len(batch)
            rows = pa.array(np.arange(row, row + n) + (partition << 40))
            row += n
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_chars"], rows, pa.array(recipe, pa.binary()), pa.array(whole, pa.string())],
                ["doc_id", "n_chars", "row_no", "recipe", "text_sha256"],
            )

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return _binary_texts(docs).mapInArrow(
        run, f"doc_id {doc_type}, n_chars long, row_no long, recipe binary, text_sha256 string"
    )


def verified_digest_bytes(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> int:
    """A digest length under which no two different chunks share an identifier."""
    while True:
        clashes = chunks(docs, digest_bytes).groupBy("digest").count().where("count > 1")
        if clashes.isEmpty():
            return digest_bytes
        digest_bytes = min(2 * digest_bytes, 64)


def dedup_exact(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """One row per row of ``docs`` (of which doc_id and text are read): doc_id, keep_id,
    group_size, kept and text_sha256 of the text without blanks."""
    rows = staged(recipes(docs, verified_digest_bytes(docs, digest_bytes)), "recipes")
    best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row_no"))
    groups = rows.groupBy("recipe").agg(F.count("*").alias("size"), best.alias("best")).where("size > 1")
    # Written, so that Spark sees two plain scans and can split the rows of a large group.
    groups = staged(groups.select("recipe", "size", F.col("best.doc_id").alias("best_id"), F.col("best.row_no").alias("best_row")), "groups")
    joined = rows.join(groups, "recipe", "left")
    alone = F.col("size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row_no") == F.col("best_row"))).alias("kept"),
        "text_sha256",
    )
