"""Best-fit packing of token sequences by patterns.

Texts become token ids with an end id; longer ones are cut into full pieces and a rest. The
plan needs only how many pieces have each length, at most one number per length: patterns of
two to four lengths that fill a sequence exactly get repeat counts by non-negative least
squares against this histogram. The larger counts are rounded and taken, and the next fit is
against what is left; after a few fits the rest is packed by best fit, longest first, many equal
pieces at a time. Each length's pieces are numbered across
all tasks, and a piece finds its place by its number, so no piece ever travels to a packer.

Null texts are empty and give one piece with the end id. Repeated rows are packed each. An
empty table gives no sequences."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import TEXT_BYTES, lean, staged
from footfall.llm.word_ids import worker_ids

SEQUENCE = 2048
END_ID = 0
#: Bytes of text tokenized, and of ids handed on, at once.
TEXT_BATCH = 1 << 20

#: Triples and quadruples tried for each longest length, fits, and sweeps over the patterns in each.
MIXES = 24
FITS, SWEEPS = 8, 6

Bins = list[tuple[tuple[int, ...], int]]


def tokenize_pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) and where the piece
    was made: its task, and its number among the task's pieces of the same length."""
    end = np.uint32(end_id).astype("<u4").tobytes()

    @lean
    def run(batches):
        coder = worker_ids(tokenizer)
        task, seen = TaskContext.get().partitionId(), defaultdict(int)

        def pieces(doc_ids: pa.Array, texts: list[bytes]):
            columns: list[list] = [[] for _ in range(6)]
            for row, ids in enumerate(coder.encode(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    length = len(part) // 4
                    for column, value in zip(columns, (row, k, at // 4, length, part, seen[length])):
                        column.append(value)
                    seen[length] += 1
            rows, k, start, length, part, nth = columns
            return pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(rows, pa.int64())), pa.array(k, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(part, pa.binary()), pa.array([task] * len(rows), pa.int32()), pa.array(nth, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids", "task", "nth"],
            )

        for batch in batches:
            at, texts, bytes_in = 0, [], 0
            for row, text in enumerate(batch["text"]):
                texts.append(text.as_buffer().to_pybytes())
                bytes_in += len(texts[-1])
                if bytes_in >= TEXT_BATCH:
                    yield pieces(batch["doc_id"].slice(at, len(texts)), texts)
                    at, texts, bytes_in = row + 1, [], 0
            yield pieces(batch["doc_id"].slice(at, len(texts)), texts)

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(
        run, f"doc_id {doc_type}, piece int, start long, length long, ids binary, task int, nth long"
    )


def exact_patterns(lengths: list[int], size: int = SEQUENCE, mixes: int = MIXES) -> list[tuple[int, ...]]:
    """Two to four of the given lengths that add up to ``size``, longest first. All pairs; for
    triples and quadruples, the middle lengths are taken evenly spread over those that fit."""
    there, ordered = set(lengths), sorted(lengths, reverse=True)
    array = np.array(ordered[::-1])
    found = {(a, size - a) for a in ordered if 2 * a >= size and size - a in there}

    def spread(low: int, high: int) -> list[int]:
        inside = array[np.searchsorted(array, low) : np.searchsorted(array, high, "right")]
        return inside[np.unique(np.linspace(0, len(inside) - 1, min(mixes, len(inside))).astype(int))].tolist() if len(inside) else []

    for a in ordered:
        rest = size - a
        for b in spread((rest + 1) // 2, min(a, rest - 1)):
            if rest - b in there:
                found.add((a, b, rest - b))
        for b in spread((rest + 2) // 3, min(a, rest - 2))[:: max(1, mixes // 6)]:
            for c in spread((rest - b + 1) // 2, min(b, rest - b - 1))[:: max(1, mixes // 6)]:
                if rest - b - c in there:
                    found.add((a, b, c, rest - b - c))
    return sorted(found, reverse=True)


def fitted_repeats(patterns: list[tuple[int, ...]], counts: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative repeats that bring the patterns' lengths closest to ``counts`` in least
    squares: each pattern in turn takes the best number, all others held, never below 0. From
    nothing the first patterns take much and leave little to the rest, so that many stay at 0."""
    left = counts.astype(float).tolist()
    parts = [(tuple(sorted(set(p))), p) for p in patterns]
    terms = [([(v, p.count(v)) for v in values], sum(p.count(v) ** 2 for v in values)) for values, p in parts]
    repeats = [0.0] * len(patterns)
    for _ in range(sweeps):
        for j, (lengths, norm) in enumerate(terms):
            wanted = 0.0
            for v, times in lengths:
                wanted += times * left[v]
            now = max(0.0, repeats[j] + wanted / norm)
            if now != repeats[j]:
                change, repeats[j] = now - repeats[j], now
                for v, times in lengths:
                    left[v] -= times * change
    return np.array(repeats)


def fitted_plan(left: np.ndarray, size: int) -> Bins:
    """Patterns for the pieces in ``left``, which loses them. Of a fit's repeats those at least half
    as large as the largest, and all that round to 1 or more, are taken."""
    patterns = [p for p in exact_patterns(np.flatnonzero(left).tolist(), size) if all(p.count(v) <= left[v] for v in p)]
    if not patterns:
        return []
    fitted, plan = fitted_repeats(patterns, left), []
    least = min(0.5, fitted.max() / 2)
    for j in np.argsort(-fitted, kind="stable").tolist():
        if fitted[j] < least or not fitted[j]:
            break
        need = np.bincount(patterns[j], minlength=len(left))
        at = np.flatnonzero(need)
        repeats = min(max(1, round(fitted[j])), int((left[at] // need[at]).min()))
        if repeats:
            left[at] -= repeats * need[at]
            plan.append((patterns[j], repeats))
    return plan


def best_fit(counts: np.ndarray, size: int = SEQUENCE) -> Bins:
    """Best fit, longest first: each length goes into the smallest gap that takes it. Equal
    sequences are kept together with their number."""
    gaps: dict[int, list[list]] = defaultdict(list)
    for length in range(min(size, len(counts) - 1), 0, -1):
        left = int(counts[length])
        for gap in sorted(g for g in gaps if g >= length):
            while left and gaps[gap]:
                group = gaps[gap][-1]
                # As many pieces of this length into each sequence as fit, if there are enough.
                each = max(1, min(gap // length, left // group[1]))
                used = min(group[1], left // each)
                group[1] -= used
                left -= used * each
                if not group[1]:
                    gaps[gap].pop()
                gaps[gap - each * length].append([group[0] + (length,) * each, used])
            if not left:
                break
        if left:
            each = size // length
            if left // each:
                gaps[size - each * length].append([(length,) * each, left // each])
            if left % each:
                gaps[size - left % each * length].append([(length,) * (left % each), 1])
    return [(contents, n) for groups in gaps.values() for contents, n in groups]


def pack_plan(counts: np.ndarray, size: int = SEQUENCE) -> Bins:
    """Sequences as (lengths, how many), for ``counts[length]`` pieces of each length."""
    counts = np.asarray(counts, np.int64)
    full = [((size,), int(counts[size]))] if counts[size] else []
    left, fitted = counts.copy(), []
    left[size] = 0
    best = best_fit(left, size)
    # Small lengths used up by patterns may be missed later, so each fit is kept only if the whole
    # needs no more sequences than without it.
    for _ in range(FITS):
        rest = left.copy()
        more = fitted_plan(rest, size)
        if not more:
            break
        plan = fitted + more + best_fit(rest, size)
        if _sequences(plan) > _sequences(best):
            break
        best, fitted, left = plan, fitted + more, rest
    return full + best


def _sequences(plan: Bins) -> int:
    return sum(n for _, n in plan)


def place_table(plan: Bins, size: int = SEQUENCE) -> dict[int, np.ndarray]:
    """For each length, rows (first number, first sequence, offset), by first number: piece
    number first + i of that length goes into sequence + i at the offset. The plan's size, not
    the number of pieces, bounds this table: a few rows for each of its groups."""
    taken, rows, sequence = defaultdict(int), defaultdict(list), 0
    for contents, n in plan:
        offset = 0
        for length in contents:
            rows[length].append((taken[length], sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` as tokenize_pieces makes them, staged, with sequence_id and offset in place
    of task and nth. All other columns are kept."""
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = np.zeros(size + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `size` rows
        counts[row["length"]] = row["n"]
    places = pieces.sparkSession.sparkContext.broadcast(place_table(pack_plan(counts, size), size))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    first = per_task.select("length", "task", before.alias("first"))
    kept = [c for c in pieces.columns if c not in ("task", "nth")]
    numbered = pieces.join(first, ["length", "task"]).select(*kept, (F.col("first") + F.col("nth")).alias("number"))

    @lean
    def run(batches):
        table = places.value
        for batch in batches:
            length, number = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "number"))
            sequence, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                rows = table[int(value)]
                row = rows[np.searchsorted(rows[:, 0], number[at], "right") - 1]
                sequence[at], offset[at] = row[:, 1] + number[at] - row[:, 0], row[:, 2]
            columns = [batch[c] for c in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    fields = [f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in kept]
    return numbered.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def stage_pieces(pieces: DataFrame) -> DataFrame:
    """Pieces are tokenized once: both the histogram and the placing read this table."""
    return staged(pieces, "pieces", batch_bytes=TEXT_BYTES)
