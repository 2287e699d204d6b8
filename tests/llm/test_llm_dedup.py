"""Shared lines, exact copies and near copies against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from awkward import documents, empty, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import exact_dedup, jaccard_join
from footfall.llm.components import components
from footfall.llm.exact_dedup import MAX_CHUNK, MIN_CHUNK, chunk_bounds, cut_points, dedup_exact, verified_digest_bytes
from footfall.llm.jaccard_join import block_links, link_documents
from footfall.llm.line_dedup import dedup_lines
from footfall.llm.shingles import shingle_set, word_hashes

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_lines(docs: list[tuple]) -> list[tuple]:
    def key(line):
        return line.strip(BLANKS).translate(LOWER)

    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)

    def dropped(i, line):
        ids = holders.get(key(line), ())
        last = max((x for x in ids if x is not None), default=None)
        return len(ids) >= 5 and last is not None and (i is None or i < last)

    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not dropped(i, x)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_lines(spark, seed):
    docs = documents(spark, seed)
    found = rows(dedup_lines(docs), "doc_id", "text", "n_lines", "n_dropped")
    assert found == slow_lines([tuple(r) for r in docs.collect()])
    assert seed != 1 or sum(r[3] for r in found) > 5


def test_lines_odd(spark):
    docs = odd_documents(spark)
    found = rows(dedup_lines(docs), "doc_id", "text", "n_lines", "n_dropped")
    assert found == slow_lines([tuple(r) for r in docs.collect()])
    clashing = documents(spark, 1, clash=True)
    done = dedup_lines(clashing)
    assert done.columns == clashing.columns  # n_lines and n_dropped are replaced in place
    assert rows(done, "doc_id", "text", "n_lines") == rows(dedup_lines(documents(spark, 1)), "doc_id", "text", "n_lines")
    assert {r["key"] for r in done.collect()} == {"key"}
    assert dedup_lines(empty(spark)).collect() == []


def slow_copies(docs: list[tuple]) -> list[tuple]:
    def normal(text):
        return (text or "").translate({ord(c): None for c in BLANKS})

    groups = defaultdict(list)
    for i, text in docs:
        groups[normal(text)].append((-len(text or ""), i is None, i, text))
    out = []
    for whole, members in groups.items():
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        for m in members:
            out.append((m[2], best[2], len(members), hashlib.sha256(whole.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("make", [lambda s: documents(s, 1), lambda s: documents(s, 3, clash=True), odd_documents])
def test_copies(spark, make):
    docs = make(spark)
    done = dedup_exact(docs)
    assert rows(done, "doc_id", "keep_id", "group_size", "text_sha256") == slow_copies([tuple(r) for r in docs.select("doc_id", "text").collect()])
    # One row of each group is kept, repeated rows or not.
    kept = done.groupBy("text_sha256").agg({"group_size": "max"}).count()
    assert done.where("kept").count() == kept
    assert done.where("kept and not keep_id <=> doc_id").count() == 0


def test_copies_of_nothing(spark):
    assert dedup_exact(empty(spark)).collect() == []


def test_colliding_digests_are_found(spark):
    docs = documents(spark, 1)
    assert verified_digest_bytes(docs, 1) > 1
    whole = rows(dedup_exact(docs), "doc_id", "keep_id", "group_size")
    assert rows(dedup_exact(docs, digest_bytes=1), "doc_id", "keep_id", "group_size") == whole


@given(st.binary(max_size=40_000), st.integers(0, 3000))
@settings(max_examples=30, deadline=None)
def test_chunks_cover_a_text_and_follow_its_bytes(data, shift):
    data = data * (1 + 60_000 // (len(data) + 1))
    bounds = chunk_bounds(len(data), cut_points(data).tolist())
    assert [b for _, b in bounds[:-1]] == [a for a, _ in bounds[1:]]
    assert not data or (bounds[0][0], bounds[-1][1]) == (0, len(data))
    assert all(b - a <= MAX_CHUNK for a, b in bounds) and all(b - a >= MIN_CHUNK for a, b in bounds[:-1])


def test_long_texts_are_cut_alike_alone_and_together(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 123, n, dtype=np.uint8).tobytes() for n in (0, 5, 30_000, 700, 100_000)]
    together = list(exact_dedup._normalised(pa.array([*texts, None], pa.binary())))
    monkeypatch.setattr(exact_dedup, "SEGMENT", 1000)
    alone = [next(exact_dedup._normalised(pa.array([t], pa.binary()))) for t in [*texts, None]]
    assert [(t, list(b)) for t, b in together] == [(t, list(b)) for t, b in alone]


def slow_shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)} if words else set()


def slow_links(docs: list[tuple], num=85, den=100, *size: int) -> list[tuple]:
    sets = [slow_shingles(t, *size) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and den * len(a & b) >= num * len(a | b):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        least[find(k)].append(i)
    out = []
    for k, (i, _) in enumerate(docs):
        ids = [x for x in least[find(k)] if x is not None]
        out.append((i, len(sets[k]), min(ids) if ids and sets[k] else i))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 4])
def test_links(spark, seed):
    docs = documents(spark, seed, clash=seed == 4).select("*")
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(link_documents(docs), "doc_id", "n_shingles", "component_id") == slow_links(pairs)


def chain(n: int, words: int, step: int) -> list[str]:
    """Texts of which each is close to the next, but not to those far on."""
    line = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        line = [f"n{k}-{i}" if i == (k * step) % words else w for i, w in enumerate(line)]
        out.append(" ".join(line))
    return out


def test_links_of_a_large_group_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 400)
    monkeypatch.setattr(jaccard_join, "BUCKET", 200)
    monkeypatch.setattr(jaccard_join, "SMALL", 100)
    texts = chain(40, 60, 7) + chain(5, 60, 1) + ["common words in every text " * 3 + f"{i}" for i in range(20)]
    docs = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(link_documents(df), "doc_id", "n_shingles", "component_id") == slow_links(docs)


def test_links_odd(spark):
    docs = odd_documents(spark)
    assert rows(link_documents(docs), "doc_id", "n_shingles", "component_id") == slow_links([tuple(r) for r in docs.collect()])
    assert link_documents(empty(spark)).collect() == []


@given(st.lists(st.sets(st.integers(0, 12), min_size=1), max_size=12), st.data())
@settings(max_examples=60, deadline=None)
def test_block_links_are_a_forest_of_all_links(sets, data):
    side = np.array(data.draw(st.lists(st.integers(0, 1), min_size=len(sets), max_size=len(sets))), np.int64)
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    edges = list(block_links(arrays, side, 6, 10)) if sets else []
    two = len(set(side.tolist())) > 1
    wanted = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if 10 * len(sets[i] & sets[j]) >= 6 * len(sets[i] | sets[j]) and (not two or side[i] != side[j])
    ]

    def classes(pairs):
        of = list(range(len(sets)))
        for a, b in pairs:
            x, y = of[a], of[b]
            of = [x if c == y else c for c in of]
        return of

    a, b = classes(edges), classes(wanted)
    assert len(set(zip(a, b))) == len(set(a)) == len(set(b))
    assert len(edges) == len(sets) - len(set(a))


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(40, 50), (50, 45), (60, 60)] + [(100, i) for i in range(101, 160)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(31)}, 40: 40, 50: 40, 45: 40, **{i: 100 for i in range(100, 160)}}


@given(st.lists(st.text(alphabet="aB \n\tçé東", max_size=60), max_size=8))
@settings(max_examples=60, deadline=None)
def test_shingle_hashes_follow_the_words(texts):
    found = [shingle_set(w, 3) for w in word_hashes(pa.array(texts, pa.string()).cast(pa.binary()))]
    assert [len(f) for f in found] == [len(slow_shingles(t, 3)) for t in texts]
    for t, f in zip(texts, found):
        for u, g in zip(texts, found):
            assert len(set(f.tolist()) & set(g.tolist())) == len(slow_shingles(t, 3) & slow_shingles(u, 3))


def test_word_hashes_of_a_long_text(monkeypatch):
    text = ("some words of a long text " * 400).encode()
    (whole,) = word_hashes(pa.array([text], pa.binary()))
    monkeypatch.setattr("footfall.llm.shingles.SEGMENT", 100)
    parts = list(word_hashes(pa.array([b"x", text, None, b"y"], pa.binary())))
    assert (parts[1] == whole).all() and [len(p) for p in parts] == [1, len(whole), 0, 1]
