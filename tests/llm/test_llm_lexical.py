"""Ranked search against a brute-force ranking, with every cut of tiles and groups."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from awkward import documents, empty, odd_documents, rows, sentence

from footfall.llm import lexical_search
from footfall.llm.lexical_search import Best, ItemTile, search, term_tiles, terms, weights

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_terms(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def slow_search(docs, items, k=50):
    counted = [(i, Counter(slow_terms(text))) for i, text in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(slow_terms(text))
    out = []
    for item, query in wanted.items():
        scored = []
        for i, c, n in counted:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                for t in query if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def some_items(spark):
    rng = random.Random(2)
    items = [(n, sentence(rng, rng.randint(1, 12))) for n in range(12)]
    items += [(20, None), (21, ""), (22, "..."), (23, "Straße, ÉTÉ été"), (24, "nowhere"), (None, "alpha"), (3, "東京 x"), (25, "x")]
    return items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("k, per_group", [(50, 200_000), (3, 200_000), (7, 20)])
def test_search(spark, monkeypatch, k, per_group):
    if k == 3:
        for name, value in (("ITEM_TILE", 4), ("TERM_TILE", 5), ("DOC_TILE", 3), ("TASKS_TOGETHER", 1), ("READ_BYTES", 64)):
            monkeypatch.setattr(lexical_search, name, value)
    docs = documents(spark, 3, clash=k == 3).unionByName(odd_documents(spark), allowMissingColumns=True)
    items, table = some_items(spark)
    wanted = slow_search([(r.doc_id, r.text) for r in docs.collect()], items, k)
    assert rows(search(docs, table, k, per_group), "item_id", "rank", "doc_id", "score") == wanted
    assert len({r[3] for r in wanted}) < len(wanted)  # there are ties


def test_many_equal_documents(spark):
    docs = spark.range(500).selectExpr("499 - id AS doc_id", "'alpha beta' AS text").repartition(6)
    items = spark.createDataFrame([(1, "beta"), (2, "gamma")], "item_id long, text string")
    found = search(docs, items, 50).orderBy("rank").collect()
    assert [r.doc_id for r in found] == list(range(50)) or not found  # the weight of a word in all documents may be 0
    docs = docs.unionByName(spark.range(500, 2000).selectExpr("id AS doc_id", "'delta' AS text"))
    found = search(docs, items, 50).orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in found] == [(1, n + 1, n) for n in range(50)]


def test_empty_tables(spark):
    items, table = some_items(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert search(empty(spark), table).collect() == []
    assert search(documents(spark, 1), none).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert search(blank, table).collect() == []


def test_terms_and_weights():
    text = "A-Z ÀÉ été\x00x_9\x7f東京"
    assert [t.decode() for t in terms(text.encode())] == slow_terms(text)
    assert weights(np.array([0, 3, 10]), 10).tolist() == [math.floor(1000 * math.log(22 / d)) for d in (1, 7, 21)]


def test_partial_sums_stay_exact():
    weight = np.array([20_000] * 3 + [1 << 33] * 5 + [7])
    tiles = term_tiles(weight, 4)
    assert [i for t in tiles for i in range(t.start, t.stop)] == list(range(len(weight)))
    assert all(t.stop - t.start == 1 or int(weight[t].sum()) * 1_000_000 < 1 << 53 for t in tiles)
    rng = np.random.default_rng(1)
    lists = [np.sort(rng.choice(40, 12, replace=False)) for _ in range(5)]
    weight = rng.integers(0, 25_000, 40)
    impact = rng.integers(0, 1_000_000, (30, 40))
    docs, numbers = np.nonzero(impact)
    found = ItemTile(0, lists, weight).scores(numbers, docs, impact[docs, numbers], 30)
    assert found.tolist() == [[int((weight[q] * impact[d, q]).sum()) for d in range(30)] for q in lists]


def test_best_keeps_ties_by_id():
    rng = np.random.default_rng(4)
    best, seen = Best(3, 5), []
    for _ in range(20):
        scores, ids = rng.integers(0, 6, (3, 8)), rng.integers(0, 1000, 8)
        best.add(0, scores, ids)
        seen.append((scores, ids))
    for item in range(3):
        every = sorted((-int(s), int(i)) for scores, ids in seen for s, i in zip(scores[item], ids) if s > 0)[:5]
        assert list(zip((-best.scores[item]).tolist(), best.ids[item].tolist())) == every
