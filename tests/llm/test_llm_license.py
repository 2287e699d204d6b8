"""Licence signatures: their literals, and detections against a brute-force scan."""

from __future__ import annotations

import random
import re

import pytest
from awkward import documents, empty, odd_documents, rows, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm.license_rules import ANCHORS, BODY, MENTION, NAMED, TAG, Rule, rules
from footfall.llm.license_scan import scan_licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RULES = rules()


def slow_scan(docs, signatures=RULES):
    out = []
    for i, text in docs:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        spaced = "".join(f" {w} " for w in ws)
        places = [
            (spaced[: m.start()].count(" ") // 2, m.group().count(" ") // 2, r.priority, number)
            for number, r in enumerate(signatures) for m in re.finditer(r.expression, spaced)
        ]

        def covers(o, p):
            inside = o[0] <= p[0] and o[0] + o[1] >= p[0] + p[1]
            return inside and (o[2] > p[2] or o[2] == p[2] and (o[1] > p[1] or o[1] == p[1] and o[3] < p[3]))

        stay = [p for p in places if not any(covers(o, p) for o in places)]
        base = [p for p in places if signatures[p[3]].base]
        labels = sorted({signatures[p[3]].label for p in base + stay})
        out.append((
            i, len(ws), sorted((p[0], p[0] + p[1], p[3], signatures[p[3]].label) for p in stay), len(base),
            min((p[0] for p in base), default=None), max((p[0] for p in base), default=None),
            sorted({signatures[p[3]].label for p in base}), labels, max((signatures[p[3]].confidence for p in stay), default=0.0),
        ))
    return sorted(out, key=repr)


COLUMNS = "doc_id n_words detections n_base first_word last_word base_labels labels score".split()


def scanned(docs, signatures=None):
    found = [tuple([tuple(d) for d in v] if c == "detections" else v for c, v in zip(COLUMNS, r)) for r in scan_licenses(docs, signatures).select(*COLUMNS).collect()]
    return sorted(found, key=repr)


NOTICES = [
    "Licensed under the Apache License,\n# Version 2.0 (the \"License\")", "SPDX-License-Identifier: GPL-3.0-or-later", "MIT License MIT license",
    "This work is licensed under the GNU General Public License, version 3.", "released under the MIT License.", "licensed under CC BY-NC 4.0.",
    "GNU Lesser General Public License v2.1 and Mozilla Public License 2.0", "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "creative commons attribution share-alike 4.0", "mit Lizenz, general public  licence", "permissions", "Apache license apache license Apache License 2.0",
]


def notices(spark, n=60):
    rng = random.Random(6)
    texts = [" ".join(rng.choice([rng.choice(NOTICES), sentence(rng, 5)]) for _ in range(rng.randint(1, 8))) for _ in range(n)]
    texts += [*NOTICES, "\n".join(rng.choice(NOTICES) for _ in range(300))]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_scan(spark):
    docs = notices(spark)
    wanted = slow_scan([tuple(r) for r in docs.collect()])
    assert scanned(docs) == wanted
    assert any(w[3] and not any(RULES[d[2]].base for d in w[2]) for w in wanted)  # some base places are covered


def test_scan_awkward_tables(spark):
    for docs in (documents(spark, 4, clash=True), odd_documents(spark).unionByName(odd_documents(spark)), empty(spark)):
        docs = docs.selectExpr("*", "'x' AS words", "1 AS found", "2 AS row_no2")
        assert scanned(docs) == slow_scan([(r.doc_id, r.text) for r in docs.collect()])
    copies = spark.range(50).selectExpr("cast(null AS long) AS doc_id", "'MIT License' AS text")
    assert rows(scan_licenses(copies), "n_base", "score") == [(1, 0.5)] * 50


def test_explicit_rules_cover_others(spark):
    signatures = [
        Rule("long", ("licen", "a"), " a  b  license  c ", MENTION), Rule("tag", ("licen", "b"), " b  license ", TAG),
        Rule("named", ("licen", "b"), " b  license ", NAMED), Rule("part", ("licen", "license"), " license ", MENTION),
        Rule("twin", ("licen", "license"), " license ", MENTION), Rule("over", ("licen", "c"), " license  c  d ", BODY),
    ]
    texts = ["a b license c", "b license", "license", "a b license c d", "license license x license", "license c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert scanned(docs, signatures) == slow_scan(list(enumerate(texts)), signatures)
    assert [r[7] for r in scanned(docs, signatures)][:3] == [["long", "tag"], ["tag"], ["part"]]


def test_rules_are_many_and_ordered():
    assert len(RULES) > 300 and [r.base for r in RULES[:4]] == [True, True, True, False]
    assert all(any(a in need for a in ANCHORS for need in r.needs) for r in RULES)


def holds_its_literals(rule):
    @settings(max_examples=15, deadline=None, database=None)
    @given(st.from_regex(rule.expression, fullmatch=True))
    def holds(match):
        assert all(need in match for need in rule.needs), (rule, match)

    return holds


@pytest.mark.parametrize("start", range(0, len(RULES), 140))
def test_every_match_holds_its_literals(start):
    for rule in RULES[start : start + 140]:
        holds_its_literals(rule)()
