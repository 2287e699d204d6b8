"""Licence detection: ordered signature rules over a text's words.

A text becomes its words, A-Z lower-cased, with a blank on each side of every word. Few texts
hold one of the anchors, and of the rules only those are tried whose literals the text holds;
cutting a text at a rule's matches gives the places of all of them, counted in words. A
detection goes if one that is at least as explicit covers all its words: a longer one, or for the
same words a more explicit or earlier rule's. This is decided by running maxima over a text's
detections in order of their start, so it takes no pairs.

Only detections are shuffled, by row, so one group is one text. Null and empty texts have no
words and no detections; repeated rows and null ids come out each; an empty table gives no rows.
Columns other than doc_id and text are left out."""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import ascii_lower, staged
from footfall.llm.license_rules import ANCHORS, CONFIDENCE, TAG, Rule, rules

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

def spaced_words(text: Column) -> Column:
    """All words in order, each between two blanks."""
    words = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, "  "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


_RULE = "array<struct<number: int, label: string, priority: int, base: boolean, need: string, literal: string, expression: string>>"


def _rule_list(signatures: list[Rule]) -> Column:
    """The rules as one constant, which the plan holds as text and folds once."""
    listed = [
        {"number": n, "label": r.label, "priority": r.priority, "base": r.base, "need": r.needs[0], "literal": r.needs[1], "expression": r.expression}
        for n, r in enumerate(signatures)
    ]
    return F.from_json(F.lit(json.dumps(listed)), _RULE)


def _in_words(pieces: Column) -> Column:
    """The number of words in each piece of spaced words: each has two blanks."""
    return F.transform(pieces, lambda p: ((F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit("")))) / 2).cast("int"))


def find_matches(docs: DataFrame, signatures: list[Rule]) -> DataFrame:
    """doc_id, n_words, and per rule that matches the words before and within its matches."""
    texts = docs.select("doc_id", spaced_words(F.col("text")).alias("words"))
    words = F.col("words")
    gate = reduce(or_, [F.contains(words, F.lit(a)) for a in ANCHORS])
    tried = F.filter(_rule_list(signatures), lambda r: F.contains(words, r["need"]) & F.contains(words, r["literal"]))
    found = F.transform(tried, lambda r: F.struct(
        r["number"].alias("rule"), r["label"].alias("label"), r["priority"].alias("priority"), r["base"].alias("base"),
        _in_words(F.split(words, r["expression"], -1)).alias("between"),
        _in_words(F.regexp_extract_all(words, r["expression"], F.lit(0))).alias("lengths"),
    ))
    found = F.filter(found, lambda f: F.size(f["lengths"]) > 0)
    n_words = F.element_at(_in_words(F.array(words)), 1).cast("long")
    return texts.select("doc_id", n_words.alias("n_words"), F.when(gate, found).alias("found"))


def detections(matches: DataFrame) -> DataFrame:
    """One row per match of staged ``find_matches`` rows with found ones: where it starts and
    ends, and whether another covers it."""
    by_rule = matches.repartition("row_no").select("doc_id", "n_words", "row_no", F.inline("found"))
    places = by_rule.select(
        *[c for c in by_rule.columns if c not in ("between", "lengths")],
        F.posexplode(F.arrays_zip(F.slice("between", F.lit(1), F.size("lengths")).alias("before"), F.col("lengths").alias("words"))).alias("at", "m"),
    ).select("*", "m.before", "m.words").drop("m")
    in_rule = Window.partitionBy("row_no", "rule").orderBy("at")
    start = F.sum("before").over(in_rule.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(
        F.sum("words").over(in_rule.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = places.withColumn("start", start).withColumn("end", F.col("start") + F.col("words")).drop("at", "before", "words")
    # Whatever covers a detection comes before it in this order.
    order = Window.partitionBy("row_no").orderBy("start", F.desc("end"), F.desc("priority"), "rule")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    reached = [F.max(F.when(F.col("priority") >= level, F.col("end"))).over(earlier) for level in range(TAG + 1)]
    covered = F.element_at(F.array(*reached), F.col("priority") + 1) >= F.col("end")
    return placed.withColumn("covered", F.coalesce(covered, F.lit(False)))


def scan_licenses(docs: DataFrame, signatures: list[Rule] | None = None) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_words, the detections that nothing
    covers (start, end, rule, label), n_base, first_word and last_word of all places of the base
    phrases, base_labels, all labels, and as score the confidence of the most explicit one."""
    signatures = rules() if signatures is None else signatures
    matches = find_matches(docs, signatures).withColumn("row_no", F.monotonically_increasing_id())
    matches = staged(matches, "license_matches")
    some = F.coalesce(F.size("found") > 0, F.lit(False))
    span = F.struct("start", "end", "rule", "label")
    confidence = F.element_at(F.array(*[F.lit(c) for c in CONFIDENCE]), F.col("priority") + 1)
    own = F.when(~F.col("covered"), F.col("label"))
    base_labels = F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label"))))
    shown = detections(matches.where(some)).groupBy("row_no", "doc_id", "n_words").agg(
        F.array_sort(F.collect_list(F.when(~F.col("covered"), span))).alias("detections"),
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        base_labels.alias("base_labels"),
        F.array_sort(F.array_union(base_labels, F.collect_set(own))).alias("labels"),
        F.max(F.when(~F.col("covered"), confidence)).alias("score"),
    ).drop("row_no")
    fields = {f.name: f.dataType for f in shown.schema.fields}
    nothing = {"n_base": F.lit(0), "score": F.lit(0.0), "detections": F.array(), "base_labels": F.array(), "labels": F.array()}
    others = matches.where(~some).select(*[
        F.col(c) if c in ("doc_id", "n_words") else nothing.get(c, F.lit(None)).cast(t).alias(c) for c, t in fields.items()
    ])
    return shown.unionByName(others)
