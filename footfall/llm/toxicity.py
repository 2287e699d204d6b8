"""Toxicity by a weighted finite-state grammar over clauses.

A word automaton turns words into symbols: insults (I), threats (T), targets (Y), negations
(N), reporting verbs (R) and others (O). It holds word beginnings, those written down below and
those that labelled texts teach. The symbols of a clause pass through composed transducers:

    negation      marks an insult or threat up to three words behind a negation
    reported      marks one behind a reporting verb, as somebody else's words
    target        marks one in a clause that names a target before it

Each matched clause thus ends in one symbol, that of its heaviest match, with the weight of all.
Isolated words do not score: a document's features are its matched clauses, summed by symbol,
and a logistic model over them gives the score. Its coefficients are the final weights of the
grammar, fitted on labelled rows; so is what a negation or report takes away."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.bloom import split_by
from footfall.llm.common import TEXT_BYTES, lean, staged
from footfall.llm.labelled import class_sample, fold, known_labels
from footfall.llm.transducers import ANY, Transducer, compose

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: Labelled rows to fit the weights of outcomes on, at most, of each class.
SAMPLE_PER_CLASS = 15_000
#: Word beginnings that pass the tests, at most: those that most toxic texts have.
CANDIDATES = 50_000
MIN_PREFIX, MAX_PREFIX = 3, 12
#: Beginnings that a task counts before it passes the counts on.
COUNTED = 400_000
#: A beginning must occur in this many toxic texts, and this share of the texts with it be toxic.
MIN_TEXTS, MIN_PRECISION = 4, 0.5
#: A beginning is taken beside a shorter one if its share is higher by this much.
PURER = 0.04
#: Odds of one false beginning among all candidates, if labels fell at random.
CHANCE = 0.01

# Words known without labels, in English, German, French and Spanish. A word
# ending in "*" stands for all that begin so.
INSULTS = (
    "idiot* moron* stupid* scum* loser* trash worthless pathetic disgusting clown* dumb* fool* "
    "dummkopf* trottel* arschloch* abschaum wertlos* "
    "imbécile* connard* abruti* minable* "
    "estúpid* imbécil* basura inútil* escoria"
).split()
THREATS = "kill* murder* destroy* töten umbringen tuer tuerai matar mataré".split()
TARGETS = "you your yours they them du dich dein* ihr euch tu toi vous ton tú usted* ustedes".split()
NEGATIONS = "not no never nor nicht kein* nie ne pas jamais nunca jamás".split()
REPORTS = "said says say wrote claims claimed called sagte sagt schrieb dit écrit dijo dice escribió".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "I", "T", "Y", "N", "R", "O"
_NO_MATCH = (OTHER, 0.0)
_ALPHABET = (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER)
#: The weight of words that no label has taught.
KNOWN_WEIGHT = 1.0
NEGATED_WORDS = 3
#: Clauses of a symbol that count, at most: more do not make a text more toxic.
CLAUSES = 4.0

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.;:!?\n]+")


def negation_transducer() -> Transducer:
    """State n: n more words are within reach of a negation."""
    machine = Transducer()
    for left in range(NEGATED_WORDS + 1):
        arcs = {NEGATION: (NEGATED_WORDS, ANY, 0.0), ANY: (max(left - 1, 0), ANY, 0.0)}
        if left:
            for symbol in (INSULT, THREAT):
                arcs[symbol] = (left - 1, symbol + "n", 0.0)
        machine.arcs[left] = arcs
    return machine


def _marking(opener: str, mark: str, suffixes: tuple[str, ...]) -> Transducer:
    """From ``opener`` on, insults and threats (with these suffixes) get ``mark`` as well."""
    opened = {s + x: (1, s + x + mark, 0.0) for s in (INSULT, THREAT) for x in suffixes}
    return Transducer({0: {opener: (1, ANY, 0.0)}, 1: opened})


def clause_grammar() -> Transducer:
    """Negation, then reported speech, then targets, as one machine."""
    reported = _marking(REPORT, "r", ("", "n"))
    targeted = _marking(TARGET, "y", ("", "n", "r", "nr"))
    return reduce(lambda a, b: compose(a, b, _ALPHABET), (negation_transducer(), reported, targeted))


#: What a matched clause can end in.
OUTCOMES = [s + n + r + y for s in (INSULT, THREAT) for n in ("", "n") for r in ("", "r") for y in ("", "y")]


@dataclass
class Lexicon:
    """Word beginnings and whole words (ending in "$") with their symbol and weight."""

    entries: dict[str, tuple[str, float]]

    def __post_init__(self):
        self.longest = max(map(len, self.entries), default=0)
        self.known: dict[str, tuple[str, float]] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        """By the longest entry that fits; a whole word goes before any beginning."""
        found = self.known.get(word)
        if found is None:
            found = self.entries.get(word + "$")
            for n in range(min(len(word), self.longest), 0, -1):
                if found:
                    break
                found = self.entries.get(word[:n])
            found = found or _NO_MATCH
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[word] = found
        return found


def known_words() -> dict[str, tuple[str, float]]:
    lists = ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS), (INSULT, INSULTS))
    return {
        (w[:-1] if w.endswith("*") else w + "$"): (symbol, KNOWN_WEIGHT if symbol in (INSULT, THREAT) else 0.0)
        for symbol, ws in lists
        for w in ws
    }


def _heavier(weight: float, outcome: str) -> tuple[float, int, bool, str]:
    """Sorts matches: of equal weights a direct one is the heaviest, then one with a target."""
    return weight, -sum(mark in outcome for mark in "nr"), outcome.endswith("y"), outcome


def matched_clauses(text: str, lexicon: Lexicon, grammar: Transducer) -> Counter:
    """Weight of the matched clauses by outcome."""
    text = text.lower()
    words = set(_WORD.findall(text))
    symbol = lexicon.symbol
    found: Counter = Counter()
    if not any(symbol(w)[0] in (INSULT, THREAT) for w in words):
        return found
    for clause in _CLAUSE.split(text):
        words = _WORD.findall(clause)
        read = [symbol(w) for w in words]
        if any(s in (INSULT, THREAT) for s, _ in read):
            outcomes = grammar.read(s for s, _ in read)
            # A word repeated in a clause counts once, by its heaviest match.
            matches: dict[str, tuple] = {}
            for w, (s, weight), (out, more) in zip(words, read, outcomes):
                if s in (INSULT, THREAT):
                    matches[w] = max(matches.get(w, ()), _heavier(weight + more, out))
            found[max(matches.values())[-1]] += sum(match[0] for match in matches.values())
    return found


def features(text: str, lexicon: Lexicon, grammar: Transducer) -> list[float]:
    """By outcome, the weight of its clauses; last, whether they weigh more than any one word."""
    found = matched_clauses(text, lexicon, grammar)
    return [*(min(found[o], CLAUSES) for o in OUTCOMES), float(sum(found.values()) > 1)]


def _prefixes(words: set[str]) -> set[str]:
    """Beginnings of the words, and the words themselves."""
    return {w[:n] for w in words for n in range(MIN_PREFIX, min(len(w), MAX_PREFIX) + 1)} | {w + "$" for w in words}


def _text_words(text: pa.Scalar) -> set[str]:
    return set(_WORD.findall((text.as_py() or "").lower()))


def prefix_counts(taught: DataFrame) -> DataFrame:
    """(prefix, toxic, clean): texts of each class of ``taught`` (text, y) that have a beginning."""

    @lean
    def run(batches):
        counts: tuple[Counter, Counter] = Counter(), Counter()

        def counted():
            for y, held in enumerate(counts):
                n, none = pa.array(held.values(), pa.int64()), pa.array(np.zeros(len(held), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(held), pa.string()), *((n, none) if y else (none, n))], ["prefix", "toxic", "clean"]
                )
                held.clear()

        for batch in batches:
            for text, y in zip(batch["text"], batch["y"].to_pylist()):
                counts[y].update(_prefixes(_text_words(text)))
                if len(counts[0]) + len(counts[1]) > COUNTED:
                    yield from counted()
        yield from counted()

    counts = taught.select("text", "y").mapInArrow(run, "prefix string, toxic long, clean long")
    return counts.groupBy("prefix").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def candidate_counts(
    counts: DataFrame, texts: tuple[int, int], written: list[str], limit: int = CANDIDATES
) -> tuple[dict[str, int], dict[str, int], int]:
    """Toxic and clean texts of the beginnings that pass the tests of ``teach``, and of the
    written words however few texts have them; and how many beginnings were tested. Beyond
    ``limit`` the ones of fewer toxic texts go, so that the lexicon can be broadcast."""
    held = counts.where(F.col("toxic") >= MIN_TEXTS)
    tested = held.count()
    rate = _rate(texts)
    n, share = F.col("toxic") + F.col("clean"), F.col("toxic") / (F.col("toxic") + F.col("clean"))
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    beyond = (share > rate) & (n * (share * F.log(share / rate) + rest) > math.log(max(tested, 1) / CHANCE))
    good = held.where((share >= MIN_PRECISION) & beyond).orderBy(F.desc("toxic"), "prefix").limit(limit)
    rows = [*good.collect(), *counts.where(F.col("prefix").isin(written)).collect()]
    return {r["prefix"]: r["toxic"] for r in rows}, {r["prefix"]: r["clean"] for r in rows}, tested


def _rate(texts: tuple[int, int]) -> float:
    """Share of toxic texts, of (clean, toxic) ones."""
    return (texts[1] + 0.5) / (sum(texts) + 1)


def _beyond_chance(toxic: int, clean: int, rate: float, candidates: int) -> bool:
    """Whether so many toxic texts of all with the beginning are unlikely for ``rate``, even
    as the best of all candidates (Chernoff bound)."""
    n, share = toxic + clean, toxic / (toxic + clean)
    if share <= rate:
        return False
    gain = share * math.log(share / rate) + (math.log((1 - share) / (1 - rate)) * (1 - share) if share < 1 else 0.0)
    return n * gain > math.log(max(candidates, 1) / CHANCE)


def teach(toxic: dict[str, int], clean: dict[str, int], texts: tuple[int, int], tested: int | None = None) -> dict[str, float]:
    """Beginnings to hold against a text, with weights; they are the best of ``tested`` ones, or
    all there are. Of nested ones that the same texts
    have, the longest says best what is meant; of others, the one that most texts have."""
    rate, tested = _rate(texts), len(toxic) if tested is None else tested
    good = {
        p: n
        for p, n in toxic.items()
        if n >= MIN_TEXTS and n / (n + clean.get(p, 0)) >= MIN_PRECISION and _beyond_chance(n, clean.get(p, 0), rate, tested)
    }
    share = {p: n / (n + clean.get(p, 0)) for p, n in good.items()}
    nested = defaultdict(list)
    for p in good:
        nested[p[:-1]].append(p)
    chosen: dict[str, float] = {}
    for p in sorted(good, key=lambda p: (-good[p], len(p), p)):
        bare = p.rstrip("$")
        if any(share[bare[:n]] + PURER > share[p] for n in range(1, len(bare) + 1) if bare[:n] in chosen):
            continue
        # As long as nearly all of its texts stay, a longer beginning is meant.
        while True:
            longer = [q for q in nested[p] if good[q] >= 0.9 * good[p]]
            if p.endswith("$") or not longer:
                break
            p = max(longer, key=lambda q: (good[q], q))
        odds = (good[p] + 0.5) * (texts[0] + 1) / ((clean.get(p, 0) + 0.5) * (texts[1] + 1))
        chosen[p] = max(0.1, min(1.0, math.log(odds) / 6))
    return chosen


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton's steps; no coefficient is negative,
    as no match makes a text less toxic. Intercept first."""
    one = np.c_[np.ones(len(x)), x]
    b = np.zeros(one.shape[1])
    ridge = np.full(len(b), 0.05)
    ridge[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(one @ b, -30, 30)))
        h = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve(one.T @ (h[:, None] * one) + np.diag(ridge), one.T @ (weight * (y - p)) - ridge * b)
        b += np.clip(step, -2, 2)
        b[1:] = np.maximum(b[1:], 0)
    return b


@dataclass
class ToxicityModel:
    lexicon: dict[str, tuple[str, float]]
    coefficients: list[float]


def _clause_features(docs: DataFrame, lexicon: dict[str, tuple[str, float]], keep: list[str]) -> DataFrame:
    """The columns to keep, and the features of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most CANDIDATES entries

    @lean
    def run(batches):
        words, grammar = Lexicon(shared.value), clause_grammar()
        for batch in batches:
            rows = [features(t.as_py() or "", words, grammar) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [*[batch[k] for k in keep], pa.array(rows, pa.list_(pa.float64()))], [*keep, "features"]
            )

    fields = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep]
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*fields, "features array<double>"]))


def different_texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text_hash, y, text) of the labelled texts, each once: under the smallest of its ids,
    and with the label that most of its labelled rows have, the toxic one in a tie. The order of
    rows decides nothing. Texts travel once, ids and hashes before them."""
    known = staged(known.withColumnRenamed("doc_id", "known_id"), "known")
    held = docs.where("text is not null").select("doc_id", F.sha2("text", 256).alias("text_hash"), "text")
    maybe, _ = split_by(held, F.col("doc_id"), known, "known_id")
    labelled = maybe.select("doc_id", "text_hash").join(known, F.col("doc_id") == F.col("known_id"))
    once = labelled.groupBy("text_hash").agg(
        F.min("doc_id").alias("first_id"), (2 * F.sum("y") >= F.count("*")).cast("int").alias("y")
    )
    once = staged(once.withColumnRenamed("text_hash", "hash"), "once")
    same = (F.col("doc_id") == F.col("first_id")) & (F.col("text_hash") == F.col("hash"))
    rows = maybe.join(once, same).select("doc_id", "text_hash", "y", "text")
    return rows.dropDuplicates(["doc_id", "text_hash"])


def learn_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """From the labelled rows of ``docs`` that are not held out; copies of a text teach once.
    The words come from all of them, the coefficients from a weighted sample."""
    taught = staged(different_texts(docs, known_labels(labels, "toxic", FOLDS, HELD_OUT)), "taught")
    sizes = {r["y"]: r["count"] for r in taught.groupBy("y").count().collect()}
    lexicon = known_words()
    if sizes.get(1):
        texts = sizes.get(0, 0), sizes[1]
        written = [p for p, (s, _) in lexicon.items() if s in (INSULT, THREAT)]
        toxic, clean, tested = candidate_counts(staged(prefix_counts(taught), "prefixes", batch_bytes=TEXT_BYTES), texts, written)
        # What labels show to be harmless, or do not show to be harmful though common, is not used.
        for p in written:
            if clean.get(p, 0) >= 5 and toxic.get(p, 0) < MIN_PRECISION * (toxic.get(p, 0) + clean.get(p, 0)):
                del lexicon[p]
        for p, weight in teach(toxic, clean, texts, tested).items():
            lexicon[p] = (INSULT, weight)
    wanted = F.broadcast(class_sample(taught.select("doc_id", "text_hash", "y"), per_class).drop("y"))  # 2 * per_class rows
    sample = taught.join(wanted, ["doc_id", "text_hash"])
    fitted = _clause_features(sample, lexicon, ["y", "weight"]).toPandas()  # as many rows as the sample
    if len(set(fitted["y"])) < 2:
        rate = (fitted["y"].sum() + 0.5) / (len(fitted) + 1)
        return ToxicityModel(lexicon, [math.log(rate / (1 - rate)), *[2.0] * (len(OUTCOMES) + 1)])
    order = np.lexsort(np.array(fitted["features"].tolist()).T)
    x, y, weight = (np.array(fitted[c].tolist(), np.float64)[order] for c in ("features", "y", "weight"))
    return ToxicityModel(lexicon, _fit(x, y, weight).tolist())


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text).

    Null and empty texts match nothing and get the score of clean texts. Repeated rows give
    repeated rows. Without labels the written word lists are all that is known, and the score
    is that of a model with equal weights."""
    model = learn_toxicity(docs, labels, per_class)
    intercept, *weights = model.coefficients
    total = F.aggregate(
        F.zip_with("features", F.array(*map(F.lit, weights)), lambda f, w: f * w), F.lit(intercept), lambda a, b: a + b
    )
    found = _clause_features(docs, model.lexicon, ["doc_id"])
    scored = found.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), (1 / (1 + F.exp(-total))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
