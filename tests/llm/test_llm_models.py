"""Trained operators: held-out accuracy, exact parts against brute force, and odd tables."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from awkward import documents, empty, odd_documents, rows, sentence
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import lm, toxicity
from footfall.llm.quality_rules import fit_rules, lasso_logistic, score_quality, tree_rules
from footfall.llm.text_stats import STATS, statistics
from footfall.llm.toxicity import Lexicon, clause_grammar, known_words, matched_clauses, score_toxicity, teach
from footfall.llm.transducers import ANY, Transducer, compose

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels")]


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


NO_LABELS = "doc_id long, quality int, toxic int"


def fold(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


# --- transducers and toxicity


def test_composition_reads_like_one_after_the_other():
    upper = Transducer({0: {"a": (1, "A", 0.5)}, 1: {"b": (0, "B", 1.0), "a": (1, ANY, 0.25)}})
    count = Transducer({0: {"A": (1, "x", 1.0), ANY: (0, ANY, 0.0)}, 1: {ANY: (0, "y", 2.0)}})
    both = compose(upper, count, "abc")
    for text in ("", "a", "ab", "aab", "cabacab", "bbaacc"):
        middle = upper.read(text)
        last = count.read(m for m, _ in middle)
        assert both.read(text) == [(out, w + v) for (_, w), (out, v) in zip(middle, last)]


@pytest.mark.parametrize(
    ("text", "outcomes"),
    [
        ("What an idiot", {"I"}),
        ("You are an idiot", {"Iy"}),
        ("He is not a stupid man", {"In"}),
        ("They said you were scum", {"Iry"}),
        ("Not one of these many things is trash", {"I"}),
        ("I kill you. An idiot!", {"T", "I"}),
        ("said. idiot", {"I"}),
        ("Nothing bad here, at all", set()),
        ("IDIOT? Du bist ein Dummkopf", {"I", "Iy"}),
    ],
)
def test_clauses(text, outcomes):
    assert set(matched_clauses(text, Lexicon(known_words()), clause_grammar())) == outcomes


@pytest.mark.parametrize(
    ("text", "outcome"),
    [
        ("you idiot they said you idiot", "Iy"),
        ("idiot, he is not an idiot", "I"),
        ("they said idiot and you idiot", "Iry"),
        ("idiot and you idiot", "Iy"),
        ("an idiot, they said, and scum", "I"),
    ],
)
def test_the_heaviest_match_of_a_clause_counts(text, outcome):
    assert set(matched_clauses(text, Lexicon(known_words()), clause_grammar())) == {outcome}


def test_longest_entry_wins_and_whole_words_first():
    lexicon = Lexicon({"ab": ("I", 0.1), "abcd": ("T", 0.2), "abc$": ("N", 0.0)})
    assert [lexicon.symbol(w)[0] for w in ("a", "ab", "abc", "abcx", "abcd", "abcde")] == ["O", "I", "N", "I", "T", "T"]


def test_teaching_prefers_what_is_meant():
    toxic = {"gru": 60, "grum": 60, "grumb": 58, "grumba$": 20, "the$": 100, "rare$": 2}
    clean = {"the$": 900, "gru": 1}
    learned = teach(toxic, clean, (1000, 100))
    assert set(learned) == {"grumb"}


def test_toxicity_held_out(spark, tables):
    docs, known = tables
    found = score_toxicity(docs, known).join(known, "doc_id").where("held_out").collect()
    caught = [r["predicted"] for r in found if r["toxic"] == 1]
    wrong = [r["predicted"] for r in found if r["toxic"] == 0]
    assert sum(caught) / len(caught) > 0.7 and sum(wrong) / len(wrong) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    assert all(fold(r["doc_id"], 3) == 1 for r in found)


def test_held_out_labels_are_not_used(spark, tables):
    docs, known = tables
    flipped = known.withColumn("toxic", F.expr("if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic)"))
    assert rows(score_toxicity(docs, known), "doc_id", "score") == rows(score_toxicity(docs, flipped), "doc_id", "score")


def test_a_capped_sample_teaches_the_same_words(spark, tables):
    docs, known = tables
    whole, capped = (toxicity.learn_toxicity(docs, known, per_class=n) for n in (15_000, 20))
    assert set(whole.lexicon) - set(known_words()) and whole.lexicon == capped.lexicon
    found = [{r["doc_id"]: r["predicted"] for r in score_toxicity(docs, known, n).where("held_out").collect()} for n in (15_000, 20)]
    assert sum(found[0][i] == found[1][i] for i in found[0]) > 0.98 * len(found[0])


def test_prefix_counts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "COUNTED", 5)
    texts = [("abcd ab", 1), ("Abcd. abcd", 1), ("abc", 0), ("", 0), ("abce", 0)]
    counts = toxicity.prefix_counts(spark.createDataFrame(texts, "text string, y int"))
    assert {r["prefix"]: (r["toxic"], r["clean"]) for r in counts.collect()} == {
        "abc": (2, 2), "abcd": (2, 0), "abce": (0, 1), "ab$": (1, 0), "abcd$": (2, 0), "abc$": (0, 1), "abce$": (0, 1)
    }


def test_rare_insults_stand_beside_frequent_neutral_beginnings(spark):
    neutral = [(f"the{i}", 900, 9000) for i in range(50)]
    counts = spark.createDataFrame([*neutral, ("zork", 40, 1), ("idiot", 2, 500), ("zor", 3, 0)], "prefix string, toxic long, clean long")
    toxic, clean, tested = toxicity.candidate_counts(counts, (10_000, 1000), ["idiot", "moron"], limit=10)
    assert toxic == {"zork": 40, "idiot": 2} and clean == {"zork": 1, "idiot": 500} and tested == 51
    assert set(teach(toxic, clean, (10_000, 1000), tested)) == {"zork"}


def test_written_words_that_clean_texts_use_are_taken_out(spark):
    texts = [(i, f"word{i} trash can") for i in range(60)] + [(i, f"word{i} zorkig") for i in range(60, 120)]
    known = labels(spark, [(i, 1, int(i >= 60)) for i, _ in texts])
    lexicon = toxicity.learn_toxicity(spark.createDataFrame(texts, "doc_id long, text string"), known).lexicon
    assert "trash$" not in lexicon and "idiot" in lexicon and any(p.startswith("zork") for p in lexicon)


def test_toxicity_odd(spark, tables):
    for docs in (odd_documents(spark), documents(spark, 1, clash=True), empty(spark)):
        for known in (labels(spark, [(None, 1, 1), (7, None, None), (8, 0, 1), (8, 1, 0), (999, 1, 1)]), spark.createDataFrame([], NO_LABELS)):
            found = score_toxicity(docs, known)
            assert [r[0] for r in rows(found, "doc_id")] == [r[0] for r in rows(docs, "doc_id")]
            assert found.where("score is null or score < 0 or score > 1").count() == 0
    insult = spark.createDataFrame([(1, "You are a stupid idiot. Scum!"), (2, "You are kind.")], "doc_id long, text string")
    assert rows(score_toxicity(insult, spark.createDataFrame([], NO_LABELS)), "doc_id", "predicted") == [(1, 1), (2, 0)]


# --- quality


def test_statistics_of_odd_texts():
    for text in (b"", b" ", b"\n\n", b"a", "é!".encode()):
        found = dict(zip(STATS, statistics(text)))
        assert all(math.isfinite(v) for v in found.values())
        assert found["n_words"] == len(text.split())
    found = dict(zip(STATS, statistics(b"aa aa aa Bb. 12 |\naa aa aa Bb. 12 |")))
    assert (found["n_words"], found["unique_lines"], found["longest_word"]) == (12, 0.5, 3)
    assert found["same_neighbours"] == 4 / 12 and found["unique_words"] == 4 / 12


def test_rules_say_the_same_in_numpy_and_in_spark(spark):
    rng = np.random.default_rng(3)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] <= 0.7)).astype(float)
    model = fit_rules(x, y, np.ones(600), ["n_words", "mean_word", "bar_share"])
    assert 0 < len(model.rules) < 60
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "n_words double, mean_word double, bar_share double")
    found = df.select(model.score().alias("s"), *df.columns).collect()
    for r in found[:100]:
        total = model.intercept + sum(w for rule, w in model.rules if all((r[s] <= t) == (op == "<=") for s, op, t in rule))
        assert abs(r["s"] - 1 / (1 + math.exp(-total))) < 1e-9
    right = sum((r["s"] >= 0.5) == (r["n_words"] > 0.6 and r["mean_word"] <= 0.7) for r in found)
    assert right > 585


def test_lasso_drops_what_says_nothing():
    rng = np.random.default_rng(4)
    r = (rng.random((4000, 20)) < 0.5).astype(float)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(3 * r[:, 0] - 1.5)))).astype(float)
    _, w = lasso_logistic(r, y, np.ones(4000), 0.02, 400)
    assert w[0] > 1 and (w[1:] == 0).all()


def test_paths_are_conjunctions():
    rng = np.random.default_rng(5)
    x = rng.random((500, 2))
    rules = tree_rules(x, (x[:, 0] + x[:, 1] > 1).astype(float), np.ones(500), ["a", "b"])
    assert max(map(len, rules)) == 3 and len(set(rules)) == len(rules)


def test_quality_held_out(spark, tables):
    docs, known = tables
    found = score_quality(docs, known).join(known, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) / len(found) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and fold(r["doc_id"], 5) == 0 for r in found)


def test_quality_odd(spark):
    for docs in (odd_documents(spark), documents(spark, 1, clash=True), empty(spark)):
        for known in (labels(spark, [(None, 1, 1), (7, None, None), (8, 0, 1), (8, 1, 0), (9, 0, 0)]), spark.createDataFrame([], NO_LABELS)):
            found = score_quality(docs, known)
            assert [r[0] for r in rows(found, "doc_id")] == [r[0] for r in rows(docs, "doc_id")]
            assert found.where("score is null or score < 0 or score > 1").count() == 0


# --- language model


def slow_tokens(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def slow_base(docs):
    counts = Counter(w for i, t in docs if fold(i, 5) != 1 for w in slow_tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in docs:
        ws = slow_tokens(t)
        score = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((i, fold(i, 5) == 1, len(ws), sum(counts[w] > 0 for w in ws), n, round(score, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("make", [lambda s: documents(s, 1), lambda s: documents(s, 2, clash=True), odd_documents])
def test_base_scores(spark, make):
    docs = make(spark)
    found = lm.score_documents(docs)
    got = [(*r[:5], round(r[5], 6)) for r in rows(found, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")]
    assert sorted(got, key=repr) == slow_base([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert found.where("score is null or score > 0 or isnan(score)").count() == 0


def test_rare_words_are_looked_up(spark):
    docs = documents(spark, 1)
    training = lm.fold("doc_id", 5) != 1
    whole, _ = lm.learn_and_score(docs, training, frequent=1000)
    few, _ = lm.learn_and_score(docs, training, frequent=5)
    wanted = [(i, k, round(b, 6)) for i, _, _, k, _, b in slow_base([tuple(r) for r in docs.collect()])]
    for found in (whole, few):
        got = [(r[0], r[1], round(r[2], 6)) for r in rows(found, "doc_id", "n_known", "base_score")]
        assert sorted(got, key=repr) == sorted(wanted, key=repr)


def slow_score(text, model, train):
    """Token by token: the class after its context, and the word in its class."""
    vocab, net = model.vocabulary, lm.LogBilinear(model.vocabulary.classes, model.parameters)
    own = {w: k for k, w in enumerate(vocab.words[: vocab.word_classes])}
    endings = {e: vocab.word_classes + k for k, e in enumerate(vocab.endings)}
    before, total = [vocab.classes, vocab.classes], 0.0
    for word in [*(w.encode() for w in slow_tokens(text)[:-1]), lm.END]:
        k = own.get(word, endings.get(word[-3:], vocab.classes - 1))
        hidden = net.d[0] * net.r[before[0]] + net.d[1] * net.r[before[1]]
        odds = np.exp(net.q @ hidden + net.b)
        total += math.log10(odds[k] / odds.sum())
        if k >= vocab.word_classes:
            total += math.log10((train[word] + 0.5) / (vocab.class_tokens[k] + 0.5 * (vocab.class_types[k] + 1)))
        before = [k, before[0]]
    return total


@pytest.mark.parametrize("frequent", [6, 1000])
def test_scores_token_by_token(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "WORD_CLASSES", 8)
    monkeypatch.setattr(lm, "ENDING_CLASSES", 5)
    docs = documents(spark, 6)
    found, model = lm.learn_and_score(docs, lm.fold("doc_id", 5) != 1, frequent=frequent)
    texts = dict(tuple(r) for r in docs.collect())
    train = Counter(w.encode() for i, t in texts.items() if fold(i, 5) != 1 for w in slow_tokens(t)[:-1])
    train[lm.END] = sum(fold(i, 5) != 1 for i in texts)
    for r in found.collect():
        assert r["score"] == pytest.approx(slow_score(texts[r["doc_id"]], model, train), rel=1e-9, abs=1e-9)


def test_held_out_texts_change_no_other_score(spark):
    scores = []
    for seed in (1, 2):
        rng = random.Random(seed)
        texts = [(i, sentence(random.Random(i), 30) if fold(i, 5) != 1 else " ".join(f"w{rng.randint(0, 9)}x" for _ in range(200))) for i in range(80)]
        docs = spark.createDataFrame(texts, "doc_id long, text string").repartitionByRange(2, "doc_id")
        found = lm.score_documents(docs).where("not held_out")
        scores.append(sorted((r["doc_id"], r["score"], r["base_score"]) for r in found.collect()))
    assert scores[0] == scores[1]


def test_model_beats_the_base_on_held_out_texts(spark, tables):
    found = lm.score_documents(tables[0]).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.avg(F.expr("int(score > base_score)"))).first()
    assert found[0] > found[1] and found[2] > 0.8


@given(st.integers(2, 12), st.integers(0, 10**6))
@settings(max_examples=25, deadline=None)
def test_probabilities_after_any_context_add_up_to_one(classes, seed):
    rng = np.random.default_rng(seed)
    model = lm.LogBilinear(classes, rng.normal(0, 2, (2 * classes + 3) * lm.DIMENSIONS + classes))
    contexts = rng.integers(0, (classes + 1) ** 2, 20)
    logs = model.log_probabilities(contexts)
    assert np.allclose(np.exp(logs).sum(1), 1)
    plain = model.hidden(contexts) @ model.q.T + model.b
    assert np.allclose(logs - logs[:, :1], plain - plain[:, :1])


def test_all_words_add_up_to_one():
    """Over all words and one unknown word a class, whatever the class probabilities."""
    vocab = lm.Vocabulary([b"a", b"b", b"c"], np.array([5, 3, 0]), [b"x", b"yy"], 30, 9)
    vocab.class_tokens, vocab.class_types = np.array([5.0, 3, 0, 12, 6, 4]), np.array([1.0, 1, 0, 4, 2, 1])
    within = (vocab.class_tokens + 0.5 * vocab.class_types + 0.5) / (vocab.class_tokens + 0.5 * (vocab.class_types + 1))
    assert np.allclose(within, 1)


def test_frequent_words_and_endings_have_vectors_of_their_own():
    words = [f"w{i}x{i % 7}".encode() for i in range(1000)]
    vocab = lm.Vocabulary(words, np.ones(1000), [f"e{i:02d}".encode() for i in range(lm.ENDING_CLASSES)], 1000, 1000)
    assert vocab.class_of[:320].tolist() == list(range(320)) and vocab.classes == 320 + 192 + 1
    assert lm.LogBilinear.initial(np.ones(vocab.classes)).q.shape == (513, 24) and lm.NOISE == 32


def test_a_step_follows_the_gradient_of_each_event():
    """One minibatch against sums event by event."""
    rng = np.random.default_rng(8)
    k, n = 5, 40
    counts = rng.integers(1, 50, k).astype(float)
    contexts, targets, weights = rng.integers(0, (k + 1) ** 2, n), rng.integers(0, k, n), rng.random(n)
    noise = counts / counts.sum()
    model = lm.LogBilinear(k, rng.normal(0, 1, (2 * k + 3) * lm.DIMENSIONS + k))
    before = lm.LogBilinear(k, model.flat.copy())
    model.train(contexts, targets, weights, np.zeros(len(model.flat)), noise, np.random.default_rng(9))
    draws = np.random.default_rng(9)
    draws.permutation(np.arange(1))
    drawn = np.minimum(np.searchsorted(np.cumsum(noise), draws.random(lm.NOISE) * np.cumsum(noise)[-1]), k - 1)
    g = lm.LogBilinear(k, np.zeros(len(model.flat)))
    for c, t, w in zip(contexts, targets, weights / weights.sum()):
        c1, c2 = divmod(c, k + 1)
        h = before.d[0] * before.r[c1] + before.d[1] * before.r[c2]
        for place, sign in ((t, 1), *((x, -1) for x in drawn)):
            excess = h @ before.q[place] + before.b[place] - np.log(lm.NOISE * noise[place])
            up = sign * w / (1 + np.exp(sign * excess))
            g.q[place] += up * h
            g.b[place] += up
            g.r[c1] += up * before.d[0] * before.q[place]
            g.r[c2] += up * before.d[1] * before.q[place]
            g.d[0] += up * before.r[c1] * before.q[place]
            g.d[1] += up * before.r[c2] * before.q[place]
    assert np.allclose(model.flat - before.flat, lm.RATE * g.flat / np.sqrt(g.flat**2 + 1e-10))


def test_noise_contrast_finds_the_probabilities():
    """Words that only depend on the word before: the model comes close to their frequencies."""
    rng = np.random.default_rng(6)
    k = 6
    table = rng.dirichlet(np.ones(k) * 0.5, k + 1)
    before = rng.integers(0, k, 60_000)
    came = np.array([rng.choice(k, p=table[b]) for b in before])
    counts = np.bincount(came, minlength=k).astype(float)
    model = lm.LogBilinear.initial(counts)
    contexts = before * (k + 1) + rng.integers(0, k, len(before))
    for seed in range(3):
        model.train(contexts, came, np.ones(len(came)), np.full(len(model.flat), 1e-4), counts / counts.sum(), np.random.default_rng(seed))
    logs = model.log_probabilities(contexts)[np.arange(len(came)), came].mean()
    best = np.log(table[before, came]).mean()
    plain = np.log(counts / counts.sum())[came].mean()
    assert logs > plain + 0.8 * (best - plain)


def test_scores_of_nothing(spark):
    assert lm.score_documents(empty(spark)).collect() == []
    none_to_train = spark.createDataFrame([(i, "a b") for i in range(60) if fold(i, 5) == 1], "doc_id long, text string")
    found = lm.score_documents(none_to_train).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in found)
    assert all(abs(r["base_score"] - 0.0) < 1e-9 for r in found)


def test_toxicity_needs_no_sample_of_both_classes(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_PER_CLASS", 3)
    docs = documents(spark, 1)
    known = labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(40)])
    assert toxicity.learn_toxicity(docs, known, per_class=3).coefficients


def test_equal_texts_with_different_labels(spark):
    """The order of rows changes no score, and no sampled row is lost."""
    rng = random.Random(21)
    texts = [sentence(rng, 8) + (" bogus fool" if k % 3 == 0 else "") for k in range(60)]
    rows = [(i, texts[i % 60], int(i % 3 == 0 or i % 7 == 0)) for i in range(240)]
    known = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    scores = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([r[:2] for r in order], "doc_id long, text string").coalesce(1)
        scores.append(sorted((r["doc_id"], round(r["score"], 12)) for r in score_toxicity(docs, known).collect()))
    assert scores[0] == scores[1]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    taught = toxicity.different_texts(docs, toxicity.known_labels(known, "toxic", toxicity.FOLDS, toxicity.HELD_OUT)).collect()
    learnt = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    assert len(taught) == len({t for _, t, _ in learnt})
    for r in taught:
        same = [(i, y) for i, t, y in learnt if t == r["text"]]
        assert (r["doc_id"], r["y"]) == (min(same)[0], int(2 * sum(y for _, y in same) >= len(same)))
