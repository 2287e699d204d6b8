"""Token pieces against the tokenizer itself, and plans that waste nothing needless."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from awkward import documents, empty, odd_documents, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import word_ids
from footfall.llm.common import TEXT_BYTES, lean
from footfall.llm.packing import best_fit, exact_patterns, fitted_plan, fitted_repeats, pack, pack_plan, place_table, stage_pieces, tokenize_pieces
from footfall.llm.queries import TOKENIZER, packed_pieces
from footfall.llm.word_ids import WordIds

TOKENS = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def plain_ids(text) -> bytes:
    return np.asarray(TOKENS.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.fixture(scope="module")
def coder():
    return WordIds(TOKENIZER)


ODD = [
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>",
    "don't 's it's, 'T. WE'LL .,. a.., É.È, İstanbul İ. ΣΑΣ. ſ K, ﬁ ǅ ª º. a1b2. 3.14, ́a á שׁ x y z w \x85 q\x1cr \x1fs é.",
    "", "  ", "<|", "\x00", "東京。 한국어, 1२३", "a!!b $$$ x%%% (y) [z]. \"q\" it’s", "ÀÉ İ ı ẞ ß ﬀ",
]


def test_ids_are_the_tokenizers(coder):
    everything = ODD + [t or "" for t in texts(3)]
    for _ in range(2):  # once new, once from the cache
        assert coder.encode([t.encode() for t in everything]) == [plain_ids(t) for t in everything]


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcXYZ éÉßİ'.,!<|> \n\t5²"), st.characters(codec="utf-8")), max_size=40), max_size=6))
@settings(max_examples=200, deadline=None)
def test_any_text_has_the_tokenizers_ids(coder, texts):
    assert coder.encode([t.encode() for t in texts]) == [plain_ids(t) for t in texts]


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(word_ids, "CACHED_WORDS", 5)
    small = WordIds(TOKENIZER)
    everything = [t or "" for t in texts(2)]
    assert small.encode([t.encode() for t in everything]) == [plain_ids(t) for t in everything]


def test_runs_of_latin_letters_go_to_the_model_alone():
    """Normalising and cutting them cost more than the model itself."""
    coder = WordIds(TOKENIZER)
    letters = [chr(c) for c in range(0xC0, 0x250) if chr(c) not in "×÷İ"]
    asked = [*"abcxyz", "Hello", "ÉTÉ", *letters, *(a + "n" + b for a, b in zip(letters, reversed(letters)))]
    coder.tokenizer = None
    assert coder.encode([w.encode() for w in asked]) == [plain_ids(w) for w in asked]


def test_texts_are_handed_on_by_bytes(spark):
    """2,000 texts of 20 KB are not one batch."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["bytes"])

    docs = spark.range(0, 2_000, 1, 1).select(F.repeat(F.lit("abcd "), 4_000).alias("text"))
    assert stage_pieces(docs.mapInArrow(sizes, "bytes long")).agg(F.max("bytes")).first()[0] < 2 * TEXT_BYTES


def test_a_task_gives_back_what_it_has_freed():
    def held() -> int:
        with open("/proc/self/smaps_rollup") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("Anonymous:")) // 1024

    pinned = []

    @lean
    def run(batches):
        blocks = [bytes(60_000) for _ in range(3_000)]
        pinned.append(bytes(60_000))  # on top of the others, so the C library keeps them
        del blocks
        yield from batches

    before = held()
    assert list(run([1, 2])) == [1, 2]
    assert held() < before + 60


def check_plan(counts, plan, size):
    made = np.zeros(size + 1, np.int64)
    for contents, n in plan:
        assert n > 0 and sum(contents) <= size
        np.add.at(made, list(contents), n)
    assert (made == counts).all()


@given(st.lists(st.integers(0, 9), min_size=17, max_size=17), st.integers(1, 300))
@settings(max_examples=80, deadline=None)
def test_plans_hold_every_piece(counts, times):
    counts = np.array(counts) * times
    counts[0] = 0
    for plan in (pack_plan(counts, 16), best_fit(counts, 16)):
        check_plan(counts, plan, 16)
    # No plan beats the sum, and no sequences could simply be joined.
    total = int((counts * np.arange(17)).sum())
    made = sum(n for _, n in pack_plan(counts, 16))
    assert -(-total // 16) <= made <= sum(n for _, n in best_fit(counts, 16))


def test_patterns_fill_sequences_and_fit_the_histogram():
    patterns = exact_patterns([3, 5, 8, 10, 11, 13], 16)
    assert {(13, 3), (11, 5), (8, 8), (10, 3, 3), (5, 5, 3, 3)} <= set(patterns)
    assert all(sum(p) == 16 for p in patterns)
    counts = np.zeros(17, np.int64)
    counts[[13, 3, 11, 5]] = 1000, 1000, 500, 500
    repeats = dict(zip(patterns, fitted_repeats(patterns, counts)))
    assert repeats[13, 3] > 900 and repeats[11, 5] > 400
    assert sum(n for _, n in pack_plan(counts, 16)) == 1500


def test_uneven_lengths_are_packed_close_to_the_sum():
    rng = np.random.default_rng(2)
    counts = np.bincount(np.clip(rng.lognormal(5.8, 1.0, 60_000).astype(int), 1, 2048), minlength=2049)
    plan = pack_plan(counts)
    check_plan(counts, plan, 2048)
    least = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert sum(n for _, n in plan) <= 1.01 * least
    # Most sequences are fitted patterns, not the best fit of what these leave.
    left = counts.copy()
    left[2048] = 0
    assert 3 * sum(n for _, n in fitted_plan(left, 2048)) > 2 * (sum(n for _, n in plan) - counts[2048])
    assert sum(len(rows) for rows in place_table(plan).values()) < 60_000


def check_pieces(docs, found, size=2048):
    """Every token of every row is in its place once, and sequences have no gaps."""
    wanted = defaultdict(int)
    for _, text in docs:
        ids = plain_ids(text) + bytes(4)
        doc = _
        for k, at in enumerate(range(0, len(ids), 4 * size)):
            part = ids[at : at + 4 * size]
            wanted[doc, k, at // 4, len(part) // 4, zlib.crc32(part)] += 1
    for r in found:
        wanted[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] -= 1
    assert set(wanted.values()) <= {0}
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= size
    return len(places)


@pytest.mark.parametrize("make", [lambda s: documents(s, 1), lambda s: documents(s, 2, clash=True), odd_documents])
def test_pieces(spark, make):
    docs = make(spark)
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    n = check_pieces(pairs, packed_pieces(docs).collect())
    total = sum(len(plain_ids(t)) // 4 + 1 for _, t in pairs)
    assert n <= 1 + -(-total // 2048) * 1.1


def test_small_sequences_in_many_tasks(spark):
    docs = documents(spark, 5).repartition(7)
    pieces = tokenize_pieces(docs, TOKENIZER, size=64).withColumn("ids_crc32", F.crc32("ids"))
    found = pack(stage_pieces(pieces), size=64)
    assert "ids" in found.columns and "task" not in found.columns
    check_pieces([tuple(r) for r in docs.collect()], found.collect(), 64)


def test_nothing_to_pack(spark):
    assert packed_pieces(empty(spark)).collect() == []
