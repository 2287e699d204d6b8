"""The pipeline stage by stage against brute force, on a small corpus with planted cases."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from awkward import sentence
from test_llm_dedup import slow_lines, slow_links, slow_shingles
from test_llm_packing import check_pieces
from test_llm_search import slow_contamination

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    path = str(tmp_path_factory.mktemp("corpus"))
    line = sentence(rng, 15)
    items = [(k, sentence(rng, 25)) for k in range(4)]
    docs = []
    for i in range(60):
        text = "\n".join(sentence(rng, 30) for _ in range(3))
        if i % 5 == 0:
            text += ". You stupid idiot."
        if i % 6 == 1:
            text += "\n" + line
        if i % 10 == 2:
            text += " " + items[i % 4][1]
        docs.append(text)
    docs += [docs[3] + " again", docs[4].lower(), docs[7], None, "", "<|endoftext|>"]
    rows = [(i, t, "en", None, None if t is None else len(t)) for i, t in enumerate(docs)] + [(None, "no id", "en", "s", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, 1, int(i % 5 == 0)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, items


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark, corpus):
    path, items = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{path}/documents.parquet")

    clean = stages["toxicity"](spark, docs, path)
    assert clean.columns == COLUMNS
    assert {i for i, _ in pairs(docs)} - {i for i, _ in pairs(clean)} == {i for i in range(0, 60, 5)}

    lines = stages["line_dedup"](spark, clean, path)
    assert lines.columns == COLUMNS
    assert sorted(pairs(lines), key=repr) == sorted([r[:2] for r in slow_lines(pairs(clean))], key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    near = stages["jaccard_join"](spark, lines, path)
    assert near.columns == COLUMNS
    stay = sorted([i for i, _, c in slow_links(pairs(lines), 80, 100, 5) if i is None or c == i], key=repr)
    assert sorted([i for i, _ in pairs(near)], key=repr) == stay
    assert len(stay) < lines.count()

    kept = stages["decontamination"](spark, near, path)
    assert kept.columns == COLUMNS
    wanted = [r[0] for r in slow_contamination(pairs(near), items) if not r[4]]
    assert sorted([i for i, _ in pairs(kept)], key=repr) == sorted(wanted, key=repr)
    assert len(wanted) < len(stay)

    check_pieces(pairs(kept), stages["packing"](spark, kept, path).collect())


def test_run_goes_through_all_stages(spark, corpus):
    path, _ = corpus
    found = corpus_pipeline.run(spark, path)
    assert set(found.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    ids = {r["doc_id"] for r in found.collect()}
    assert ids and not ids & set(range(0, 60, 5))


def test_empty_tables_go_through(spark, corpus):
    path, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert docs.collect() == []


def test_near_copies_share_four_fifths_of_five_words(spark):
    """Pairs of 0.8 or more by shingles of five words that four words and 0.85 would let stay."""
    longer = [f"a{i}" for i in range(200)]
    changed = [f"b{i}" for i in range(1000)]
    other = [f"c{i}" for i in range(200)]
    texts = [
        longer,
        longer + [f"new{i}" for i in range(44)],  # 196 of 240
        changed,
        [f"new{i}" if i % 47 == 23 else w for i, w in enumerate(changed)],  # 21 words
        other,
        other + [f"new{i}" for i in range(50)],  # 196 of 246, less than 0.8
    ]
    sets = [slow_shingles(" ".join(t), 5) for t in texts]
    near = [5 * len(a & b) >= 4 * len(a | b) for a, b in zip(sets[::2], sets[1::2])]
    assert near == [True, True, False]
    docs = [(i, " ".join(t), "en", None, len(" ".join(t))) for i, t in enumerate(texts)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, table.repartition(2), "")
    assert sorted(i for i, _ in pairs(kept)) == [0, 2, 4, 5]


def test_near_copies_against_brute_force(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    sets = {r["doc_id"]: slow_shingles(r["text"], 5) for r in docs.where("doc_id is not null").collect()}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = {k: a if r == b else r for k, r in root.items()}
    kept = {i for i, _ in pairs(corpus_pipeline.drop_near_copies(spark, docs, ""))}
    assert kept == {i for i, r in root.items() if r == i} | {None}
    assert len(kept) < docs.count()


def some_documents(spark, rows):
    docs = [(i, t, "en", None, len(t)) for i, t in rows]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_rows_without_an_id_of_their_own_are_judged_each(spark, corpus):
    """A rejected row takes no other with it that has its id, or no id as it has none."""
    path, items = corpus
    rng = random.Random(12)
    clean = [sentence(rng, 40) for _ in range(4)]
    passage = items[0][1]
    docs = some_documents(spark, [(None, clean[0]), (None, passage), (7, clean[1]), (7, passage), (7, clean[1]), (8, clean[2]), (9, passage)])
    kept = corpus_pipeline.drop_contaminated(spark, docs, path)
    assert sorted(pairs(kept), key=repr) == sorted([(None, clean[0]), (7, clean[1]), (7, clean[1]), (8, clean[2])], key=repr)
    insult = "You stupid idiot."
    docs = some_documents(spark, [(None, clean[0]), (None, insult), (70, clean[1]), (70, insult)])
    kept = corpus_pipeline.drop_toxic(spark, docs, path)
    assert sorted(pairs(kept), key=repr) == sorted([(None, clean[0]), (70, clean[1])], key=repr)


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(13)
    text, other = sentence(rng, 60), sentence(rng, 60)
    docs = some_documents(spark, [(None, text), (None, text), (5, text + " more"), (None, other), (None, other), (6, "x"), (6, "x"), (7, "")])
    kept = sorted(pairs(corpus_pipeline.drop_near_copies(spark, docs, "")), key=repr)
    assert kept == sorted([(5, text + " more"), (None, other), (6, "x"), (7, "")], key=repr)


def test_keys(spark):
    docs = some_documents(spark, [(None, "a"), (None, "b"), (3, "c"), (3, "c"), (4, "d"), (-2, "e")])
    found = [(r["doc_id"], r["key"]) for r in corpus_pipeline.keyed(docs).collect()]
    assert {k for i, k in found if i in (4, -2)} == {4, -2} and len({k for _, k in found}) == 6
    assert all(k > 4 for i, k in found if i in (3, None))
