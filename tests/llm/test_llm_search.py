"""Benchmark passages, URL rules and archives against brute force and round trips."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re

import pyarrow as pa
import pytest
from awkward import documents, empty, odd_documents, rows, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import bloom, warc
from footfall.llm.bloom import blocks_for, bloom_filter, may_contain, split_by
from footfall.llm.decontamination import Search, contamination, words
from footfall.llm.url_filter import judge_urls, rule_table
from footfall.llm.warc import archive_pages, page_of, page_records, read_archives, write_archives

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def slow_contamination(docs, items):
    out = []
    for i, text in docs:
        ws, hit, ids = slow_words(text), set(), set()
        for item, passage in items:
            p = slow_words(passage)
            size = min(13, len(p))
            for k in range(len(p) - size + 1 if p else 0):
                for at in range(len(ws) - size + 1):
                    if ws[at : at + size] == p[k : k + size]:
                        hit.update(range(at, at + size))
                        ids |= {str(item)} if item is not None else set()
        out.append((i, len(ws), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=repr)


def benchmark(spark, docs):
    rng = random.Random(5)
    long = [t for _, t in docs if t and len(t.split()) > 20]
    items = [(k, " ".join(t.split()[2:18])) for k, t in enumerate(long[:6])]
    items += [(20, "alpha beta"), (21, "Alpha, BETA"), (22, ""), (23, None), (None, "gamma delta"), (3, items[3][1])]
    items += [(30 + k, sentence(rng, 30)) for k in range(3)] + [(40, long[7])]
    return items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("per_pass", [100_000, 40])
def test_contamination(spark, per_pass):
    docs = documents(spark, 1)
    pairs = [tuple(r) for r in docs.collect()]
    items, table = benchmark(spark, pairs)
    found = contamination(docs, table, per_pass=per_pass)
    assert rows(found, "doc_id", "n_words", "n_hit", "item_ids", "contaminated") == slow_contamination(pairs, items)
    assert found.where("n_items > 1").count() and found.where("not contaminated and n_hit > 0").count() >= 0


def test_contamination_odd(spark):
    docs = odd_documents(spark)
    items, table = benchmark(spark, [tuple(r) for r in documents(spark, 1).collect()])
    items += [(99, "same long line of more than forty code points in each of")]
    table = spark.createDataFrame(items, "item_id long, text string")
    wanted = slow_contamination([tuple(r) for r in docs.collect()], items)
    for per_pass in (100_000, 40):
        assert rows(contamination(docs, table, per_pass=per_pass), "doc_id", "n_words", "n_hit", "item_ids", "contaminated") == wanted
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).where("contaminated or n_hit > 0").count() == 0
    assert contamination(empty(spark), table).collect() == []
    clashing = documents(spark, 1, clash=True)
    assert contamination(clashing, table).count() == clashing.count()


@given(st.text("ab ", max_size=60), st.lists(st.text("ab ", min_size=1, max_size=14), min_size=1, max_size=5), st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_wu_manber_finds_what_comparing_finds(text, items, size):
    ws = words(text.encode())
    patterns = {tuple(p[i : i + size]) for p in (words(x.encode()) for x in items) for i in range(len(p) - size + 1)}
    if patterns:
        wanted = [(i + size, tuple(ws[i : i + size])) for i in range(len(ws) - size + 1) if tuple(ws[i : i + size]) in patterns]
        assert list(Search(patterns).ends(ws)) == wanted


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "bad.org/"), ("allow", "bad.org/ok")]
URLS = [
    "https://example.com/en/1", "http://WWW.Example.com/en/x?y=/fr/", "http://a.b.example.com/EN/", "http://example.com", "http://example.com?x/en/",
    "ftp://x.net/es/", "x.net/es/", "http://net/es/a#b", "http://xnet/es/", "http://bad.org/okay", "http://bad.org/o", "http://sub.bad.org/", "://com/", "a://b://com/",
    "http://user@example.com:80/en/", "", None, "http:///en/", "http://example.com/en/1", "http://example.com/\nen/", "http://é.com/ü",
]


def slow_verdict(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1].translate(LOWER), found[2]) if found else ("", "")
    fits = []
    for verdict, rule in RULES:
        cut = rule.index("/")
        if ("." + host).endswith("." + rule[:cut]) and path.startswith(rule[cut:]):
            fits.append((len(rule), rule, verdict))
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS + URLS[:3])] + [(None, URLS[0], "h", "r")], "page_id long, url string, host string, lengths string")
    found = rows(judge_urls(pages, rule_table(spark, RULES)), "page_id", "url", "host", "path", "rule", "verdict")
    wanted = [(i, u, *slow_verdict(u)) for i, u in enumerate(URLS + URLS[:3])] + [(None, URLS[0], *slow_verdict(URLS[0]))]
    assert found == sorted(wanted, key=repr)
    no_rules = spark.createDataFrame([], "verdict string, rule string")
    assert judge_urls(pages, no_rules).where("rule is not null or verdict <> 'allow'").count() == 0
    assert judge_urls(pages.limit(0), rule_table(spark, RULES)).collect() == []


def test_many_rules_and_ties(spark):
    rules = [("block", f"host{i}.example/p{i % 7}") for i in range(3000)] + [("allow", "host5.example/p5"), (None, "x/"), ("block", None)]
    pages = spark.createDataFrame([(i, f"http://a.host{i}.example/p{i % 5}/x") for i in range(4000)], "page_id long, url string")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(pages, rule_table(spark, rules)).collect()}
    for i in range(4000):
        listed = i < 3000 and i % 7 == i % 5
        assert found[i] == ((f"host{i}.example/p{i % 7}", "allow" if i == 5 else "block") if listed else (None, "allow"))


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(2000).selectExpr("concat('k', id) AS k")
    probes = spark.range(20_000).selectExpr("concat('k', id) AS k")
    blocks = blocks_for(2000)
    words_ = bloom_filter(keys, "k", blocks).scalar()
    passed = {r["k"] for r in probes.where(may_contain(words_, blocks, probes.k)).collect()}
    assert {f"k{i}" for i in range(2000)} <= passed and len(passed) < 2000 + 18_000 * 0.05


def test_splitting_by_a_filter_loses_nothing(spark, monkeypatch):
    rows_ = spark.createDataFrame([(None,), (1,), (2,), (2,), (500,)], "id long")
    for most in (bloom.MAX_BLOCKS, 16):
        monkeypatch.setattr(bloom, "MAX_BLOCKS", most)
        for listed in ([], [None], [2], list(range(400))):
            keys = spark.createDataFrame([(k,) for k in listed], "k long")
            maybe, others = ([r["id"] for r in part.collect()] for part in split_by(rows_, rows_.id, keys, "k"))
            assert sorted(map(str, maybe + others)) == ["1", "2", "2", "500", "None"]
            assert not set(others) & set(listed)


def pages(spark):
    html = ["<p>a</p>", "<p>a</p>", "", None, "x" * 300_000, "é東\r\n\r\nWARC/1.1\r\n", "<p>a</p>", "only"]
    listed = [(i, f"http://h/{i}\r\nX: y", h) for i, h in enumerate(html)] + [(None, None, "only"), (None, "u", "nobody"), (None, "u", "nobody"), (6, "u", "<p>a</p>")]
    return listed, spark.createDataFrame([(*r, "clash") for r in listed], "page_id long, url string, html string, key string").repartition(3)


def test_archives_round_trip(spark):
    listed, table = pages(spark)
    wanted = []
    for i, _, h in listed:
        same = [j for j, _, g in listed if (g or "") == (h or "") and j is not None]
        last = max(same, default=None)
        data = (h or "").encode()
        revisit = last is not None and i != last
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        wanted.append((i, len(data), digest, "revisit" if revisit else "response", last if revisit else None, None if revisit else data))
    found = archive_pages(table).select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"), "payload")
    got = [(*r[:5], None if r[5] is None else bytes(r[5])) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert archive_pages(table.limit(0)).collect() == []


def test_header_predicates_skip_payloads(spark, tmp_path, monkeypatch):
    _, table = pages(spark)
    path = f"file://{tmp_path}/archive"
    write_archives(page_records(table), path, split_bytes=200, file_bytes=1000)
    archive = read_archives(spark, path)
    assert archive.rdd.getNumPartitions() > 4
    wanted = archive.where("record_type = 'revisit' and target_uri like 'http://h/1%'")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan  # both predicates are decided by the source
    assert [r["record_id"] for r in wanted.collect()] == ["<urn:page:1>"]
    reader = warc.WarcReader({"path": path})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert len(left) == 1 and reader.tests
    monkeypatch.setattr(warc, "digest_of", lambda payload: pytest.fail("a payload was decoded"))
    found = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert found and {r["record_type"] for r in found} == {"revisit"}
    bare = warc.WarcReader({"path": path, "payloads": "false"})
    assert all(r["payload"] is None for p in bare.partitions() for b in bare.read(p) for r in b.to_pylist())


def test_foreign_archives(spark, tmp_path):
    """Files without manifest: plain, in one gzip member a record, and in other writers' members."""
    payload = b"<html>text</html>"
    http = b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\n" + payload
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(http) + http + b"\r\n\r\n"
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + record + record)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(record))
    (tmp_path / "notes.txt").write_text("no archive")
    found = read_archives(spark, str(tmp_path))
    assert found.count() == 5
    responses = found.where("record_type = 'response'").collect()
    assert [(bytes(r["payload"]), r["payload_bytes"]) for r in responses] == [(payload, len(payload))] * 3


def test_damaged_payloads_fail(spark, tmp_path):
    good = warc.record_bytes({"record_id": "<urn:page:1>", "record_type": "response", "target_uri": None, "date": "d", "refers_to": None, "payload": b"abcdef"})
    (tmp_path / "x.warc").write_bytes(good.replace(b"abcdef", b"abcdeX"))
    reader = warc.WarcReader({"path": str(tmp_path)})
    with pytest.raises(ValueError, match="not what its header states"):
        [list(reader.read(p)) for p in reader.partitions()]


def test_aborted_writes_leave_nothing_to_read(spark, tmp_path):
    writer = warc.WarcWriter({"path": str(tmp_path)})
    batch = pa.RecordBatch.from_pylist([{"record_id": "r", "record_type": "response", "target_uri": None, "date": "d", "refers_to": None, "payload": b"p"}])
    writer.commit([writer.write(iter([batch])), None])
    writer.write(iter([batch]))  # an attempt whose message never came
    writer.abort([writer.write(iter([batch])), None])
    reader = warc.WarcReader({"path": str(tmp_path)})
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 1
