"""The operators as queries over whole tables, with the parameters they run with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import table
from footfall.llm.decontamination import contamination
from footfall.llm.exact_dedup import dedup_exact
from footfall.llm.jaccard_join import link_documents
from footfall.llm.line_dedup import dedup_lines
from footfall.llm.lexical_search import search
from footfall.llm.license_scan import scan_licenses
from footfall.llm.lm import score_documents
from footfall.llm.packing import pack, stage_pieces, tokenize_pieces
from footfall.llm.quality_rules import score_quality
from footfall.llm.toxicity import score_toxicity
from footfall.llm.url_filter import judge_urls, rule_table
from footfall.llm.warc import archive_pages, page_of
from footfall.llm.whitening import whiten

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The rules of op7, in order.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@_query
def op1_lm_scores(spark, sf_dir):
    scored = score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op2_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@_query
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, sf_dir, "labels"))


@_query
def op4_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


@_query
def op5_jaccard_join(spark, sf_dir):
    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op6_exact_dedup(spark, sf_dir):
    return dedup_exact(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op7_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rule_table(spark, URL_RULES)).drop("url")


@_query
def op8_warc(spark, sf_dir):
    found = archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )


@_query
def op9_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@_query
def op10_packing(spark, sf_dir):
    return packed_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op11_license_scan(spark, sf_dir):
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *listed, "score")


@_query
def op12_embedding_whitening(spark, sf_dir):
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


@_query
def op13_lexical_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    pieces = tokenize_pieces(docs, TOKENIZER).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = pack(stage_pieces(pieces))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
