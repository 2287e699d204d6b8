"""Statistics of whole texts that say something about their quality."""

from __future__ import annotations

from operator import eq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATS = [
    "n_words",
    "mean_word",
    "upper_share",
    "digit_share",
    "sign_share",
    "bang_share",
    "bar_share",
    "point_share",
    "blank_share",
    "other_share",
    "unique_words",
    "same_neighbours",
    "second_neighbours",
    "unique_lines",
    "unique_sentences",
    "words_a_line",
    "words_a_sentence",
    "longest_word",
]

_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = b"0123456789"
_SIGNS = b"#$%&*+/<=>@\\^_`{}~"
_BLANKS = b" \t\n\x0b\x0c\r"
_HIGH = bytes(range(0x80, 0x100))


def statistics(text: bytes) -> tuple[float, ...]:
    """In the order of STATS. A text without words has zeros, and uniqueness 1."""
    size = len(text) or 1

    def share(chars: bytes) -> float:
        return (len(text) - len(text.translate(None, chars))) / size

    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x]
    sentences = [x for x in text.replace(b"\n", b" ").split(b". ") if x]
    return (
        float(n),
        sum(map(len, words)) / n if n else 0.0,
        share(_UPPER),
        share(_DIGITS),
        share(_SIGNS),
        share(b"!"),
        share(b"|"),
        share(b".,;:?"),
        share(_BLANKS),
        share(_HIGH),
        len(set(words)) / n if n else 1.0,
        sum(map(eq, words, words[1:])) / n if n else 0.0,
        sum(map(eq, words, words[2:])) / n if n else 0.0,
        len(set(lines)) / len(lines) if lines else 1.0,
        len(set(sentences)) / len(sentences) if sentences else 1.0,
        n / len(lines) if lines else 0.0,
        n / len(sentences) if sentences else 0.0,
        float(max(map(len, words))) if n else 0.0,
    )


def text_stats(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row's whole text; null texts are empty."""

    def run(batches):
        for batch in batches:
            rows = [statistics(x.as_buffer().to_pybytes()) for x in batch["text"]]
            columns = list(zip(*rows)) or [()] * len(STATS)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(c, pa.float64()) for c in columns]], ["doc_id", *STATS]
            )

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(run, ", ".join([f"doc_id {doc_type}", *[f"{s} double" for s in STATS]]))
