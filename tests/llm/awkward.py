"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu Nu Xi Omikron pi rho été Straße 東京".split()

#: Names that the operators use inside themselves.
CLASHES = "key tag hash hashes row lost lines row_no text_hash n_dropped n_lines task nth words spans y weight".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def texts(seed: int = 1, n: int = 40) -> list[str | None]:
    """Copies, near copies, shared lines and odd ones."""
    rng = random.Random(seed)
    shared = [sentence(rng, 14) for _ in range(3)]
    out: list[str | None] = [None, "", " ", "\n", "\n\n", "\t a \r\n", "x", "\x00", "a b", "A  B\n", "a b"]
    base = [sentence(rng, rng.randint(1, 60)) for _ in range(n)]
    for text in base:
        out.append(text)
        kind = rng.random()
        if kind < 0.2:
            out.append(text)
        elif kind < 0.4:
            out.append(text.upper().replace(" ", "  ", 3))
        elif kind < 0.7:
            words = text.split()
            words[rng.randrange(len(words))] = rng.choice(WORDS)
            out.append(" ".join(words))
        elif kind < 0.9:
            out.append("\n".join([text, *rng.sample(shared, 2), "", text]))
    out.append("\n".join(sentence(rng, 12) for _ in range(400)))
    return out


def documents(spark: SparkSession, seed: int = 1, clash: bool = False) -> DataFrame:
    rows = list(enumerate(texts(seed)))
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if clash:
        for name in CLASHES:
            df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df


def odd_documents(spark: SparkSession) -> DataFrame:
    """Null ids, and rows that repeat."""
    line = "the same long line of more than forty code points, in each of them"
    rows = [(None, line), (None, line), (None, None), (7, line), (7, line), (8, line + "\nshort"), (9, line), (10, line.upper())]
    return spark.createDataFrame(rows + [(11, ""), (11, "")], "doc_id long, text string")


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string")


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
