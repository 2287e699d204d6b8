"""Compares a Spark result with a DuckDB result: column names, types and all values."""

from __future__ import annotations

import glob
import os

import duckdb

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = con.sql(sql)
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    found = []
    if spark_types != duck_types:
        found.append(f"types {spark_types} / {duck_types}")
    if set(spark_types) != set(duck_types):
        return found
    names = sorted(spark_types)
    spark_rows = _ordered([tuple(row[n] for n in names) for row in df.collect()])
    duck_rows = _ordered(con.sql(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({sql})").fetchall())
    if len(spark_rows) != len(duck_rows):
        found.append(f"rows {len(spark_rows)} / {len(duck_rows)}")
    unequal = [(a, b) for a, b in zip(spark_rows, duck_rows) if a != b]
    if unequal:
        found.append(f"{len(unequal)} unequal, first {unequal[0]}")
    return found
