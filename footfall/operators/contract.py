"""Check of the output tables against their contract."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.rows import literal_rows
from footfall.model import CONTRACTS

VIOLATION = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("column", T.StringType()),
        T.StructField("kind", T.StringType(), False),
        T.StructField("expected", T.StringType()),
        T.StructField("actual", T.StringType()),
        T.StructField("null_rows", T.LongType()),
    ]
)


class ContractError(RuntimeError):
    """Lists every violation, not just the first."""


def schema_violations(
    tables: Mapping[str, T.StructType | None], contracts: Mapping[str, T.StructType] = CONTRACTS
) -> list[tuple]:
    """Differences in names and types; compares schemas only, reads no data."""
    found: list[tuple] = []
    for table, contract in contracts.items():
        actual = tables.get(table)
        if actual is None:
            found.append((table, None, "missing_table", None, None, None))
            continue
        have = {f.name: f.dataType.simpleString() for f in actual.fields}
        want = {f.name: f.dataType.simpleString() for f in contract.fields}
        for column, expected in want.items():
            if column not in have:
                found.append((table, column, "missing_column", expected, None, None))
            elif have[column] != expected:
                found.append((table, column, "wrong_type", expected, have[column], None))
        found += [(table, c, "unexpected_column", None, have[c], None) for c in have if c not in want]
    return found


def require_schema(tables: Mapping[str, T.StructType | None], contracts=CONTRACTS) -> None:
    found = schema_violations(tables, contracts)
    if found:
        lines = [f"{t}.{c or '*'}: {kind}, expected {want}, found {have}" for t, c, kind, want, have, _ in found]
        raise ContractError("output contract broken:\n  " + "\n  ".join(lines))


def null_counts_of_contract(tables: Mapping[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """One row per contract column that a table has: table, column, null_rows. File
    tables do not enforce NOT NULL, so it has to be counted. One aggregate a table."""
    parts = [_null_counts(name, df, contracts[name]) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _null_counts(table: str, df: DataFrame, contract: T.StructType) -> DataFrame:
    columns = [c for c in contract.names if c in df.columns]
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    per_column = [F.struct(F.lit(c).alias("column"), F.col(c).alias("null_rows")) for c in columns]
    return counted.select(F.lit(table).alias("table"), F.inline(F.array(*per_column)))


def contract_violations(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], contracts=CONTRACTS
) -> DataFrame:
    """Every violation: missing tables and columns, wrong types, unexpected columns,
    and columns with nulls."""
    present = {name: df for name, df in tables.items() if df is not None and name in contracts}
    schemas = literal_rows(spark, schema_violations({n: d.schema for n, d in present.items()}, contracts), VIOLATION)
    if not present:
        return schemas
    nulls = null_counts_of_contract(present, contracts).where("null_rows > 0")
    return schemas.unionByName(
        nulls.select("table", "column", F.lit("null_value").alias("kind"), "null_rows"), allowMissingColumns=True
    )


def require_not_null(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns in its order. A null fails the job that writes them,
    so that it publishes nothing; the check needs no pass of its own."""

    def checked(column: str) -> Column:
        value = F.col(column)
        broken = F.raise_error(F.lit(f"null in column {column}, which must not have any"))
        return F.when(value.isNull(), broken).otherwise(value).alias(column)

    return df.select(*[checked(c) for c in contract.names])
