"""Output to a relational database that serves a dashboard.

Rows are written to a staging table over several connections, each with its own commits, and
then moved to the target in one transaction: readers see the old rows or the new ones. The
statements are plain SQL; none of this was run against a database, as none may be started
where it was written."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from footfall.operators.contract import require_not_null, require_schema

BATCH_ROWS = 1000


def serving_schema(contract: T.StructType) -> T.StructType:
    """The contract in the database's types: 32-bit counts and plain timestamps."""
    types = {T.LongType(): T.IntegerType(), T.TimestampNTZType(): T.TimestampType()}
    return T.StructType([T.StructField(f.name, types.get(f.dataType, f.dataType), False) for f in contract.fields])


def serving_columns(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns, cast for the database. A count too large for it fails the
    job instead of wrapping."""
    checked = require_not_null(df, contract)
    return checked.select(*[checked[f.name].cast(f.dataType).alias(f.name) for f in serving_schema(contract).fields])


def check_targets(spark: SparkSession, url: str, tables: Mapping[str, T.StructType], **extra: str) -> None:
    """Compare the database's tables with their contracts before a run. Reads their
    schemas only; an unreachable database or a missing table fails here as well. The
    surrogate key ``id``, which the database fills itself, may be there."""
    found = {}
    for table in tables:
        options = {"url": url, "dbtable": table, **extra}
        found[table] = spark.read.format("jdbc").options(**options).load().drop("id").schema
    require_schema(found, {table: serving_schema(contract) for table, contract in tables.items()})


def jdbc_options(url: str, table: str, connections: int = 8, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(BATCH_ROWS),
        # Emptying the table keeps its columns, keys and indexes.
        "truncate": "true",
        # Upper bound of parallel connections.
        "numPartitions": str(connections),
        **(extra or {}),
    }


def staging(table: str) -> str:
    return f"{table}_staging"


def write_jdbc(
    table_rows: DataFrame, contract: T.StructType, url: str, table: str, connections: int = 8, **extra: str
) -> None:
    """Full refresh of a database table: the executors write its staging table in batches,
    then one transaction replaces the target's rows with it.

    Pass rows read back from the Parquet table: the few connections then only limit a scan,
    not the aggregation. The staging table has the target's key, so that a task run again
    after a lost executor cannot add rows twice."""
    options = jdbc_options(url, staging(table), connections, extra)
    serving_columns(table_rows, contract).write.format("jdbc").mode("overwrite").options(**options).save()
    execute(table_rows.sparkSession, url, swap_statements(table, contract), **extra)


def swap_statements(table: str, contract: T.StructType) -> list[str]:
    columns = ", ".join(contract.names)
    return [
        f"DELETE FROM {table}",
        f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging(table)}",
        f"DELETE FROM {staging(table)}",
    ]


SQL_TYPES = {"string": "VARCHAR(255)", "timestamp": "TIMESTAMP", "date": "DATE", "int": "INTEGER"}


def create_statements(table: str, contract: T.StructType) -> list[str]:
    """The target and its staging table, where they are absent. The first two columns are the
    key: location with hour or date."""
    fields = [f"{f.name} {SQL_TYPES[f.dataType.simpleString()]} NOT NULL" for f in serving_schema(contract).fields]
    key = f"PRIMARY KEY ({', '.join(contract.names[:2])})"
    return [f"CREATE TABLE IF NOT EXISTS {name} ({', '.join([*fields, key])})" for name in (table, staging(table))]


def create_tables(spark: SparkSession, url: str, tables: Mapping[str, T.StructType], **extra: str) -> None:
    execute(spark, url, [x for table, contract in tables.items() for x in create_statements(table, contract)], **extra)


def execute(spark: SparkSession, url: str, statements: Iterable[str], driver: str | None = None, **login: str) -> None:
    """Run statements on the driver as one transaction. ``driver`` names the class to connect with; one
    that came with ``--jars`` is only found like that, as it is not on the driver manager's path."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for name, value in login.items():
        properties.setProperty(name, value)
    if driver:
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        found = jvm.java.lang.Class.forName(driver, True, loader).getDeclaredConstructor().newInstance()
        connection = found.connect(url, properties)
    else:
        connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().executeUpdate(statement)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def login_from(environment: Mapping[str, str]) -> dict[str, str]:
    """User, password and the driver's class, as far as the environment names them."""
    names = {"user": "FOOTFALL_JDBC_USER", "password": "FOOTFALL_JDBC_PASSWORD", "driver": "FOOTFALL_JDBC_DRIVER"}
    return {option: environment[name] for option, name in names.items() if name in environment}
