"""Extracts from relational databases through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# The driver class of each supported database.
DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.OracleDriver",
    "teradata": "com.teradata.jdbc.TeraDriver",
    "postgres": "org.postgresql.Driver",
    "db2": "com.ibm.db2.jcc.DB2Driver",
}


@dataclass(frozen=True)
class Slices:
    """How to read a query in parallel: equal ranges of a numeric or date column.

    The bounds only shape the ranges. Rows outside them, or with NULL, are read too.
    """

    column: str
    lower: str | int
    upper: str | int
    count: int


def driver_class(database_type: str) -> str:
    try:
        return DRIVERS[database_type.strip().lower()]
    except KeyError:
        raise ValueError(f"unsupported database type {database_type!r}") from None


def extract_query(
    database: str | None = None,
    table: str | None = None,
    history: bool = False,
    complete_query: str | None = None,
    condition: str | None = None,
) -> str:
    """The query of an extract.

    A history load takes the complete query if there is one, else the whole table. An incremental
    load takes the rows of the table under a condition; without one it takes the complete query.
    """
    whole = f"select * from {database}.{table}"
    if history:
        return complete_query or whole
    if condition:
        return f"{whole} where {condition}"
    if complete_query:
        return complete_query
    raise ValueError("an incremental extract needs a condition or a complete query")


def jdbc_options(
    database_type: str,
    url: str,
    query: str,
    user: str | None = None,
    password: str | None = None,
    slices: Slices | None = None,
    fetch_size: int = 10_000,
    tls: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for Spark's JDBC source.

    Without slices one task reads all, so large extracts should name some. ``tls`` (``location``,
    ``password``) is a trust store, used for db2 only.
    """
    options = {
        "driver": driver_class(database_type),
        "url": url,
        "pushDownPredicate": "true",
        "fetchsize": str(fetch_size),
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if slices is None:
        options["query"] = query
    else:
        options["dbtable"] = f"({query}) extract"
        options["partitionColumn"] = slices.column
        options["lowerBound"] = str(slices.lower)
        options["upperBound"] = str(slices.upper)
        options["numPartitions"] = str(slices.count)
    if tls and database_type.strip().lower() == "db2":
        options["sslConnection"] = "true"
        options["sslTrustStoreLocation"] = tls["location"]
        options["sslTrustStorePassword"] = tls["password"]
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A relation over a database query; takes the arguments of :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def bounds_query(query: str, column: str) -> str:
    """A query for the least and greatest value of a column of another query."""
    return f"select min({column}) as lower_bound, max({column}) as upper_bound from ({query}) bounds"


def read_sliced(spark: SparkSession, column: str, count: int, **options) -> DataFrame:
    """As :func:`read_jdbc`, in slices of a column between its bounds, for which the database is asked first."""
    lower, upper = read_jdbc(spark, **options | {"query": bounds_query(options["query"], column)}).first()
    if lower is None:
        return read_jdbc(spark, **options)
    return read_jdbc(spark, **options, slices=Slices(column, lower, upper, count))


def extract_rows(
    table: DataFrame, history: bool = False, condition: str | None = None
) -> DataFrame:
    """The same choice over a relation: all rows for history, else those under the condition.

    Spark pushes the condition into the scan where the source can test it.
    """
    if history:
        return table
    if not condition:
        raise ValueError("an incremental extract needs a condition")
    return table.where(condition)
