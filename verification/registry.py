"""Collects queries and their SQL. Results leave in types every engine shares: text for dates, double for decimals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from questmart.sources.star_tables import ansi_ctes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_CTES = ansi_ctes()


def portable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, roles: tuple[str, ...] = ()):
    """Register a query; ``roles`` names the bronze roles its SQL reads."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(build(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_roles(sql, *roles)
        return build

    return register


def with_roles(sql: str, *roles: str) -> str:
    # ``events`` is a given table as well, so the derived one is named apart.
    parts = [f"{'events_role' if role == 'events' else role} AS ({_CTES[role]})" for role in roles]
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
