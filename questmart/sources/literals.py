"""Small fixed tables as local relations: the planner knows their size and broadcasts them by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"


def literal_table(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """``columns`` maps names to types."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns.items())
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS fixed({', '.join(columns)})")
