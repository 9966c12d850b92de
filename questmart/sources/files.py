"""Loading and writing tables."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from questmart.schemas import FILLED_ON_LOAD, SCHEMAS

MODES = {"replace": "overwrite", "append": "append"}


def _mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, known are {sorted(MODES)}")
    return MODES[mode]


def read_csv_table(spark: SparkSession, path: str, table: str, multi_line: bool = True) -> DataFrame:
    """CSV with header. Columns are matched by name and cast to the declared schema; an unreadable cell is NULL.

    With ``multi_line`` cells may hold line breaks, but each file is one task, however large. Without it files are split
    and read in parallel; use it for large files whose cells have no line breaks.

    Columns that the load step fills may be absent. A table without declared schema is read with inferred types.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if table not in SCHEMAS:
        return reader.option("inferSchema", True).csv(path)
    text = reader.csv(path)
    fields = [field.split(" ", 1) for field in SCHEMAS[table].split(", ")]
    optional = FILLED_ON_LOAD.get(table)
    return text.select(
        *[F.col(name).try_cast(kind).alias(name) for name, kind in fields if name != optional or name in text.columns]
    )


def clustered(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows ranged and sorted by ``keys``, then ``order``: a folder gets as many files as its size asks for, not one from
    every task, and files cover separate ranges, so that readers skip files and row groups by their bounds."""
    columns = [*keys, *[c for c in order if c not in keys]]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns) if order else df


def save_table(
    df: DataFrame, database: str, table: str, mode: str = "replace", partition_by: Iterable[str] = (), order: Iterable[str] = ()
) -> None:
    """Writes a managed parquet table; appends match columns by name. With ``order`` files are clustered and sorted by it.

    A table that is replaced stays readable until the new one is whole: that is written beside it and then takes its name. A
    failed write leaves the old table as it was and nothing beside it.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    if _mode(mode) == "append" and spark.catalog.tableExists(name):
        df = df.select(*spark.table(name).columns)
    keys = list(partition_by)
    writer = clustered(df, keys, list(order)).write.format("parquet")
    writer = writer.partitionBy(*keys) if keys else writer
    if not (mode == "replace" and spark.catalog.tableExists(name)):
        writer.mode(_mode(mode)).saveAsTable(name)
        return
    mark = uuid.uuid4().hex
    beside, old = f"{name}__new_{mark}", f"{name}__old_{mark}"
    try:
        writer.saveAsTable(beside)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        raise
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    spark.sql(f"DROP TABLE {old}")


def load_csv_tables(
    spark: SparkSession, database: str, paths: Mapping[str, str], mode: str = "replace", multi_line: bool = True
) -> list[str]:
    """Loads one CSV file or folder per table name, in name order."""
    for table in sorted(paths):
        save_table(read_csv_table(spark, paths[table], table, multi_line), database, table, mode)
    return sorted(paths)


def list_csv_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """CSV tables of a folder by name: files ``<table>.csv``, or folders ``<table>`` of such files as Spark writes them.

    The folder may be on any file system Spark can list. A folder without tables is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    parts = F.split("path", "/")
    name, above = F.element_at(parts, -1), F.element_at(parts, -2)
    is_part = name.startswith("part-")
    table = F.when(is_part, above).otherwise(F.regexp_replace(name, r"\.csv$", ""))
    place = F.when(is_part, F.regexp_replace("path", r"/[^/]*$", "")).otherwise(F.col("path"))
    # One row per table, however many files it has.
    found = {row.table: row.place for row in files.load(folder).select(table.alias("table"), place.alias("place")).distinct().collect()}
    if not found:
        raise ValueError(f"no CSV tables in {folder}")
    return found


def as_frame(spark: SparkSession, table: str, rows: object) -> DataFrame:
    """In-memory rows or a pandas frame by the declared schema; columns that the load step fills may be absent.

    Rows are dicts (missing keys are NULL) or tuples in the order of the schema. Cells become what their column declares:
    dicts and lists JSON text, ids text, dates and times as such or read from ISO text, NaN and NaT NULL.
    """
    if isinstance(rows, DataFrame):
        return rows
    fields = [f.split(" ", 1) for f in SCHEMAS[table].split(", ")]
    optional = FILLED_ON_LOAD.get(table)
    if hasattr(rows, "columns"):
        rows = [dict(zip(rows.columns, values)) for values in rows.itertuples(index=False, name=None)]
    rows = list(rows)
    if rows and isinstance(rows[0], Mapping):
        present = {name for row in rows for name in row}
        fields = [(name, kind) for name, kind in fields if name != optional or name in present]
        cells = [[row.get(name) for name, _ in fields] for row in rows]
    else:
        cells = [list(row) for row in rows]
        if cells and len(cells[0]) == len(fields) - 1:
            fields = [(name, kind) for name, kind in fields if name != optional]
    typed = [tuple(cell(value, kind) for value, (_, kind) in zip(row, fields, strict=True)) for row in cells]
    return spark.createDataFrame(typed, ", ".join(f"{name} {kind}" for name, kind in fields))


def _plain(value: object) -> object:
    """What JSON has no form for: sets as lists, everything else as text, times in ISO form."""
    if isinstance(value, (set, frozenset)):
        return sorted(value, key=str)
    if hasattr(value, "tolist"):
        return value.tolist()
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


def cell(value: object, kind: str) -> object:
    """One in-memory value as a column of the declared type holds it."""
    if value is None or value != value or str(value) in ("NaT", "<NA>"):
        return None
    if hasattr(value, "tolist"):
        # Numbers and arrays of numpy.
        value = value.tolist()
    if kind == "STRING":
        if isinstance(value, str):
            return value
        if isinstance(value, (Mapping, list, tuple, set, frozenset)):
            value = dict(value) if isinstance(value, Mapping) else _plain(value) if isinstance(value, (set, frozenset)) else value
            return json.dumps(value, ensure_ascii=False, default=_plain)
        return value.isoformat(" ") if isinstance(value, dt.datetime) else str(value)
    if kind in ("TIMESTAMP", "DATE"):
        if isinstance(value, str):
            value = dt.datetime.fromisoformat(value)
        if hasattr(value, "to_pydatetime"):
            value = value.to_pydatetime()
        if kind == "DATE" and isinstance(value, dt.datetime):
            return value.date()
        if kind == "TIMESTAMP" and not isinstance(value, dt.datetime):
            return dt.datetime(value.year, value.month, value.day)
        return value
    if kind == "BOOLEAN":
        return bool(value)
    return float(value) if kind == "DOUBLE" else int(value)


def load_frames(spark: SparkSession, database: str, frames: Mapping[str, object], mode: str = "replace") -> list[str]:
    """Loads in-memory rows or pandas frames by the declared schemas."""
    for table, rows in frames.items():
        save_table(normalize(as_frame(spark, table, rows)), database, table, mode)
    return list(frames)


def normalize(df: DataFrame) -> DataFrame:
    """Flat columns for files: nested values become JSON text, NaN becomes NULL."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(column)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def write_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv", sample_rows: int | None = None) -> dict[str, str]:
    """Writes each table as CSV (header, empty text for NULL) or parquet, with an optional first-rows sample beside it."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"tables can be written as csv or parquet, not as {fmt!r}")
    written = {}
    for name, df in tables.items():
        flat = normalize(df)
        written[name] = f"{folder}/{name}"
        write_one(flat, written[name], fmt)
        if sample_rows:
            write_one(flat.limit(sample_rows), f"{folder}/{name}_sample", fmt)
    return written


def write_one(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", "").csv(path)
    else:
        writer.parquet(path)


def write_chronological(df: DataFrame, path: str, order: list[str], fmt: str = "parquet") -> None:
    """Files in time order: range partitions, each sorted, written without a single-task sort."""
    write_one(df.repartitionByRange(*order).sortWithinPartitions(*order), path, fmt)


def export_csv(spark: SparkSession, table: str, path: str) -> None:
    write_one(normalize(spark.table(table)), path, "csv")


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
