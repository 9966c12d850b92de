"""The bronze load: files or frames in, typed and filled tables out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questmart.schemas import DAY_COLUMNS, FILLED_ON_LOAD
from questmart.sources.files import as_frame, list_csv_tables, load_csv_tables, normalize, read_csv_table, save_table
from questmart.sources.health import FILLS
from questmart.sources.rates import exchange_rate

# Marts filter events by type and facts by day, so types and days become directories; files follow time and id inside.
PARTITIONED_BY = {"events": ["event_type", "event_day"], "sessions": ["session_day"]}
ORDERED_BY = {"events": ["event_date", "event_id"], "sessions": ["session_start", "session_id"], "hosted_ad_interactions": ["interaction_time", "interaction_id"]}


def _highest_id(spark: SparkSession, database: str, table: str, mode: str) -> int:
    column, name = FILLED_ON_LOAD.get(table, ""), f"{database}.{table}"
    if mode != "append" or not column.endswith("_id") or not spark.catalog.tableExists(name):
        return 0
    return spark.table(name).agg(F.max(column)).first()[0] or 0


def with_day(df: DataFrame, table: str) -> DataFrame:
    """The table with the day its folders are named by; a missing time has a folder of its own."""
    for time, day in DAY_COLUMNS.items():
        if day in PARTITIONED_BY.get(table, ()):
            df = df.withColumn(day, F.to_date(time))
    return df


def load_bronze(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    database: str = "bronze",
    mode: str = "replace",
) -> list[str]:
    """Fills and stores typed tables. Fills run before the one write of a table, not as updates after it."""
    for name in sorted(tables):
        df = normalize(tables[name])
        if name in FILLS:
            df = FILLS[name](df, after=_highest_id(spark, database, name, mode))
        save_table(with_day(df, name), database, name, mode, PARTITIONED_BY.get(name, ()), ORDERED_BY.get(name, ()))
    return sorted(tables)


def bootstrap_bronze(
    spark: SparkSession,
    folder: str | None = None,
    frames: Mapping[str, object] | None = None,
    external_folder: str | None = None,
    database: str = "bronze",
    mode: str = "replace",
    multi_line: bool = True,
) -> list[str]:
    """Loads the main tables from a CSV folder or from frames (Spark, pandas or rows), then the reference tables (always replaced).

    ``multi_line``: see ``read_csv_table``. Without an external folder the built-in exchange rates are stored.
    """
    if frames is None:
        if folder is None:
            raise ValueError("give a folder of CSV files or frames")
        frames = {name: read_csv_table(spark, path, name, multi_line) for name, path in list_csv_tables(spark, folder).items()}
    frames = {name: as_frame(spark, name, rows) for name, rows in frames.items()}
    loaded = load_bronze(spark, frames, database, mode)
    if external_folder is None:
        save_table(exchange_rate(spark), database, "exchange_rate")
        return [*loaded, "exchange_rate"]
    return [*loaded, *load_csv_tables(spark, database, list_csv_tables(spark, external_folder), multi_line=multi_line)]
