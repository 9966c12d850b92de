"""Ordered operators that never put a whole order, or a hot key, into one task.

A global order is made by range partitions: rows are sorted, the sorted copy is staged in the shared folder so that
partition numbers and positions stay fixed if an executor is lost, and what has to pass from one partition to the
next (a count, a sum, the neighbouring row, the last value) is one small row per partition.

Keys take the same way: rows are ranged by key and order, so a key of any size spans as many partitions as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from questmart.session import stage

_POSITION_BITS = (1 << 33) - 1


def stage_sorted(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """Rows sorted globally, with ``_part`` (partition in order) and ``_pos`` (position in it).

    Rows alike in every order column are spread by a random last key, so copies cannot pile up in one partition.
    """
    spread = df.withColumn("_spread", F.rand(7))
    placed = (
        spread.repartitionByRange(*order, "_spread")
        .sortWithinPartitions(*order, "_spread")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)))
    )
    return stage(placed.drop("_spread"), label)


def _before_each_part(staged: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Sum of ``totals`` over all earlier partitions; one row per partition passes through the driver."""
    parts = staged.groupBy("_part").agg(*[column.alias(name) for name, column in totals.items()])
    rows, running = [], [0] * len(totals)
    for part in parts.orderBy("_part").collect():
        rows.append((part["_part"], *running))
        running = [total + (part[name] or 0) for total, name in zip(running, totals)]
    schema = "_part INT, " + ", ".join(f"_before_{name} BIGINT" for name in totals)
    return F.broadcast(staged.sparkSession.createDataFrame(rows, schema))


def assign_dense_ids(
    df: DataFrame, order: list[str], id_column: str, label: str = "ids", after: int = 0
) -> DataFrame:
    """Numbers rows after+1..after+n in the given order. An id that is already set is kept; where all are, nothing is sorted."""
    if id_column in df.columns and df.where(F.col(id_column).isNull()).isEmpty():
        return df
    staged = stage_sorted(df, order, label)
    numbered = staged.join(_before_each_part(staged, {"rows": F.count("*")}), "_part")
    number = F.col("_before_rows") + F.col("_pos") + (after + 1)
    if id_column in df.columns:
        number = F.coalesce(F.col(id_column), number)
    return numbered.withColumn(id_column, number).drop("_part", "_pos", "_before_rows")


def running_totals(df: DataFrame, order: list[str], columns: list[str], label: str = "running") -> DataFrame:
    """Adds ``<column>_before``: the sum over all rows earlier in the order. Integer columns only."""
    staged = stage_sorted(df, order, label)
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    joined = staged.join(_before_each_part(staged, {c: F.sum(c) for c in columns}), "_part")
    sums = [
        (F.col(f"_before_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_before") for c in columns
    ]
    return joined.select(*df.columns, *sums)


def _same_key(left: list[Column], right: list[Column]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & a.eqNullSafe(b)
    return condition


def with_next(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Adds ``next_<column>``: the value in the key's following row, NULL after the last one."""
    staged = stage_sorted(df.select(*df.columns), [*keys, *order], "next")
    heads = [row.asDict() for row in staged.where(F.col("_pos") == 0).select("_part", *keys, *columns).collect()]
    heads.sort(key=lambda row: row["_part"])
    types = {f.name: f.dataType.simpleString() for f in staged.schema}
    schema = ", ".join(
        ["_part INT", *[f"_head_{k} {types[k]}" for k in keys], *[f"_head_next_{c} {types[c]}" for c in columns]]
    )
    rows = [
        (before["_part"], *[head[k] for k in keys], *[head[c] for c in columns]) for before, head in zip(heads, heads[1:])
    ]
    # One row per partition.
    following = F.broadcast(df.sparkSession.createDataFrame(rows, schema))
    inside = Window.partitionBy("_part", *keys).orderBy("_pos")
    led = staged.withColumn("_inner", F.lead(F.lit(True)).over(inside))
    for c in columns:
        led = led.withColumn(f"_next_{c}", F.lead(c).over(inside))
    match = (led["_part"] == following["_part"]) & _same_key(
        [F.col(k) for k in keys], [F.col(f"_head_{k}") for k in keys]
    )
    joined = led.join(following, match, "left")
    nexts = [
        F.when(F.col("_inner"), F.col(f"_next_{c}")).otherwise(F.col(f"_head_next_{c}")).alias(f"next_{c}") for c in columns
    ]
    return joined.select(*df.columns, *nexts)


def with_last_seen(df: DataFrame, keys: list[str], order: list[str], marker: str) -> DataFrame:
    """Adds ``<marker>_now`` (last non-NULL marker up to the row) and ``<marker>_before`` (up to the row above)."""
    now, before = f"{marker}_now", f"{marker}_before"
    staged = stage_sorted(df, [*keys, *order], "last-seen")
    window = Window.partitionBy("_part", *keys).orderBy("_pos")
    inner = staged.select(
        "*",
        F.last(marker, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)).alias(now),
        F.last(marker, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1)).alias(before),
    )
    tails = inner.groupBy("_part").agg(F.max_by(F.struct(*keys, now), "_pos").alias("tail")).collect()
    carried, rows = None, []
    for part in sorted(tails, key=lambda row: row["_part"]):
        if carried is not None:
            rows.append((part["_part"], *carried))
        *key, value = part["tail"]
        if value is None and carried is not None and list(carried[:-1]) == key:
            value = carried[-1]
        carried = (*key, value)
    types = {f.name: f.dataType.simpleString() for f in inner.schema}
    schema = ", ".join(["_part INT", *[f"_in_{k} {types[k]}" for k in keys], f"_in_value {types[now]}"])
    # One row per partition.
    incoming = F.broadcast(df.sparkSession.createDataFrame(rows, schema))
    match = (inner["_part"] == incoming["_part"]) & _same_key(
        [F.col(k) for k in keys], [F.col(f"_in_{k}") for k in keys]
    )
    joined = inner.join(incoming, match, "left")
    return joined.select(
        *df.columns,
        F.coalesce(F.col(now), F.col("_in_value")).alias(now),
        F.coalesce(F.col(before), F.col("_in_value")).alias(before),
    )
