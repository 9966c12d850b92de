"""Distinct entities at several calendar grains from one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Grain name -> start of the period that holds a day.
PERIOD_START = {
    "weekly": lambda day: F.to_date(F.date_trunc("week", day)),
    "monthly": lambda day: F.to_date(F.date_trunc("month", day)),
}


def distinct_by_grain(
    df: DataFrame, keys: list[str], day: str, entities: dict[str, str], measures: dict[str, Column]
) -> DataFrame:
    """Per key and day: sums of ``measures`` and distinct ``entities`` of the day, its week, its month and overall.

    Distinct counts do not add up over days, so every (key, entity) is flagged on the first day it is seen in each
    period; the flags do add up. Rows are first reduced to one per (key, entity, day), so a hot key or a hot entity
    holds at most one row per day afterwards, and the input is read once for all grains and entities.

    ``entities`` maps an output prefix to a column; ``measures`` maps a name to a numeric column, added up per day.
    """
    first, *rest = entities
    pairs = F.explode(
        F.array(*[F.struct(F.lit(name).alias("kind"), F.col(col).cast("string").alias("entity")) for name, col in entities.items()])
    )
    own = {name: F.when(F.col("p.kind") == first, F.col(name)) for name in measures}
    seen = (
        df.select(*keys, day, *[column.alias(name) for name, column in measures.items()], pairs.alias("p"))
        .groupBy(*keys, "p.kind", "p.entity", day)
        .agg(*[F.sum(column).alias(name) for name, column in own.items()], F.count("*").alias("rows"))
    )
    previous = F.lag(day).over(Window.partitionBy(*keys, "kind", "entity").orderBy(day))
    flagged = seen.withColumn("previous_day", previous)
    known = F.col("entity").isNotNull()
    never_before = F.col("previous_day").isNull()

    daily_aggs = [F.sum(name).alias(name) for name in measures]
    daily_aggs.append(F.sum(F.when(F.col("kind") == first, F.col("rows"))).alias("row_count"))
    for kind in entities:
        mine = (F.col("kind") == kind) & known
        daily_aggs.append(F.count_if(mine).alias(f"daily_{kind}"))
        for grain, start in PERIOD_START.items():
            new_here = never_before | (F.col("previous_day") < start(F.col(day)))
            daily_aggs.append(F.count_if(mine & new_here).alias(f"{grain}_{kind}"))
        daily_aggs.append(F.count_if(mine & never_before).alias(f"total_{kind}"))
    daily = flagged.groupBy(*keys, day).agg(*daily_aggs)

    out = [*keys, day, "row_count", *measures, *[f"daily_{kind}" for kind in entities]]
    for kind in entities:
        for grain, start in PERIOD_START.items():
            period = Window.partitionBy(*keys, start(F.col(day)))
            out.append(F.sum(f"{grain}_{kind}").over(period).alias(f"{grain}_{kind}"))
        out.append(F.sum(f"total_{kind}").over(Window.partitionBy(*keys)).alias(f"total_{kind}"))
    return daily.select(*out)
