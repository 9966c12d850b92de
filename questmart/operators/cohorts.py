"""Cohort return counts at fixed day offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Days after signup at which a cohort is looked at.
DAY_OFFSETS = [0, 1, 7, 14, 21, 28, 35, 42, 49, 56, 63, 70, 77, 85]


def returns_by_cohort(cohorts: DataFrame, keys: list[str], signup_day: str, sessions: DataFrame) -> DataFrame:
    """Accounts of a cohort active exactly n days after signup, one column per offset.

    Accounts meet their distinct active days on account_id alone; the offset is then a subtraction, so nothing is
    multiplied by the number of offsets. An offset after the last session day is NULL, one nobody reached is 0.
    """
    active = sessions.select(F.col("account_id").alias("active_account"), F.to_date("session_start").alias("active_day")).distinct()
    last_day = sessions.select(F.max(F.to_date("session_start")).alias("last_day")).scalar()
    offset = F.datediff("active_day", signup_day)
    met = cohorts.join(
        active,
        (F.col("account_id") == F.col("active_account")) & offset.isin(DAY_OFFSETS),
        "left",
    ).withColumn("day_offset", offset)

    def reached(n: int) -> Column:
        return F.when(F.date_add(signup_day, n) <= F.col("last_day"), F.col(f"at_{n}"))

    counted = met.groupBy(*keys).agg(*[F.count_if(F.col("day_offset") == n).alias(f"at_{n}") for n in DAY_OFFSETS])
    counted = counted.withColumn("last_day", last_day)
    names = {n: f"day_{n}_return" if n else "day_0" for n in DAY_OFFSETS}
    return counted.select(*keys, *[reached(n).alias(names[n]) for n in DAY_OFFSETS])
