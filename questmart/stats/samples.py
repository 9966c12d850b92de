"""What the tests need from the data, as aggregates. Samples never leave the executors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.operators.ordering import running_totals


@dataclass(frozen=True)
class Moments:
    n: int
    mean: float
    variance: float
    skewness: float
    kurtosis: float


NO_ROWS = Moments(0, float("nan"), float("nan"), float("nan"), float("nan"))


def group_moments(sample: DataFrame) -> DataFrame:
    """Count, mean, sample variance, skewness and excess kurtosis of (side, x); NULL x is left out."""
    return sample.where(F.col("x").isNotNull()).groupBy("side").agg(
        F.count("*").alias("n"),
        F.avg("x").alias("mean"),
        F.var_samp("x").alias("variance"),
        F.skewness("x").alias("skewness"),
        F.kurtosis("x").alias("kurtosis"),
    )


def collect_moments(sample: DataFrame) -> dict[str, Moments]:
    def number(value) -> float:
        return float("nan") if value is None else float(value)

    return {
        row["side"]: Moments(row["n"], *[number(row[k]) for k in ("mean", "variance", "skewness", "kurtosis")])
        for row in group_moments(sample).collect()
    }


def deviations(sample: DataFrame, means: dict[str, float]) -> DataFrame:
    """Absolute deviation of each value from its group's mean."""
    center = F.lit(None).cast("double")
    for side, mean in means.items():
        center = F.when(F.col("side") == side, F.lit(mean)).otherwise(center)
    return sample.where(F.col("x").isNotNull()).select("side", F.abs(F.col("x") - center).alias("x"))


def rank_sums(sample: DataFrame, first: str, second: str) -> DataFrame:
    """n1, n2, U of the first sample and the tie term, with average ranks.

    Values are counted first; ranks come from running counts over the distinct values, held by range partitions.
    """
    counted = (
        sample.where(F.col("x").isNotNull())
        .groupBy("x")
        .agg(F.count_if(F.col("side") == first).alias("n1"), F.count_if(F.col("side") == second).alias("n2"))
        .withColumn("t", F.col("n1") + F.col("n2"))
    )
    ranked = running_totals(counted, ["x"], ["t"], "ranks")
    t = F.col("t").cast("decimal(20,0)")
    double_rank = F.col("t_before") * 2 + F.col("t") + 1
    sums = ranked.agg(
        F.coalesce(F.sum("n1"), F.lit(0)).alias("n1"),
        F.coalesce(F.sum("n2"), F.lit(0)).alias("n2"),
        F.sum(F.col("n1").cast("decimal(18,0)") * double_rank.cast("decimal(18,0)")).alias("double_rank_sum"),
        F.sum((t * t).cast("decimal(30,0)") * t - t).cast("double").alias("ties"),
    )
    n1 = F.col("n1").cast("double")
    return sums.select(
        "n1", "n2", (F.col("double_rank_sum").cast("double") / 2 - n1 * (n1 + 1) / 2).alias("u1"), "ties"
    )


def conversion_counts(account_level: DataFrame) -> DataFrame:
    """Accounts and converted accounts per group."""
    return account_level.groupBy("group_type").agg(
        F.count("*").alias("accounts"), F.count_if(F.col("converted")).alias("converted")
    )


def arpdau(daily_revenue: DataFrame, daily_accounts: DataFrame) -> DataFrame:
    """Revenue per active account, day and group; a group without sales or accounts on a day stays NULL."""
    revenue = daily_revenue.groupBy("session_date").pivot("group_type", ["control", "test"]).agg(F.sum("cost_usd"))

    def per_account(side: str):
        return F.try_divide(F.col(side).cast("double"), F.col(f"{side}_unique_accounts").cast("double")).alias(f"{side}_arpdau")

    return daily_accounts.join(revenue, "session_date").select(
        "session_date",
        F.col("control").alias("control_revenue"),
        F.col("test").alias("test_revenue"),
        "control_unique_accounts",
        "test_unique_accounts",
        per_account("control"),
        per_account("test"),
    )
