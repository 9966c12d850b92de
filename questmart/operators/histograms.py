"""Order statistics taken from counted values, so that raw rows are reduced before any shuffle or sort."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from questmart.session import stage


def value_counts(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    return df.select(*keys, value.alias(name)).where(F.col(name).isNotNull()).groupBy(*keys, name).agg(F.count("*").alias("n"))


def most_common(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """The most frequent value per key; equal counts give the smallest value."""
    counted = value_counts(df, keys, value, name)
    return counted.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("order"), name)).alias("top")).select(
        *keys, F.col(f"top.{name}").alias(name)
    )


def _quantile_picks(quantiles: dict[str, float], median: str | None, among: Column) -> list[Column]:
    """Aggregates over (v, rank, total) rows, of which only those ``among`` holds for count."""

    def at_rank(position: Column) -> Column:
        return F.min(F.when(among & (F.col("rank") >= position), F.col("v")))

    picks = [at_rank(F.ceil(F.lit(Decimal(str(p))) * F.col("total"))).alias(name) for name, p in quantiles.items()]
    if median:
        low, high = F.floor((F.col("total") + 1) / 2), F.ceil((F.col("total") + 1) / 2)
        picks.append(((at_rank(low) + at_rank(high)) / 2).cast("double").alias(median))
    return picks


def _ranked(counted: DataFrame, keys: list[str]) -> DataFrame:
    upto = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("rank", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))


def discrete_quantiles(
    df: DataFrame, keys: list[str], value: Column, quantiles: dict[str, float], median: str | None = None
) -> DataFrame:
    """Discrete quantiles (smallest value whose rank reaches p) and an optional interpolated median per key.

    Works on (key, value) counts: a window per key runs over the distinct values only.
    """
    ranked = _ranked(value_counts(df, keys, value, "v"), keys)
    return ranked.groupBy(*keys).agg(*_quantile_picks(quantiles, median, F.lit(True)))


def quantiles_and_modes(
    df: DataFrame, keys: list[str], value: Column, quantiles: dict[str, float], median: str, modes: dict[str, Column]
) -> DataFrame:
    """What ``discrete_quantiles`` of one value and ``most_common`` of several others give, from one read of the rows.

    Each row is taken apart into (measure, number or text) and counted before the shuffle. Modes are texts or whole
    numbers; numbers are compared as numbers.
    """
    kinds = {name: df.select(column.alias("x")).schema["x"].dataType for name, column in modes.items()}
    is_text = {name: kind.simpleString() == "string" for name, kind in kinds.items()}

    def part(measure: str, number: Column, text: Column) -> Column:
        return F.struct(F.lit(measure).alias("measure"), number.cast("double").alias("v"), text.cast("string").alias("text"))

    none = F.lit(None)
    parts = [part(median, value, none)]
    parts += [part(name, none if is_text[name] else column, column if is_text[name] else none) for name, column in modes.items()]
    taken_apart = df.select(*keys, F.inline(F.array(*parts))).where(F.coalesce("text", F.col("v").cast("string")).isNotNull())
    counted = taken_apart.groupBy(*keys, "measure", "v", "text").agg(F.count("*").alias("n"))
    picks = _quantile_picks(quantiles, median, F.col("measure") == median)
    for name, kind in kinds.items():
        own = F.col("text") if is_text[name] else F.col("v").cast(kind)
        best = F.min(F.when(F.col("measure") == name, F.struct((-F.col("n")).alias("order"), own.alias("value"))))
        picks.append(best["value"].alias(name))
    return _ranked(counted, [*keys, "measure"]).groupBy(*keys).agg(*picks)


BINS = 4096


def _magnitude(v: Column) -> Column:
    """Order of magnitude with the sign: rises with v from -2099 to 2099, 0 only for 0."""
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.log2(F.abs(F.nullif(v, F.lit(0.0)))) + 1075))


def narrowed_quantiles(df: DataFrame, measures: list[str], quantiles: dict[str, float], bins: int = BINS) -> dict[str, dict[str, float | None]]:
    """Exact discrete quantiles of whole columns, by measure and name, without putting a column's values in order anywhere.

    Each round counts the values of every open range in equal bins and keeps the one bin that holds the wanted rank; its
    least and greatest value bound the next round, until they are equal. At most ``bins`` counts per measure and quantile
    reach the driver in a round. The rows are read once, into stored (measure, value) counts. Null and NaN do not count;
    a measure without values has no quantiles.
    """
    long = df.unpivot([], measures, "measure", "v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = stage(long.groupBy("measure", F.col("v").cast("double").alias("v")).agg(F.count("*").alias("n")), "value-counts")
    found: dict[str, dict[str, float | None]] = {m: dict.fromkeys(quantiles) for m in measures}
    spans = counts.groupBy("measure").agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    # Open searches: the range that holds the value, and the value's rank inside it.
    open_ = {
        (row["measure"], name): (row["low"], row["high"], max(1, math.ceil(Decimal(str(p)) * row["n"])))
        for row in spans
        for name, p in quantiles.items()
    }
    while open_:
        for key in [k for k, (low, high, _) in open_.items() if low == high]:
            found[key[0]][key[1]] = open_.pop(key)[0]
        if not open_:
            break
        ranges = F.array(
            *[
                F.struct(F.lit(m).alias("of"), F.lit(name).alias("name"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"))
                for (m, name), (low, high, _) in open_.items()
            ]
        )
        inside = counts.select("measure", "v", "n", F.explode(ranges).alias("range")).where(
            (F.col("measure") == F.col("range.of")) & F.col("v").between(F.col("range.low"), F.col("range.high"))
        )
        low, high, v = F.col("range.low"), F.col("range.high"), F.col("v")
        # Ranges over several magnitudes are cut by magnitude, others evenly. Either way a greater value never has a lower
        # bin, and the ends have different bins, so every round narrows.
        wide = (F.signum(low) != F.signum(high)) | (_magnitude(high) - _magnitude(low) > 2)
        # Halved, so that the width of the widest range is a number.
        whole = F.greatest(F.abs(low), F.abs(high)) < 1e300
        place = F.when(wide, (_magnitude(v) - _magnitude(low)) / F.nullif(_magnitude(high) - _magnitude(low), F.lit(0.0)))
        place = place.when(whole, (v - low) / F.nullif(high - low, F.lit(0.0))).otherwise((v / 2 - low / 2) / F.nullif(high / 2 - low / 2, F.lit(0.0)))
        counted = inside.groupBy("measure", "range.name", F.least(F.floor(place * bins), F.lit(bins - 1)).alias("bin")).agg(
            F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        by_search: dict[tuple[str, str], list] = {}
        for row in counted.collect():
            by_search.setdefault((row["measure"], row["name"]), []).append(row)
        for key, rows in by_search.items():
            rank = open_[key][2]
            for row in sorted(rows, key=lambda r: r["low"]):
                if rank <= row["n"]:
                    open_[key] = (row["low"], row["high"], rank)
                    break
                rank -= row["n"]
    return found
