"""Model table of the equipment study."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rarity letters and their rank.
RARITY_RANK = {"c": 1, "u": 2, "r": 3, "e": 4, "l": 5}

SLOTS = ["weapon", "armor", "held_item"]
NUMERIC = ["success_score_floor", *[f"rarity_{slot}" for slot in SLOTS]]
CATEGORIES = ["base_weapon", "base_armor", "base_held_item", "skin"]


def _parts(item: Column) -> Column:
    return F.split(F.coalesce(item, F.lit("")), "_")


def rarity(item: Column) -> Column:
    """Rank of the leading rarity letter, 0 when unknown."""
    ranks = F.create_map(*[F.lit(v) for pair in RARITY_RANK.items() for v in pair])
    return F.coalesce(F.try_element_at(ranks, F.element_at(_parts(item), 1)), F.lit(0))


def base_item(item: Column) -> Column:
    """Everything after rarity and slot; 'unknown' for a shorter id."""
    parts = _parts(item)
    return F.when(F.size(parts) > 2, F.array_join(F.slice(parts, 3, F.size(parts)), "_")).otherwise("unknown")


def base_skin(skin: Column) -> Column:
    parts = _parts(skin)
    return F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, 2, F.size(parts)), "_")).otherwise("missing")


def model_table(equipment: DataFrame) -> DataFrame:
    """Scored attempts outside tutorials, with ordinal rarities, base items and all targets.

    ``target_ordinal`` turns stars around, 0 best to 3 worst. Levels without a number drop out with the tutorials.
    """
    level = F.split_part("level_id", F.lit("_"), F.lit(2)).try_cast("int")
    return (
        equipment.withColumn("score", F.col("total_score").try_cast("double"))
        .withColumn("stars", F.col("stars_gained").try_cast("double"))
        .where(F.col("score").isNotNull() & ~F.col("level_id").startswith("T") & level.isNotNull())
        .select(
            (F.lit(800) + (level - 1) * 50).alias("success_score_floor"),
            *[rarity(F.col(f"equipped_{slot}")).alias(f"rarity_{slot}") for slot in SLOTS],
            *[base_item(F.col(f"equipped_{slot}")).alias(f"base_{slot}") for slot in SLOTS],
            base_skin(F.coalesce("equipped_skin", F.lit("missing"))).alias("skin"),
            F.coalesce("is_attempt_successful", F.lit(False)).cast("int").alias("target_binary"),
            (3 - F.col("stars")).cast("int").alias("target_ordinal"),
            F.col("score").alias("target_score"),
        )
    )


def with_residual(table: DataFrame) -> DataFrame:
    """Score minus its least-squares line over the score floor; slope and intercept are one aggregated row."""
    line = table.agg(
        F.struct(
            F.regr_slope("target_score", "success_score_floor").alias("slope"),
            F.regr_intercept("target_score", "success_score_floor").alias("intercept"),
        ).alias("line")
    ).scalar()
    fitted = line["slope"] * F.col("success_score_floor") + line["intercept"]
    return table.withColumn("target_residual", F.col("target_score") - fitted)


def hashed_sample(df: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """At most ``size`` rows, the same ones for the same rows and seed: a top-k by hash, not a full sort. The hash is one
    that SQL engines share, over the columns as text; numbers go in rounded to whole ones."""
    whole = {f.name for f in df.schema if f.dataType.simpleString() in ("double", "float") or f.dataType.simpleString().startswith("decimal")}
    texts = [F.coalesce((F.round(c).cast("bigint") if c in whole else F.col(c)).cast("string"), F.lit("")) for c in df.columns]
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *texts).cast("binary"))
    return df.withColumn("_order", order).orderBy("_order", *df.columns).limit(size).drop("_order")
