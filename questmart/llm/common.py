"""Shared pieces: words and white space of the contracts, row identity, balanced running sums."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# White space of every contract here: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Ids without a value are ordered behind every other id.
LAST_ID = (1 << 63) - 1


def session_buckets(spark: SparkSession) -> int:
    """Buckets for a table that lives as long as the run: as many as the session's shuffles have, so they grow with the data
    it was sized for, and a join with such a table needs no second shuffle. Beyond spark.sql.sources.bucketing.maxBuckets
    (100,000 unless set) shuffle partitions, buckets stop growing with them; raise that setting first."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once per row, however often the body uses it.

    A column of its own would not do: a filter above would be pushed below it with the value written out at every use.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_text(text: str) -> Column:
    """The text; empty for null."""
    return F.coalesce(F.col(text), F.lit(""))


def without_blanks(text: Column) -> Column:
    """The text with every blank deleted: plain byte replacements, no pattern matching."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters unchanged. Pure ASCII takes the fast built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def text_key(text: Column) -> Column:
    """64-bit key that, next to a document's id, tells rows with the same id but another text apart."""
    return F.xxhash64(text)


def packed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(_row, _id, _key): whole rows beside their id and text key, so that no column of theirs can clash with others."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("_row"), F.col(id_column).cast("long").alias("_id"), text_key(whole_text(text)).alias("_key"))


def keep_documents(docs: DataFrame, chosen: DataFrame, id_column: str, text: str, also: dict[str, str] | None = None) -> DataFrame:
    """One row of ``docs`` for each (doc_id, text_key) in ``chosen``, in the columns of ``docs``.

    ``also`` names further columns of ``chosen`` that tell rows apart, and the columns of ``docs`` they are compared with.
    Rows alike in all of these collapse to one before the shuffle, so repeats cannot pile up: a text before null, then the
    smallest by a hash of the row. Other columns of ``chosen`` follow behind as ``_<name>``.
    """
    also = also or {}
    rest = [c for c in chosen.columns if c not in ("doc_id", "text_key", *also)]
    wanted = chosen.select(
        F.struct(F.col("doc_id").cast("long").alias("a"), F.col("text_key").alias("b"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(also)]).alias("_wanted"),
        *[F.col(c).alias(f"_{c}") for c in rest],
    )
    rows = packed(docs, id_column, text)
    others = [F.col("_row").getField(column).alias(f"c{i}") for i, column in enumerate(also.values())]
    # Inside a struct null equals null, so one key serves the grouping and the join, and texts are shuffled once.
    rows = rows.select("_row", F.struct(F.col("_id").alias("a"), F.col("_key").alias("b"), *others).alias("_same"))
    # Rows that collapse have the same text, so the hash need not read it.
    without_text = F.struct(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c != text])
    order = F.struct(F.col("_row").getField(text).isNull(), F.xxhash64(F.to_json(without_text)))
    rows = rows.groupBy("_same").agg(F.min_by("_row", order).alias("_row"))
    # Sort-merge at every size: what is wanted grows with the documents.
    return rows.join(wanted.hint("merge"), F.col("_same") == F.col("_wanted")).select("_row", *[f"_{c}" for c in rest])


def running_before(df: DataFrame, groups: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the group's rows that come earlier by (bucket, order).

    A group may hold any share of all rows: ``bucket`` cuts it into slices of the order, each slice is summed in its own
    window, and slice totals (one row per group and slice) give each slice its start.
    """
    keys = [*groups, bucket]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_slice"))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"_at_{k}") for k in keys], F.coalesce(F.sum("_slice").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
    return summed.join(starts, match).select(*df.columns, (F.col("_start") + F.col("_inside")).alias(out))
