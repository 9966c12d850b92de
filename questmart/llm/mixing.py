"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.llm.common import WORD, keep_documents, running_before, text_key, whole_text
from questmart.operators.ordering import assign_dense_ids, running_totals
from questmart.session import stage

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# Slices of the shuffled order of a source, and of virtual time.
ORDER_DIGITS = 3
TIME_SLICES = 16_384


def source_table(sized: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """(source, rank, weight, source_size, cap): sources by code point, null last, with the repeating weights."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = assign_dense_ids(
        sums.withColumn("no_source", F.col("source").isNull().cast("int")), ["no_source", "source"], "rank", "source-ranks"
    )
    index = (F.col("rank") - 1) % len(weights) + 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), index.cast("int")).cast("long")
    return ranked.select("source", "rank", weight.alias("weight"), "source_size", (F.col("source_size") * max_repeats).alias("cap"))


def fill_level(sources: DataFrame) -> float | None:
    """The virtual time at which the sources, each served by weight until its cap, have been given the whole budget.

    Sorted by the time at which they run dry, the level is that of the first source that lasts: the budget left by the
    sources before it over the weight of the rest. One row comes to the driver.
    """
    dry = sources.withColumn("dry_at", F.col("cap") / F.col("weight"))
    before = running_totals(dry, ["dry_at", "rank"], ["cap", "weight"], "fill").select("rank", "cap_before", "weight_before")
    whole = sources.agg(F.sum("source_size").alias("budget"), F.sum("weight").alias("weights"))
    budget, weights = whole.first()
    if budget is None:
        return None
    level = (F.lit(budget) - F.col("cap_before")) / (F.lit(weights) - F.col("weight_before"))
    fitting = dry.join(before, "rank").withColumn("level", level).where(F.col("level") <= F.col("dry_at"))
    return fitting.agg(F.min_by("level", F.struct("dry_at", "rank"))).first()[0]


def mix_plan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: str = "mix",
) -> DataFrame:
    """doc_id, text_key, source, size, source_size, target, copies, taken: one row per input row.

    Size is the number of words. Each source's documents are shuffled by a hash of their id and queued again up to
    ``max_repeats`` times. A copy's virtual finish time is the source's words so far over the source's weight. All copies
    are ordered by it and taken until the budget, the words of all documents, is used up; so a source stops at its cap
    and the others share the rest by weight. ``target`` is what the source should get; it misses that by no more than the
    documents at the cut. Null text has size zero, null sources form a source of their own (last), null ids are an id like
    any other, ties are broken by id and text. Repeated rows count each. An empty table gives an empty result. Other
    columns are not read.
    """
    raw = whole_text(text)
    sized = stage(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.col(source).alias("source"),
            F.regexp_count(raw, F.lit(WORD)).cast("long").alias("size"),
            text_key(raw).alias("text_key"),
            F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(":" + seed))).alias("shuffle"),
        ).withColumn("slice", F.substring("shuffle", 1, ORDER_DIGITS)),
        "mix-sizes",
    )
    sources = stage(source_table(sized, weights, max_repeats), "mix-sources")
    level = fill_level(sources)
    order = ["shuffle", "doc_id", "text_key"]
    queued = running_before(sized, ["source"], "slice", order, "size", "before")
    about = sources.select(
        F.col("source").alias("_source"),
        "rank",
        "weight",
        "source_size",
        F.least(F.col("weight") * F.lit(level), F.col("cap").cast("double")).alias("target"),
    )
    queued = queued.join(about, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    queued = stage(queued, "mix-queues")
    included = _cut(queued, level, max_repeats)
    copies = sum((included(c).cast("long") for c in range(max_repeats)), F.lit(0))
    return queued.withColumn("copies", copies).select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def _finish(copy: Column | int) -> Column:
    return (F.col("source_size") * copy + F.col("before") + F.col("size")) / F.col("weight")


def _cut(queued: DataFrame, level: float | None, max_repeats: int):
    """A function from the number of a copy to the condition that the copy lies before the cut.

    Virtual time is cut into slices. Their totals (one row per slice, bounded) tell in which slice the budget ends; only
    that slice is put in order.
    """
    if not level:
        return lambda copy: F.lit(False)

    def time_slice(finish: Column) -> Column:
        return F.least(F.floor(finish / F.lit(level) * TIME_SLICES), F.lit(2 * TIME_SLICES)).cast("int")

    copies = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    copies = copies.withColumn("finish", _finish(F.col("copy"))).withColumn("at", time_slice(F.col("finish")))
    totals = sorted(copies.groupBy("at").agg(F.sum("size").alias("words")).collect())
    budget = sum(words for _, words in totals) // max_repeats
    used, edge = 0, 2 * TIME_SLICES + 1
    for at, words in totals:
        if used + words > budget:
            edge = at
            break
        used += words
    key = ["finish", "rank", "copy", "shuffle", "doc_id", "text_key"]
    inside = running_before(
        copies.where(F.col("at") == edge).withColumn("all", F.lit(0)).withColumn("fine", F.floor(F.col("finish") / F.lit(level) * TIME_SLICES * 256)),
        ["all"],
        "fine",
        key,
        "size",
        "words_before",
    )
    fits = inside.where(F.col("words_before") + F.col("size") + used <= budget)
    last = fits.agg(F.max(F.struct(*key)).alias("last")).first()["last"]

    def before_cut(copy: int) -> Column:
        finish = _finish(copy)
        if last is None:
            return time_slice(finish) < edge
        own = F.struct(finish, F.col("rank"), F.lit(copy), F.col("shuffle"), F.col("doc_id"), F.col("text_key"))
        types = ["double", "long", "int", "string", "long", "long"]
        end = F.struct(*[F.lit(value).cast(kind) for value, kind in zip(last, types)])
        return (time_slice(finish) < edge) | ((time_slice(finish) == edge) & (own <= end))

    return before_cut


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed documents, whole rows, each as often as it is taken. Rows alike in id, text and source share their copies."""
    id_column, text, source = how.get("id_column", "doc_id"), how.get("text", "text"), how.get("source", "source")
    chosen = mix_plan(docs, **how).groupBy("doc_id", "text_key", "source").agg(F.sum("copies").alias("copies")).where("copies > 0")
    rows = keep_documents(docs, chosen, id_column, text, {"source": source})
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).select("_row.*")
