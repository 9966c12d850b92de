"""Line dedup against levelled, sorted runs of line hashes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questmart.llm.common import BLANKS, LAST_ID, ascii_lower, let, session_buckets, text_key, whole_text
from questmart.session import stage

MIN_KEY_CHARS = 10
BATCHES = 4


class LineRuns:
    """Hashes of the lines seen so far, with the document that owns each, as runs bucketed and sorted by hash.

    A batch's keys are anti-joined against every run and the new ones become a run of level 0. When a level holds
    ``fan_in`` runs they are merged into one run of the next level, so there are few runs however many batches come.
    The two 64-bit hashes of a key have different seeds and are compared together.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_in: int = 3) -> None:
        self.spark, self.buckets, self.fan_in = spark, buckets or session_buckets(spark), fan_in
        self.levels: list[list[str]] = []

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.repartition(self.buckets, "h1", "h2")
            .write.format("parquet")
            .bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .saveAsTable(name)
        )
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def owners(self) -> DataFrame | None:
        """(h1, h2, owner) of every line seen; each hash is in one run only."""
        whole = None
        for name in self.runs():
            run = self.spark.table(name)
            whole = run if whole is None else whole.unionAll(run)
        return whole

    def add(self, lines: DataFrame) -> None:
        """``lines``: (h1, h2, owner), repeats allowed; the smallest owner of a hash new to the runs is stored."""
        keys = lines.groupBy("h1", "h2").agg(F.min("owner").alias("owner"))
        for name in self.runs():
            keys = keys.join(self.spark.table(name), ["h1", "h2"], "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(keys))
        self._compact()

    def drop(self) -> None:
        for name in self.runs():
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fan_in:
                merged = None
                for name in self.levels[level]:
                    run = self.spark.table(name)
                    merged = run if merged is None else merged.unionAll(run)
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(merged))
                for name in self.levels[level]:
                    self.spark.sql(f"DROP TABLE {name}")
                self.levels[level] = []
            level += 1


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_KEY_CHARS, batches: int = BATCHES
) -> DataFrame:
    """(owner, text_key, dropped): per document the positions of the lines that an earlier document owns.

    Documents enter the runs in ``batches`` ranges of their ids, so the first batch that holds a line has its smallest id.
    """
    spark = docs.sparkSession
    # A null id comes behind all others.
    owner = F.coalesce(F.col(id_column).cast("long"), F.lit(LAST_ID))
    cuts = docs.select(F.percentile_approx(owner, [i / batches for i in range(1, batches)], F.lit(10_000)).alias("cuts")).first()["cuts"] or []
    raw = whole_text(text)
    line = F.btrim(F.col("_line"), F.lit(BLANKS))
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + (F.col("owner") > F.lit(cut)).cast("int")
    lines = (
        docs.select(owner.alias("owner"), text_key(raw).alias("text_key"), F.posexplode(split_lines(raw)).alias("pos", "_line"))
        .withColumn("_key", ascii_lower(line))
        .where(F.char_length("_key") >= min_chars)
        .select("owner", "text_key", "pos", F.xxhash64("_key").alias("h1"), F.xxhash64(F.lit(1), "_key").alias("h2"), batch.alias("batch"))
    )
    lines = stage(lines, "lines")
    runs = LineRuns(spark)
    for number in range(len(cuts) + 1):
        runs.add(lines.where(F.col("batch") == number).select("h1", "h2", "owner"))
    # Stored before it meets the lines: a line held by very many documents is then split by the adaptive join.
    owners = stage(runs.owners().withColumnRenamed("owner", "first_owner"), "line-owners")
    runs.drop()
    return (
        lines.join(owners, ["h1", "h2"])
        .where(F.col("owner") != F.col("first_owner"))
        .groupBy("owner", "text_key")
        .agg(F.collect_set("pos").alias("dropped"))
    )


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_KEY_CHARS, batches: int = BATCHES
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text per row.

    Lines end at \\n; null or empty text is one empty line. A line's key is the line without blanks at both ends, A-Z
    lower-cased. Keys of at least ``min_chars`` code points in several documents keep only the lines of the smallest id
    (null ids last). Lines of one document never drop each other, and rows with the same id are one document. Repeated
    rows get the same result; an empty table gives an empty result. Only the id and text columns are read.
    """
    drops = repeated_lines(docs, id_column, text, min_chars, batches)
    raw = whole_text(text)
    whole = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(LAST_ID)).alias("owner"),
        text_key(raw).alias("text_key"),
        raw.alias("_text"),
    )
    joined = whole.join(drops.hint("merge"), ["owner", "text_key"], "left")

    def without(lines: Column) -> Column:
        # Set difference on positions is hashed, so a text of very many lines stays linear.
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
        kept_text = F.when(F.col("dropped").isNull(), F.col("_text")).otherwise(
            F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
        )
        return F.struct(F.size(lines).cast("long").alias("n_lines"), kept_text.alias("kept_text"))

    return joined.select(
        "doc_id", "dropped", let(split_lines(F.col("_text")), without).alias("_lines")
    ).select(
        "doc_id",
        "_lines.n_lines",
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        "_lines.kept_text",
    )
