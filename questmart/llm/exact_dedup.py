"""Exact dedup against a persistent index of digests, bucketed and sorted by digest."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questmart.llm.common import keep_documents, session_buckets, text_key, whole_text, without_blanks
from questmart.session import new_stage_path, stage

DEFAULT_BUCKETS = 32
# Batches in which exact_dedup feeds one table to its index.
BATCHES = 3


class DigestIndex:
    """Digests of all texts seen so far, at ``path``; later sessions open it again by the same path and number of buckets.

    ``add`` takes a batch of documents, keeps one row per new digest and appends it to the index. Texts are equal when
    they are identical without blanks; null counts as empty. Inside a batch the row with the longest original text stays,
    then the smallest id (null ids last), then one of the remaining equals. A text that an earlier batch holds is dropped
    whatever its length. Equal rows repeated in a batch count in ``group_size`` and only one of them is kept. An empty
    batch gives an empty result. Only the id and text columns are read, so others cannot clash.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "digests_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT, keep_row BIGINT, batch STRING) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def append(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """Appends one row per digest that the index does not hold yet; ``rows`` as ``digest_rows`` gives them.

        Returns the name of the batch and its groups (digest, group_size), those dropped by the anti-join included.
        """
        # Complements turn "smallest" into "largest" without overflow; a null id is the smallest field of a struct.
        first = F.struct("n_chars", F.bitwise_not("doc_id").alias("a"), F.bitwise_not("row").alias("b"))
        best = stage(
            rows.groupBy("digest")
            .agg(F.count("*").alias("group_size"), F.max(first).alias("first"))
            .select(
                "digest",
                "group_size",
                F.bitwise_not("first.a").alias("best_id"),
                F.bitwise_not("first.b").alias("best_row"),
            ),
            "digest-groups",
        )
        batch = new_stage_path(self.spark, "batch").rsplit("/", 1)[1]
        # The index grows without bound, so it is merged at every size; its buckets spare it the shuffle.
        fresh = best.join(self.spark.table(self.table).hint("merge"), "digest", "left_anti")
        (
            fresh.select("digest", F.col("best_id").alias("keep_id"), F.col("best_row").alias("keep_row"), F.lit(batch).alias("batch"))
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.table)
        )
        return batch, best.select("digest", "group_size")

    def verdicts(self, rows: DataFrame, groups: DataFrame, batches: list[str]) -> DataFrame:
        """One row per row: doc_id, text_key, keep_id, group_size, kept, digest. A row is kept if one of ``batches`` chose it."""
        # Stored before it meets the rows: both sides are then plain shuffles, so a digest with very many rows is split.
        chosen = stage(groups.join(self.spark.table(self.table).hint("merge"), "digest"), "digest-verdicts")
        joined = rows.join(
            chosen.select(F.col("digest").alias("_digest"), "group_size", "keep_id", "keep_row", "batch"),
            F.col("digest") == F.col("_digest"),
        )
        kept = F.col("batch").isin(batches) & (F.col("row") == F.col("keep_row"))
        return joined.select("doc_id", "text_key", "keep_id", "group_size", kept.alias("kept"), "digest")

    def add(self, docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
        """One batch of documents; rows as ``verdicts`` gives them."""
        rows = digest_rows(docs, id_column, text)
        batch, groups = self.append(rows)
        return self.verdicts(rows, groups, [batch])


def digest_rows(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """A stored row per document: its id, text key and digest, the length of its text and a number of its own."""
    raw = whole_text(text)
    return stage(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            text_key(raw).alias("text_key"),
            F.unhex(F.sha2(without_blanks(raw), 256)).alias("digest"),
            F.char_length(raw).cast("long").alias("n_chars"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digest-rows",
    )


def length_ranges(rows: DataFrame, batches: int) -> list[Column]:
    """Conditions that cut the rows into at most ``batches`` ranges of falling text length, of about equal numbers of rows.

    Every row meets exactly one condition, wherever the approximate cuts fall; ``batches - 1`` numbers reach the driver.
    """
    shares = [i / batches for i in range(1, batches)]
    cuts = rows.agg(F.percentile_approx("n_chars", shares).alias("cuts")).first()["cuts"] if shares else None
    edges = sorted(set(cuts or []), reverse=True)
    length = F.col("n_chars")
    above = [None, *edges]
    return [
        (F.lit(True) if upper is None else length < upper) & (F.lit(True) if lower is None else length >= lower)
        for upper, lower in zip(above, [*edges, None])
    ]


def exact_dedup(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", buckets: int | None = None, batches: int = BATCHES
) -> DataFrame:
    """Dedup of one table through a new index, bucketed like the session's shuffles, that takes the table batch by batch.

    Batches are ranges of falling text length, so the longest text of a group is always in the first batch that holds the
    group, equally long ones share that batch, and later batches lose their copies to the anti-join with the stored index.
    Texts of one length are one batch, however many; a batch is no more than a shuffle of its digests. Results do not
    depend on ``batches``. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    index = DigestIndex(spark, new_stage_path(spark, "digest-index"), buckets or session_buckets(spark))
    rows = digest_rows(docs, id_column, text)
    added = [index.append(rows.where(part)) for part in length_ranges(rows, batches)]
    groups = reduce(DataFrame.union, [found for _, found in added])
    # Copies may lie in several batches; each digest has one row a batch by now.
    sizes = groups.groupBy("digest").agg(F.sum("group_size").alias("group_size"))
    result = index.verdicts(rows, sizes, [batch for batch, _ in added])
    # The rows no longer read the index; dropping its name leaves nothing in the catalog.
    spark.sql(f"DROP TABLE {index.table}")
    return result


def keep_one_copy(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, unchanged."""
    chosen = exact_dedup(docs, id_column, text).where("kept").select("doc_id", "text_key")
    return keep_documents(docs, chosen, id_column, text).select("_row.*")
