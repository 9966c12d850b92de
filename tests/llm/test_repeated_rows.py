"""Rows that repeat an id and text under another source or language."""

from collections import Counter

from pyspark.sql import functions as F

from questmart.llm.exact_dedup import keep_one_copy
from questmart.llm.mixing import mix, mix_plan


def _repeated(spark):
    rows = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("one two three "), "id").alias("text"), F.explode(F.array(*map(F.lit, ["a", "b", "c", None]))).alias("source")
    )
    return rows.select("*", F.explode(F.array(F.lit("de"), F.lit("en"))).alias("lang"))


def test_mix_keeps_every_source(spark):
    docs = _repeated(spark)
    want, got = Counter(), Counter((r.doc_id, r.source) for r in mix(docs).collect())
    for r in mix_plan(docs).collect():
        want[r.doc_id, r.source] += r.copies
    assert got == +want and len({source for _, source in got}) > 2


def test_rows_kept_do_not_hang_on_their_order(spark):
    docs = _repeated(spark)
    kept = [Counter(map(tuple, f(d).collect())) for f in (mix, keep_one_copy) for d in (docs, docs.orderBy(F.desc("lang")).repartition(7, "lang"))]
    assert kept[0] == kept[1] and kept[2] == kept[3]
