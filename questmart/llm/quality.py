"""Quality rules: base counts of a text, and a log-likelihood ratio of hashed n-grams between trusted and raw texts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.llm.common import BLANKS, WORD, let, whole_text

BUCKETS = 65_536
# Pseudo-counts of every bucket, in expected counts of the trusted corpus: rare n-grams then weigh next to nothing.
SMOOTHING = 20.0
# A document stays when its n-grams are, on average, at most this much (in nats) likelier under the raw corpus.
THRESHOLD = -0.065
# Log ratios are held as whole millionths, so sums do not depend on their order.
SCALE = 1_000_000
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def bucket(*words: Column) -> Column:
    """Bucket of a word, or of a word pair."""
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def gram_counts(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per bucket the words and word pairs of all documents (raw) and of the trusted ones (good)."""
    ids = trusted.select(F.col(id_column).cast("long").alias("_trusted_id"), F.lit(1).alias("_good")).distinct()
    # The same join at every size: the ids grow with the labels, so no plan may rest on broadcasting them.
    marked = docs.select(F.col(id_column).cast("long").alias("_id"), whole_text(text).alias("_text")).join(
        ids.hint("merge"), F.col("_id") == F.col("_trusted_id"), "left"
    )
    # Rows of words and buckets, not arrays made by functions over arrays: from the join to the counts this is one piece of
    # generated code. The outer form, as the plain one would work out the words once more for a filter of empty arrays.
    words = marked.select("_good", words_of(F.col("_text")).alias("_words")).select(
        "_good", "_words", F.posexplode_outer("_words").alias("_at", "_word")
    )
    after = F.get("_words", F.col("_at") + 1)
    # The pair behind the last word has no second half and is left out.
    grams = F.array(F.when(F.col("_word").isNotNull(), bucket(F.col("_word"))), F.when(after.isNotNull(), bucket(F.col("_word"), after)))
    buckets = words.select("_good", F.explode(grams).alias("bucket")).where("bucket IS NOT NULL")
    return buckets.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("_good").alias("good"))


def ratio_table(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text: str = "text") -> list[int]:
    """Per bucket log(p_trusted / p_raw) in millionths: two smoothed multinomials counted over all documents.

    ``trusted``: ids of the trusted documents. The table has BUCKETS numbers however large the corpus is.
    """
    raw, good = [0] * BUCKETS, [0] * BUCKETS
    for row in gram_counts(docs, trusted, id_column, text).collect():
        raw[row["bucket"]], good[row["bucket"]] = row["raw"], row["good"]
    # Trusted counts against what the raw corpus lets expect in a corpus of the trusted one's size.
    share = sum(good) / max(sum(raw), 1)
    return [round(SCALE * math.log((g + SMOOTHING) / (r * share + SMOOTHING))) for g, r in zip(good, raw)]


def _windows(words: Column) -> Column:
    """Hashes of all 3-word windows."""
    hashes = F.transform(words, lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def _placed_if_repeated(windows: Column) -> Column:
    """(hash, position) of all windows, sorted, if the text holds one twice; else null. Most texts need no sort."""
    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(placed))


def _repeat_words(windows: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more; ``windows``: (hash, position) of all, sorted."""

    def repeated(x: Column, i: Column) -> Column:
        same = (x["h"] == F.get(windows, i - 1)["h"]) | (x["h"] == F.get(windows, i + 1)["h"])
        return F.when(F.coalesce(same, F.lit(False)), x["i"])

    starts = F.filter(F.transform(windows, repeated), lambda i: i.isNotNull())
    covered = F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))
    return F.size(F.array_distinct(covered)).cast("long")


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return let(lines, lambda kept: (F.size(kept) - F.size(F.array_distinct(kept))).cast("long"))


def _score(words: Column, table: list[int]) -> Column:
    """Mean log ratio of the text's words and word pairs; null without any."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")

    def ratio(word: Column, after: Column) -> Column:
        return F.get(ratios, bucket(word)) + F.when(after.isNotNull(), F.get(ratios, bucket(word, after))).otherwise(0)

    each = F.zip_with(words, F.slice(words, 2, F.size(words)), ratio)
    total = F.aggregate(each, F.lit(0).cast("long"), lambda so_far, r: so_far + r)
    return F.try_divide(total / SCALE, F.greatest(2 * F.size(words) - 1, F.lit(0)))


def judged(docs: DataFrame, carried: Column, text: Column, table: list[int]) -> DataFrame:
    """``carried`` of every row as _row, and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed
    and kept.

    Everything is computed inside the row, from the whole text: no shuffle, and every row, repeated or not, gets its own
    verdict. Null and empty texts have no words and fail the base rule. The steps are columns of their own, so that each is
    worked out once, and the plain array functions in generated code.
    """
    whole = F.coalesce(text, F.lit(""))
    read = docs.select(
        carried.alias("_row"),
        words_of(whole).alias("_words"),
        F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        _dup_lines(whole).alias("n_dup_lines"),
    )
    words = F.col("_words")
    measured = read.select(
        "_row",
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        _score(words, table).alias("score"),
        _windows(words).alias("_windows"),
    )
    ordered = measured.withColumn("_placed", _placed_if_repeated(F.col("_windows")))
    repeats = F.when(F.col("_placed").isNotNull(), _repeat_words(F.col("_placed"))).otherwise(F.lit(0).cast("long"))
    counted = ordered.withColumn("n_repeat_words", repeats)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    kept = ~failed & F.coalesce(F.col("score") >= THRESHOLD, F.lit(False))
    fields = [F.col(f) for f in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")]
    # Through a generator: a later filter would be pushed below plain columns, with all of the above written out in it.
    return counted.select("_row", F.inline(F.array(F.struct(*fields, failed.alias("base_failed"), kept.alias("kept")))))


def quality_verdicts(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the measures of every row. An empty table gives an empty result; only id and text are read."""
    table = ratio_table(docs, trusted, id_column, text)
    return judged(docs, F.col(id_column).cast("long"), F.col(text), table).withColumnRenamed("_row", "doc_id")


def keep_good(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = judged(docs, whole, F.col(text), ratio_table(docs, trusted, id_column, text))
    return rows.where("kept").select("_row.*")
