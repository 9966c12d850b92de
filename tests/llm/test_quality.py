"""Quality rules: odd texts by brute force, and the work that a text without repeats must not cost."""

import math
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from questmart.llm import quality
from questmart.llm.quality import BUCKETS, MIN_WORDS, SCALE, SMOOTHING, THRESHOLD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None,
    "",
    " \n\t\x0b\x0c\r ",
    "one",
    "one two",
    "a b c",
    "a b c a b c",
    "x " * 80,
    " ".join(f"w{i}" for i in range(120)),
    " ".join(f"w{i}" for i in range(60)) + "\n" + " ".join(f"w{i}" for i in range(20, 40)) + " end",
    "#*$%&|<> [^] a#b\n#*$%&|<>\n #*$%&|<>\n#*$%&|<>",
    "é 中文 😀😀 x\x85y\r\n" * 30,
    "same line\nsame line\n\n \nsame line \nother",
]
TRUSTED = {3, 8, 8, 9, 100}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, i % 2 == 0) for i, t in enumerate(TEXTS)]
    # One id with two texts, one row twice, one row without an id.
    rows += [(8, "another text of document eight", True), rows[9], (None, TEXTS[9], None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept boolean")


@pytest.fixture(scope="module")
def trusted(spark):
    return spark.createDataFrame([(i,) for i in sorted(TRUSTED)] + [(8,), (None,)], "doc_id bigint")


def spark_hash(*words):
    seed = 42
    for word in words:
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return seed


def grams(text):
    words = WORD.findall(text or "")
    return [spark_hash(w) % BUCKETS for w in words] + [spark_hash(*p) % BUCKETS for p in zip(words, words[1:])]


def brute(rows):
    raw = Counter(g for doc, text in rows for g in grams(text))
    good = Counter(g for doc, text in rows if doc in TRUSTED for g in grams(text))
    share = sum(good.values()) / sum(raw.values())
    table = {g: round(SCALE * math.log((good[g] + SMOOTHING) / (raw[g] * share + SMOOTHING))) for g in raw}
    for doc, text in rows:
        text = text or ""
        words = WORD.findall(text)
        times = Counter(windows := [*zip(words, words[1:], words[2:])])
        repeated = len({i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)})
        lines = [line for line in text.split("\n") if WORD.search(line)]
        score = sum(table[g] for g in grams(text)) / SCALE / len(grams(text)) if words else None
        failed = len(words) < MIN_WORDS or 100 * repeated > 50 * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        yield (doc, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, score, failed, not failed and score >= THRESHOLD)


def test_odd_texts_against_brute_force(docs, trusted):
    want = Counter(brute([(r.doc_id, r.text) for r in docs.collect()]))
    assert any(r[5] for r in want) and any(r[-1] for r in want)
    assert Counter(map(tuple, quality.quality_verdicts(docs, trusted).collect())) == want


def test_rows_that_pass_are_unchanged(docs, trusted):
    verdicts = [r[-1] for r in brute([(r.doc_id, r.text) for r in docs.collect()])]
    got = quality.keep_good(docs, trusted)
    assert got.schema == docs.schema
    assert Counter(got.collect()) == Counter(r for r, kept in zip(docs.collect(), verdicts) if kept)


def test_texts_without_repeats_are_not_sorted(docs):
    words = docs.select("doc_id", quality.words_of(F.coalesce("text", F.lit(""))).alias("words"))
    windows = words.select("doc_id", "words", quality._windows(F.col("words")).alias("windows"))
    for row in windows.withColumn("placed", quality._placed_if_repeated(F.col("windows"))).collect():
        plain = [*zip(row.words, row.words[1:], row.words[2:])]
        assert len(row.windows) == len(plain)
        if len(set(plain)) == len(plain):
            assert row.placed is None
        else:
            assert [tuple(p) for p in row.placed] == sorted((h, i) for i, h in enumerate(row.windows))


def test_words_are_found_once(docs, trusted):
    """Neither a filter behind the verdicts nor one that Spark adds below an explode writes the word search out again."""
    for df in (
        quality.gram_counts(docs, trusted),
        quality.quality_verdicts(docs, trusted).where("kept"),
        quality.keep_good(docs, trusted),
    ):
        assert df._jdf.queryExecution().optimizedPlan().toString().count(quality.WORD) == 1


def test_grams_are_counted_without_array_functions(docs, trusted):
    """Counting runs in generated code: functions over arrays would be interpreted for every word."""
    plan = quality.gram_counts(docs, trusted)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
