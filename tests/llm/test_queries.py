"""The opN queries against their SQL or a brute-force version, on the whole given tables."""

import hashlib
import math
import re
import struct
from collections import Counter

import duckdb
import pytest
import xxhash

import corpus_pipeline
from questmart.llm import queries
from questmart.llm.quality import BUCKETS, MIN_WORDS, SMOOTHING, THRESHOLD
from questmart.llm.sharding import ShardTree
from verification.compare import compare, duckdb_connection

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_connection(sf_dir)


@pytest.fixture(scope="module")
def documents(sf_dir):
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf_dir}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    same, note = compare(queries.QUERIES[name](spark, sf_dir), con, queries.SQL[name])
    assert same, note


def brute_fingerprint(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = WORD.findall(words)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """doc -> smallest doc reachable, all pairs compared."""
    docs = sorted(prints)
    parent = {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in docs}


def test_simhash_against_all_pairs(spark, sf_dir, documents):
    prints = {doc: brute_fingerprint(text) for doc, text in documents}
    want = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op1_simhash_near_dedup"](spark, sf_dir).collect()}
    assert got == {doc: (f"{prints[doc]:016x}", want[doc]) for doc in prints}


def test_sentencepiece_against_the_library(spark, sf_dir, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    want = {}
    for doc, text in documents:
        ids = library.encode(text, add_eos=True)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want[doc] = (len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest())
    rows = queries.QUERIES["op2_sentencepiece"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


@pytest.mark.parametrize("kind", ["letters", "base64", "joined words", "one letter", "two letters", "accents"])
def test_sentencepiece_on_a_long_text_without_spaces(kind, documents):
    """A megabyte in one word, in time near linear; ids equal the library's."""
    import random
    import time

    import sentencepiece

    from questmart.llm.sentencepiece import PieceModel

    rng = random.Random(4)
    size = 1_000_000
    text = {
        "letters": lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=size)),
        "base64": lambda: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=size)),
        "joined words": lambda: "".join(WORD.findall(" ".join(t for _, t in documents) * 4))[:size],
        "one letter": lambda: "a" * 50_000,
        "two letters": lambda: "ab" * 50_000,
        "accents": lambda: "".join(rng.choices("éèàçüñab中文😀", k=100_000)),
    }[kind]()
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    began = time.time()
    ids = PieceModel(queries.piece_model()).encode(text)
    took = time.time() - began
    assert ids == library.encode(text, add_eos=True)
    assert took < 60


def spark_hash(*words):
    """Hash of several texts as Spark makes it: each one's hash seeds the next."""
    seed = 42
    for word in words:
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def test_quality_against_brute_force(spark, sf_dir, documents):
    import math

    good_ids = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{sf_dir}/labels.parquet' WHERE quality = 1").fetchall()}
    grams = {}
    for doc, text in documents:
        words = WORD.findall(text)
        grams[doc] = [spark_hash(w) % BUCKETS for w in words] + [spark_hash(a, b) % BUCKETS for a, b in zip(words, words[1:])]
    raw = Counter(g for doc in grams for g in grams[doc])
    good = Counter(g for doc in grams if doc in good_ids for g in grams[doc])
    share = sum(good.values()) / sum(raw.values())
    table = {g: round(1e6 * math.log((good[g] + SMOOTHING) / (raw[g] * share + SMOOTHING))) for g in raw}
    got = {r.doc_id: r for r in queries.QUERIES["op3_quality_rules"](spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for doc, text in documents:
        words, row = WORD.findall(text), got[doc]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert row.n_dup_lines == len(lines) - len(set(lines)) and row.n_repeat_words == len(repeated)
        failed = len(words) < MIN_WORDS or 100 * len(repeated) > 50 * len(words)
        score = sum(table[g] for g in grams[doc]) / 1e6 / len(grams[doc]) if grams[doc] else None
        assert row.base_failed == failed
        assert row.kept == (not failed and score >= THRESHOLD)


def test_sharding_law(spark, sf_dir, documents):
    import zlib

    rows = queries.QUERIES["op8_shard_documents"](spark, sf_dir).collect()
    texts = dict(documents)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        body = texts[r.doc_id].encode()
        assert r.size == len(body) + 16 and r.text_crc32 == zlib.crc32(body) and 0 <= r.shard < 40
        assert r.grown_shard in (r.shard, 40)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert 0 < sum(r.grown_shard == 40 for r in rows) < len(rows) / 10


def test_sharding_placement(spark, sf_dir):
    """The weighted draws of region, rack and shard in plain Python, for every row."""
    def place(nodes, doc):
        def draw(node):
            h = xxhash.xxh64_intdigest(node.name.encode(), seed=42)
            bits = xxhash.xxh64_intdigest(struct.pack("<q", doc), seed=h) >> 11
            return math.log((bits + 0.5) / 2**53) / node.weight

        best = max(nodes, key=draw)
        return place(best.children, doc) if best.children else best.shard

    tree = ShardTree.regular(regions=2, racks=5, shards=4)
    for r in queries.QUERIES["op8_shard_documents"](spark, sf_dir).collect():
        assert r.shard == place(tree.regions, r.doc_id) and r.grown_shard == place(tree.grown().regions, r.doc_id)


def test_sharding_is_even_and_moves_little(spark):
    from pyspark.sql import functions as F

    tree = ShardTree.regular(2, 5, 4)
    heavier = tree.with_weight(7, 3.0)
    rows = spark.range(40_000).select(tree.place(F.col("id")).alias("a"), heavier.place(F.col("id")).alias("b")).collect()
    counts = Counter(r.a for r in rows)
    assert min(counts.values()) > 850 and max(counts.values()) < 1150
    # Only the region that holds the changed shard gains rows.
    assert all(r.b // 20 == 0 for r in rows if r.a != r.b)


def test_pipeline_stages(spark, sf_dir, documents):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(function(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        counts.append(docs.count())
        if name == "quality_rules":
            verdicts = queries.QUERIES["op3_quality_rules"](spark, sf_dir).where("kept").collect()
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in verdicts)
        if name == "exact_copies":
            plain = [re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in docs.collect()]
            assert len(plain) == len(set(plain))
        if name == "near_copies":
            kept = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
            before = {r.doc_id: brute_fingerprint(r.text) for r in last}
            assert sorted(kept) == sorted(set(brute_components(before).values()))
        last = docs.collect()
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert out.count() == counts[-1]
    # Words taken from each source follow the mix of what the stage was given.
    assert Counter(r.doc_id for r in docs.collect()).most_common(1)[0][1] <= 3
