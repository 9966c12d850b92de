"""Byte-level BPE against the public library, round trips, and odd tables."""

import base64
import hashlib
import random

import pytest
import tiktoken

from questmart.llm import bpe, queries

SCHEMA = "doc_id long, text string, ids string, n_tokens long, source string"


@pytest.fixture(scope="module")
def library():
    path, pattern = queries.byte_ranks()
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def model():
    return bpe.load_model(*queries.byte_ranks())


def test_query_against_the_library(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_every_kind_of_character(model, library):
    rng = random.Random(5)
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for limit in (0x80, 0x100, 0x10000, 0x110000):
        some = [c for c in every if c < limit]
        for _ in range(40):
            text = "".join(chr(rng.choice(some)) if rng.random() < 0.5 else rng.choice(" \t\n\x1c'sdlt1Ab ") for _ in range(200))
            ids = model.encode(text)
            assert ids == library.encode_ordinary(text) and model.decode(ids) == text.encode()


@pytest.mark.parametrize(
    "text",
    ["a" * 200_000, "ab" * 100_000, "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)), " " * 100_000 + "x", "日本語" * 30_000],
    ids=["one letter", "two letters", "random letters", "blanks", "three bytes each"],
)
def test_very_long_pre_tokens(model, library, text):
    assert model.encode(text) == library.encode_ordinary(text)


def test_many_pre_tokens_share_a_queue_like_one_each(model):
    rng = random.Random(2)
    tokens = ["".join(rng.choices("abcde the", k=rng.randrange(1, 30))).encode() for _ in range(2_000)]
    assert model.encode_tokens(tokens) == [model.encode_tokens([token])[0] for token in tokens]


def test_rank_queue_gives_the_lowest_rank_and_leftmost_position():
    queue, rng, held = bpe.RankQueue(70_000), random.Random(3), {}
    for _ in range(3_000):
        if held and rng.random() < 0.4:
            rank = queue.lowest()
            assert rank == min(held)
            assert queue.take(rank) == sorted(held.pop(rank), reverse=True)
        else:
            rank, position = rng.randrange(70_000) % rng.choice([5, 70_000]), rng.randrange(1_000)
            queue.push(rank, [position])
            held.setdefault(rank, []).append(position)
    while held:
        queue.take(queue.lowest())
        held.pop(min(held))
    assert queue.lowest() == bpe.NONE


def test_cache_generations(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_TOKENS", 3)
    model = bpe.BytePairModel(*queries.byte_ranks())
    for text in ("one two three four", "five six seven eight", "one two nine ten", "five one eleven two"):
        assert model.encode(text) == library.encode_ordinary(text)
        assert len(model.cache) <= 3 + 8


def test_odd_tables(spark, library):
    path, pattern = queries.byte_ranks()
    long = " ".join(f"w{i % 701}x{i % 13}" for i in range(30_000))
    given = [(1, "plain text"), (1, "plain text"), (2, None), (3, ""), (4, " \t\n"), (None, "naïve 中文 😀 x\u0000y"), (5, long)]
    docs = spark.createDataFrame([(d, t, "i", 1, "s") for d, t in given], SCHEMA)
    encoded = bpe.encode_documents(docs, path, pattern)
    rows = sorted(((r.doc_id or 0, list(r.ids)) for r in encoded.collect()))
    assert rows == sorted((d or 0, library.encode_ordinary(t or "")) for d, t in given)
    decoded = sorted((r.doc_id or 0, bytes(r.decoded)) for r in bpe.decode_documents(encoded, path, pattern).collect())
    assert decoded == sorted((d or 0, (t or "").encode()) for d, t in given)
    none = spark.createDataFrame([], SCHEMA)
    assert bpe.digest_documents(none, path, pattern).count() == 0 and bpe.encode_documents(none, path, pattern).count() == 0
    assert bpe.digest_documents(docs, path, pattern).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_new_pre_tokens_are_merged_together(model, library, monkeypatch):
    """pre-tokens not met before must not cost a queue entry for each of their merges."""
    rng, pushed, push = random.Random(6), [], bpe.RankQueue.push
    parts = "the and ing that tion en er ción lich wh é ñ th a o s".split()
    tokens = list({"".join(rng.choices(parts, k=rng.randrange(2, 6))) for _ in range(30_000)})
    monkeypatch.setattr(bpe.RankQueue, "push", lambda self, rank, positions: (pushed.append(rank), push(self, rank, positions))[1])
    ids = model.encode_tokens([token.encode() for token in tokens])
    assert len(pushed) < len(tokens) / 2
    assert ids == [tuple(library.encode_ordinary(token)) for token in tokens]


@pytest.mark.parametrize("positions", [1, 10**9], ids=["together", "one by one"])
def test_merges_together_equal_merges_one_by_one(model, library, monkeypatch, positions):
    monkeypatch.setattr(bpe, "ARRAY_POSITIONS", positions)
    rng = random.Random(7)
    some = [["a", "aa", "ab", "aba"], ["the", "that", "hat", "nd", "th", "tion", "ation", "ng", "ing"], list("-=."), ["日本", "語"], list("etaoin")]
    tokens = ["".join(rng.choices(rng.choice(some), k=rng.choice([1, 3, 9, 400]))) for _ in range(600)] + ["the" * 5_000, "a" * 9_999]
    assert model.encode_tokens([token.encode() for token in tokens]) == [tuple(library.encode_ordinary(token)) for token in tokens]


def test_a_text_that_cannot_be_encoded_leaves_the_cache_whole(library):
    model = bpe.BytePairModel(*queries.byte_ranks())
    with pytest.raises(UnicodeEncodeError):
        model.encode("fresh words before \ud800 and behind")
    text = "fresh words before and behind"
    assert model.encode(text) == library.encode_ordinary(text)
    with pytest.raises(LookupError):
        model.decode([model.size])


def test_parts_of_a_batch_and_sliced_ids(spark, library):
    path, pattern = queries.byte_ranks()
    model = bpe.load_model(path, pattern)
    texts = ["", "one two", "", "", "three  four\n\n", ""]
    assert list(model.encode_all(texts)) == [library.encode_ordinary(text) for text in texts]
    assert list(model.encode_all([])) == [] and list(model.encode_all([""])) == [[]]
    encoded = spark.createDataFrame([(1, None), (2, []), (3, library.encode_ordinary("five")), (4, None)], "doc_id long, ids array<int>")
    decoded = {r.doc_id: bytes(r.decoded) for r in bpe.decode_documents(encoded, path, pattern).collect()}
    assert decoded == {1: b"", 2: b"", 3: b"five", 4: b""}
