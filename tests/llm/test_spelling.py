"""Spelling variants against brute force, on a whole given table and on small odd ones."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from questmart.llm import queries, spelling

SCHEMA = "doc_id long, text string, word string, n string, form long, root string"


def brute(rows, typo_every=97, min_chars=5, min_count=3):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if typo_every and h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= min_count}
    masked = defaultdict(set)
    for w in words:
        for k in range(len(w) + 1):
            masked[w[:k], w[k:]].add(w)
            if k < len(w):
                masked[w[:k], w[k + 1 :]].add(w)
    near = defaultdict(set)
    for group in masked.values():
        for w in group:
            near[w] |= group
    forms = {}
    for w, n in words.items():
        others = near[w] - {w}
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = (len(others), best if best and words[best] >= 2 * n else None)
    out = {}
    for w, n in words.items():
        root = w
        while forms[root][1]:
            root = forms[root][1]
        count, form = forms[w]
        out[w] = (form, root, n, count, words.get(form))
    return out


def collected(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def given(spark, rows):
    return spark.createDataFrame([(d, t, "w", "n", 1, "r") for d, t in rows], SCHEMA)


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(rows)
    assert any(w[0] for w in want.values()) and any(w[0] and w[0] != w[1] for w in want.values())
    assert collected(queries.QUERIES["op13_spelling_variants"](spark, sf_dir)) == want


@pytest.mark.parametrize("tile_rows", [1, 3, 1000])
def test_a_group_in_many_tiles(spark, tile_rows):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"commonpart{x}{y}" for x in letters for y in letters[:6]] + ["commonpart", "commonparta", "ommonpart", "xcommonpart"]
    rows = [(i, f"{w} " * (3 + i % 5)) for i, w in enumerate(words)]
    assert collected(spelling.spelling_variants(given(spark, rows), tile_rows=tile_rows)) == brute(rows)


def test_edits_at_every_place_of_short_and_repeating_words(spark):
    base = ["aaaaa", "aaaaaa", "aaaaaaa", "ababa", "babab", "ababab", "aaaab", "baaaa", "abcde", "abde", "bcde", "abcd", "zabcde", "abzde", "éabcd", "ÉABCD"]
    rows = [(i, f"{w} {w} {w} " * (1 + i % 3)) for i, w in enumerate(base)]
    for least in (1, 5):
        got = collected(spelling.spelling_variants(given(spark, rows), min_chars=least, typo_every=0))
        assert got == brute(rows, 0, least)


def test_odd_tables(spark):
    long = "xy" * 400
    rows = [(1, "Word word WORD words"), (1, "Word word WORD words"), (2, None), (3, ""), (None, "word words"), (4, f"{long} {long}y {long[1:]} " * 3)]
    got = collected(spelling.spelling_variants(given(spark, rows), min_chars=4, typo_every=0))
    assert got == brute(rows, 0, 4) and got["words"][0] == "word"
    assert got[long][3] == 2
    huge = "x" * 300_000
    got = collected(spelling.spelling_variants(given(spark, [(1, f"{huge} {huge}y {huge[1:]}z " * 3)]), typo_every=0))
    assert {w[-2:]: (len(w), r[3]) for w, r in got.items()} == {"xx": (300_000, 2), "xy": (300_001, 1), "xz": (300_000, 1)}
    assert spelling.spelling_variants(given(spark, [])).count() == 0
    assert collected(spelling.spelling_variants(given(spark, [(None, "word " * 5), (None, None)]), min_chars=1)) == brute([(None, "word " * 5)], 97, 1)
