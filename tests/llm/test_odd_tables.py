"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from questmart.llm import chat, sentencepiece, substrings, warc
from questmart.llm.components import smallest_reachable
from questmart.llm.exact_dedup import DigestIndex, digest_rows, exact_dedup, keep_one_copy, length_ranges
from questmart.llm.line_dedup import LineRuns, dedup_lines
from questmart.llm.mixing import mix, mix_plan
from questmart.llm.quality import keep_good, quality_verdicts
from questmart.llm.queries import piece_model
from questmart.llm.sharding import ShardTree, shard_rows
from questmart.llm.simhash import block_masks, keep_one_of_each, near_duplicates
from questmart.llm.substrings import deep_nodes, dedup_substrings
from questmart.session import new_stage_path

LONG = " ".join(f"w{i % 701}x{i % 13}" for i in range(30_000))
PROSE = " ".join(f"word{i}" for i in range(60))
SCHEMA = "doc_id long, text string, source string, kept boolean, row long, component_id long, _row string, digest string"
ROWS = [
    (1, PROSE),
    (2, PROSE + "  "),
    (2, PROSE + "  "),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (None, PROSE),
    (6, LONG),
    (7, "One line that is long enough\nshort\nONE line that is long enough \n"),
    (8, "one line that is long enough"),
    (9, "naïve ÀÉ 中文 😀 ▁ x\u0000y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, None if d == 3 else f"s{(d or 0) % 2}", True, 7, 0, "r", "d") for d, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def trusted(spark):
    return spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")


def test_empty_tables(spark, none, trusted):
    assert exact_dedup(none).count() == 0 and keep_one_copy(none).columns == none.columns
    assert dedup_lines(none).count() == 0
    assert near_duplicates(none).count() == 0 and keep_one_of_each(none).count() == 0
    assert mix_plan(none).count() == 0 and mix(none).count() == 0
    assert quality_verdicts(none, trusted).count() == 0 and keep_good(none, trusted).count() == 0
    assert shard_rows(none, ShardTree.regular(1, 1, 2)).count() == 0
    assert dedup_substrings(none).count() == 0
    assert sentencepiece.digest_documents(none, piece_model()).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.summarise(chat.format_conversations(talk)).count() == 0


def test_exact_dedup(odd):
    rows = exact_dedup(odd).collect()
    assert len(rows) == len(ROWS)
    copies = [r for r in rows if r.group_size == 4]
    # The longest original stays; of its two repeats only one.
    assert {r.keep_id for r in copies} == {2} and sum(r.kept for r in copies) == 1
    blank = [r for r in rows if r.doc_id in (3, 4, 5)]
    assert {(r.keep_id, r.group_size) for r in blank} == {(5, 3)}
    kept = keep_one_copy(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows) and {r.digest for r in kept.collect()} == {"d"}


def test_digest_index_lasts(spark):
    path = new_stage_path(spark, "index")
    first = spark.createDataFrame([(5, "a b"), (9, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "ab"), (2, "d"), (3, "d")], "doc_id long, text string")
    assert all(r.kept for r in DigestIndex(spark, path, 4).add(first).collect())
    spark.sql(f"DROP TABLE {DigestIndex(spark, path, 4).table}")  # as in a new session: files stay, the name is gone
    got = {r.doc_id: (r.keep_id, r.kept) for r in DigestIndex(spark, path, 4).add(second).collect()}
    assert got == {1: (5, False), 2: (2, True), 3: (2, False)}


@pytest.fixture(scope="module")
def spaced(spark):
    """Groups whose copies differ in blanks only, so that they fall into different ranges of length."""
    rows = [(100 - i, " " * (i % 7) + "x" * (5 + i % 11) + " " * (i % 4)) for i in range(100)] + [(7, "x" * 5), (None, "x" * 6)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_later_batches_lose_their_copies_to_the_index(spark, spaced):
    index = DigestIndex(spark, new_stage_path(spark, "index"), 4)
    rows = digest_rows(spaced, "doc_id", "text")
    parts = length_ranges(rows, 4)
    assert len(parts) == 4 and sum(rows.where(part).count() for part in parts) == rows.count() == 102
    seen, lost = set(), []
    for part in parts:
        batch, groups = index.append(rows.where(part))
        found = {bytes(r.digest) for r in groups.collect()}
        stored = {bytes(r.digest) for r in spark.table(index.table).where(F.col("batch") == batch).collect()}
        assert stored == found - seen
        lost.append(len(found & seen))
        seen |= found
    assert lost[0] == 0 and sum(lost) > 10
    assert spark.table(index.table).count() == len(seen) == 11


@pytest.mark.parametrize("batches", [1, 2, 3, 40])
def test_batches_do_not_show_in_the_result(spaced, batches):
    texts = [(r.doc_id, r.text) for r in spaced.collect()]
    best = {}
    for doc, text in texts:
        order = (-len(text), doc is None, doc or 0)
        best[text.strip()] = min(best.get(text.strip(), (order, doc)), (order, doc), key=lambda found: found[0])
    sizes = {}
    for _, text in texts:
        sizes[text.strip()] = sizes.get(text.strip(), 0) + 1
    want = sorted((str(doc), best[text.strip()][1], sizes[text.strip()]) for doc, text in texts)
    rows = exact_dedup(spaced, batches=batches).collect()
    assert sorted((str(r.doc_id), r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(best)


def test_line_dedup(odd):
    rows = {(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in dedup_lines(odd).collect()}
    assert (7, 4, 0, ROWS[8][1]) in rows and (8, 1, 1, "") in rows and (3, 1, 0, "") in rows
    assert (5, 2, 0, " \t\n") in rows and (2, 1, 1, "") in rows and (None, 1, 1, "") in rows and (1, 1, 0, PROSE) in rows


def test_line_runs_compact(spark):
    runs = LineRuns(spark, buckets=2, fan_in=2)
    for i in range(5):
        runs.add(spark.createDataFrame([(h, h, i) for h in (i, i + 1, 100)], "h1 long, h2 long, owner long"))
    assert len(runs.runs()) <= 3
    assert {(r.h1, r.owner) for r in runs.owners().collect()} == {(0, 0), (100, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 4)}


def test_one_frequent_line(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("the same frequent line\n"), "id").alias("text"))
    rows = dedup_lines(docs).collect()
    assert sum(r.n_dropped for r in rows) == 499 and next(r for r in rows if r.doc_id == 0).n_dropped == 0


def test_near_duplicates(odd):
    rows = near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    parts = {r.doc_id: r.component_id for r in rows}
    assert parts[2] == parts[None] == 1 and parts[3] == parts[4] == parts[5] == 3
    assert next(r.fingerprint for r in rows if r.doc_id == 4) == "0" * 16
    kept = keep_one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(parts.values()))


def test_documents_without_ids_are_not_lost(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "e f g h"), (None, "a b c d")], "doc_id long, text string")
    assert keep_one_of_each(docs).count() == 2


def test_blocks_share_a_key_for_every_close_pair():
    import itertools

    masks = block_masks()
    assert all(any(not ((1 << a | 1 << b) & m) for m in masks) for a, b in itertools.combinations(range(64), 2))


def test_components_of_a_chain(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(200, 201)], "a long, b long")
    labels = spark.createDataFrame([(i, n - i) for i in range(n + 1)] + [(200, 5), (201, 5), (300, 1)], "node long, label long")
    got = {r.node: (r.label, r.root) for r in smallest_reachable(links, labels).collect()}
    assert all(got[i] == (0, n) for i in range(n + 1)) and got[200] == got[201] == (5, 200) and got[300] == (1, 300)


def test_mixing(odd):
    rows = mix_plan(odd).collect()
    assert len(rows) == len(ROWS) and all(r.taken <= 3 * r.size for r in rows)
    assert sum(r.taken for r in rows) <= sum(r.size for r in rows)
    targets = {r.source: (r.target, r.source_size) for r in rows}
    assert all(t <= 3 * s + 1e-6 for t, s in targets.values()) and targets[None] == (0, 0)
    mixed = mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in rows)


def test_mix_reaches_its_targets(spark):
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("a "), (F.col("id") % 7 + 1).cast("int")).alias("text"),
        F.when(F.col("id") < 100, "a").when(F.col("id") < 1_000, "b").otherwise("c").alias("source"),
    )
    rows = mix_plan(docs).collect()
    for source in "abc":
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 21
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in mix_plan(docs.repartition(5)).collect()}


def test_quality(odd, trusted):
    rows = {r.doc_id: r for r in quality_verdicts(odd, trusted).collect()}
    assert rows[3].n_words == 0 and rows[3].score is None and rows[3].base_failed and not rows[3].kept
    assert rows[1].n_words == 60 and not rows[1].base_failed and rows[1].kept
    assert rows[6].n_words == 30_000 and rows[7].n_dup_lines == 0
    kept = keep_good(odd, trusted)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {d for d, r in rows.items() if r.kept}


def test_sharding(odd):
    tree = ShardTree.regular(2, 2, 2)
    rows = shard_rows(odd, tree, tree.grown()).collect()
    assert len(rows) == len(ROWS) and all(r.grown_shard in (r.shard, 8) for r in rows)
    assert next(r.size for r in rows if r.doc_id == 3) == 16
    assert len({r.shard for r in rows if r.doc_id == 2}) == 1


def brute_removed(docs):
    seen, out = set(), {}
    for doc, text in sorted(docs.items()):
        words, gone = re.findall(r"[^\x20\x09-\x0D]+", text), set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("tree_bundles", [substrings.TREE_BUNDLES, 1])
def test_substrings_against_all_windows(spark, tree_bundles):
    import random

    rng = random.Random(3)
    passage = [f"p{i}" for i in range(45)]
    docs = {}
    for doc in range(60):
        words = [f"v{rng.randrange(9)}" for _ in range(rng.randrange(5, 60))]
        if doc % 2:
            cut = rng.randrange(0, 20)
            words[3:3] = passage[cut : cut + rng.randrange(15, 40)]
        docs[doc] = rng.choice([" ", "\n", "  "]).join(words)
    docs |= {60: "same " * 90, 61: " ".join(["a", "b"] * 50), 62: docs[1], 63: "", 64: LONG, 65: LONG}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in dedup_substrings(table, tree_bundles=tree_bundles).collect()}
    assert got == brute_removed(docs)


def test_substrings_of_odd_rows(odd):
    rows = dedup_substrings(odd).collect()
    assert len(rows) == len(ROWS)
    removed = {(r.doc_id, r.n_removed) for r in rows}
    assert {(1, 0), (2, 60), (None, 60), (3, 0), (4, 0)} <= removed


def test_suffix_tree_nodes():
    words = "a b c a b c a b".split()
    suffixes = [(words, i) for i in range(6)]
    assert sorted(sorted(n) for n in deep_nodes(suffixes, 3)) == [[0, 3], [1, 4], [2, 5]]
    classes = {}
    for i in range(6):
        classes.setdefault(tuple(words[i : i + 3]), []).append(i)
    assert sorted(map(sorted, deep_nodes(suffixes, 3))) == sorted(classes.values())


def test_sentencepiece(odd):
    import sentencepiece as library

    model = library.SentencePieceProcessor(model_file=piece_model())
    encoded = sentencepiece.encode_documents(odd, piece_model())
    got = sorted((r.doc_id or 0, list(r.ids)) for r in encoded.collect())
    assert got == sorted((d or 0, model.encode(t or "", add_eos=True)) for d, t in ROWS)
    texts = {r.doc_id: r.decoded for r in sentencepiece.decode_documents(encoded, piece_model()).collect()}
    assert texts[9] == model.decode(model.encode(ROWS[10][1])) and texts[3] == ""


def test_sentencepiece_on_random_texts():
    import random
    import sentencepiece as library

    rng = random.Random(5)
    parts = ["a", "b", " ", "  ", "▁", "\n", "é", "中", "😀", "the", "ing", "aa", "=", "-", "ab"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1_500)] + ["ab" * 900, " " * 333, "a" * 999]
    own, model = sentencepiece.load_model(piece_model()), library.SentencePieceProcessor(model_file=piece_model())
    for text in texts:
        ids = own.encode(text)
        assert ids == model.encode(text, add_eos=True) and own.decode(ids) == model.decode(ids)
    for _ in range(1_500):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32_000)]) for _ in range(rng.randrange(9))]
        assert own.decode(ids) == model.decode(ids)


def test_warc(spark):
    big = "é" * 30_000 + "\r\n\r\nWARC/1.1\r\n" + "x" * 5_000
    pages = [(1, "http://a", big), (2, None, big), (3, "http://b\r\nc", big), (3, "u", big), (4, "u", None), (5, "u", ""), (6, "u", "small"), (7, "u", "small"), (None, "u", big)]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string")
    rows = warc.round_trip(table, keep_payload=True).collect()
    assert len(rows) == len(pages)
    for r in rows:
        html = {p[0]: p[2] or "" for p in pages}[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(html), hashlib.sha1(html).hexdigest())
        expected = ("revisit", 3) if r.page_id in (1, 2, None) else ("response", None)
        assert (r.record_type, r.refers_to) == expected
        # A revisit's payload is that of the response it refers to.
        assert bytes(r.payload) == html


def _rewritten(spark, old, new, change):
    """The archives under ``old`` with each record's lines changed, under ``new``."""
    import gzip

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(old).collect()
    text = "".join(gzip.decompress(f.content).decode() for f in files)
    records = [r for r in text.split("WARC/1.1\r\n") if r.strip()]
    kept = ["WARC/1.1\r\n" + r for r in map(change, records) if r is not None]
    spark.createDataFrame([("".join(kept).rstrip("\n"),)], "value string").coalesce(1).write.option("compression", "gzip").option("lineSep", "\n").text(new)


def test_revisits_are_read_from_their_response(spark):
    body = "<html>" + "copied page " * 200
    pages = spark.createDataFrame([(i, f"u{i}", body) for i in range(1, 5)] + [(9, "u9", "other")], "page_id long, url string, html string")
    path = new_stage_path(spark, "warc-whole")
    warc.write_archives(pages, path)
    rows = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert rows[4].record_type == "response" and all(rows[i].refers_to == 4 for i in (1, 2, 3))
    assert all(bytes(rows[i].payload).decode() == body and rows[i].payload_bytes == len(body) for i in range(1, 5))

    def without_response(record):
        return None if "X-Page-ID: 4\r\n" in record else record

    def told_length(record):
        # What a revisit says about itself does not count.
        return record.replace(f"X-Payload-Length: {len(body)}\r\n", "X-Payload-Length: 5\r\n")

    def other_payload(record):
        digest = hashlib.sha1(body.encode()).hexdigest()
        return record.replace(digest, "0" * 40) if "revisit\r\n" in record.split("WARC-Record-ID")[0] else record

    for change, good in ((lambda r: r, True), (told_length, True), (without_response, False), (other_payload, False)):
        changed = new_stage_path(spark, "warc-changed")
        _rewritten(spark, path, changed, change)
        if good:
            assert {r.page_id: r.payload_bytes for r in warc.read_archives(spark, changed).collect()} == {i: r.payload_bytes for i, r in rows.items()}
        else:
            with pytest.raises(Exception, match="no response with this payload"):
                warc.read_archives(spark, changed).collect()


def test_warc_rejects_damage():
    with pytest.raises(ValueError):
        warc.reassembled([(1, b"ab"), (3, b"c")], 3)
    with pytest.raises(ValueError):
        warc.reassembled([(2, b"c"), (1, b"ab")], 4)
    assert warc.reassembled([(2, b"c"), (1, b"ab")], 3) == b"abc"
    assert warc.unchunked(b"3;x=y\r\nabc\r\n2\r\nde\r\n0\r\nT: v\r\n\r\n") == b"abcde"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def brute_chat(turns):
    turns = sorted(turns, key=lambda t: (t[0] is None, t[0] or 0, t[1] or "", t[2] or ""))
    whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
    loss = "".join(t or "" for _, r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat(spark):
    talks = {
        1: [(0, "user", "</s>[INST] ok & <|end|>\n<|turn|>"), (1, "assistant", "&lt; &amp;nl; <|begin|>")],
        2: [(None, "user", None), (0, None, "x"), (0, None, "x"), (3, "assi\nstant", "y")],
        None: [(0, "assistant", "😀" * 3)],
        4: [(i, "assistant" if i % 2 else "user", "long <text> " * 2_000) for i in range(200)],
    }
    rows = [(c, *t, "extra") for c, turns in talks.items() for t in turns]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    formatted = chat.format_conversations(table)
    assert formatted.where("conv_id = 4").count() > 1
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.summarise(formatted).collect()}
    assert got == {c: brute_chat(turns) for c, turns in talks.items()}


def test_template_language():
    render = chat.compile_template
    text = "{% if a.b == 'x' and not (c or 'y' == 'z') %}{{ a.b | escape }}{% else %}no{% endif %}{{ '<' | escape }}"
    assert "".join(t for t, _ in render(text)({"a": {"b": "x"}, "c": ""})) == "x&lt;"
    folded = chat.fold(chat.parse_template("a{{ 'b' }}{% if 'x' == 'x' %}c{% else %}d{% endif %}{% if 'x' != 'x' %}e{% endif %}"))
    assert folded == (chat.Output(chat.Literal("abc")),)
    pieces = list(render("u{% generation %}v{{ w }}{% endgeneration %}")({"w": "W"}))
    assert pieces == [("u", False), ("v", True), ("W", True)]
    for bad in ("{{ a.__class__ }}", "{{ a | upper }}", "{% for x in %}{% endfor %}", "{% if a %}", "{{ a( }}", "{% import os %}"):
        with pytest.raises(chat.TemplateError):
            render(bad)
    with pytest.raises(chat.TemplateError):
        "".join(t for t, _ in render("{{ a.real }}")({"a": 3}))
