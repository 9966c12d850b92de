"""Substring dedup: words inside passages that occur earlier, found in prefix-partitioned suffix trees.

Only suffixes of repeated passages enter a tree. Every window of WINDOW words has an anchor: the least of its hashed
GRAM-word sequences, the leftmost of equals. Equal windows have equal anchors, so a window whose anchor occurs once is
unique. Consecutive windows with one anchor form a bundle; equal bundles (by a 128-bit digest of their words) are aggregated
to their first occurrence before anything is gathered, so a passage shared by any number of documents is one small row.
Bundles whose anchor has others fetch their words from the document of their first occurrence. They are split into groups by
a prefix of variable length: the anchor's words, and for anchors with more bundles than a tree may hold, all WINDOW words of
the window, at which length the prefix is itself a deep node and a plain minimum finds its first suffix. Each group's
suffix tree is built top down; internal nodes WINDOW words deep are the repeats, and their first suffix stays.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from questmart.llm.common import LAST_ID, session_buckets, text_key, whole_text
from questmart.llm.shipping import ship_package
from questmart.session import stage

WINDOW = 20
GRAM = 6
# Most bundles of one anchor that a tree is built from.
TREE_BUNDLES = 4_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """Hash of each word, remembered; emptied when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def anchors(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per bundle: anchor hash, first window, number of windows."""
    count = len(words) - WINDOW + 1
    if count < 1:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    grams = np.zeros(len(words) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        grams = grams * _BASE + hashes[i : len(words) - GRAM + 1 + i]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    spans = np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1)
    at = spans.argmin(axis=1) + np.arange(count)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return grams[at[first]].view(np.int64), first, np.diff(np.r_[first, count])


def words_of(text: str) -> list[bytes]:
    """Words between the six blanks, which are what splitting bytes uses."""
    return text.encode("utf-8", "surrogatepass").split()


# -- which anchors repeat -------------------------------------------------------------------------------------------


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, salt, ref, at, windows, n) per bundle. A key seen more than once in a batch is known to repeat: its rows go
    their own ways by salt, and one row without ref tells the other batches, so a frequent key never gathers."""
    for batch in batches:
        found = [anchors(words_of(text.as_py())) for text in batch.column(1)]
        sizes = np.fromiter((len(keys) for keys, _, _ in found), np.int64, len(found))
        if not sizes.sum():
            continue
        key, at, windows = (np.concatenate([part[i] for part in found]) for i in range(3))
        ref = np.repeat(batch.column(0).to_numpy(), sizes)
        order = np.argsort(key)
        fresh = np.r_[True, key[order][1:] != key[order][:-1]]
        begins = np.flatnonzero(fresh)
        counts = np.diff(np.r_[begins, len(key)])
        sure = np.empty(len(key), bool)
        sure[order] = np.repeat(counts > 1, counts)
        told = key[order[begins[counts > 1]]]
        none = np.zeros(len(told), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[key, told]),
                pa.array(np.r_[np.where(sure, 1 + (ref & 1023), 0), none].astype(np.int32)),
                pa.array(np.r_[ref, none], mask=np.r_[np.zeros(len(key), bool), np.ones(len(told), bool)]),
                pa.array(np.r_[at, none].astype(np.int32)),
                pa.array(np.r_[windows, none].astype(np.int32)),
                pa.array(np.r_[np.where(sure, 2, 1), none + 2].astype(np.int32)),
            ],
            ["key", "salt", "ref", "at", "windows", "n"],
        )


def repeated_bundles(docs: DataFrame) -> DataFrame:
    """(ref, keys, starts, windows): per document the bundles whose anchor occurs more than once in the table, in order.

    ``docs``: (ref, text). Rows that repeat make all of their anchors repeat, which costs time and changes nothing.
    """
    rows = docs.select("ref", "text").mapInArrow(_anchor_rows, "key long, salt int, ref long, at int, windows int, n int")
    together = Window.partitionBy("key", "salt")
    repeated = rows.withColumn("total", F.sum("n").over(together)).where("total > 1 AND ref IS NOT NULL")
    # A document has at most as many bundles as words, so its list is bounded by its text. Repeated rows give them again.
    listed = repeated.groupBy("ref").agg(F.array_sort(F.collect_set(F.struct("at", "key", "windows"))).alias("b"))
    return listed.select("ref", F.col("b.key").alias("keys"), F.col("b.at").alias("starts"), F.col("b.windows").alias("windows"))


# -- documents beside their repeated bundles ------------------------------------------------------------------------


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts words. Documents without a repeated anchor are finished here and leave their text behind."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            part = batch.slice(begin, 500)
            counts, digests, texts = [], [], []
            for text, keys in zip(part.column("text"), part.column("keys")):
                text = text.as_py()
                words = words_of(text)
                counts.append(len(words))
                digests.append(None if keys.is_valid else hashlib.sha256(b" ".join(words)).hexdigest())
                texts.append(text if keys.is_valid else None)
            made = {"n_words": pa.array(counts, pa.int64()), "digest": pa.array(digests, pa.string()), "text": pa.array(texts, pa.string())}
            columns = [made[c] if c in made else part.column(c) for c in BESIDE]
            yield pa.RecordBatch.from_arrays(columns, list(BESIDE))


BESIDE = {
    "ref": "long", "doc": "long", "text_key": "long", "no_id": "boolean", "n_words": "long", "digest": "string", "text": "string",
    "keys": "array<long>", "starts": "array<int>", "windows": "array<int>",
}


def _store_beside(docs: DataFrame, repeated: DataFrame) -> tuple[DataFrame, str]:
    """The stored table and its name. Bucketed by document, so that the later joins need no second shuffle of the texts.
    ``text`` is null where no bundle has a repeated anchor."""
    spark, name = docs.sparkSession, f"passages_{uuid.uuid4().hex}"
    buckets = session_buckets(spark)
    joined = docs.repartition(buckets, "ref").join(repeated.repartition(buckets, "ref"), "ref", "left")
    (
        joined.mapInArrow(_beside, ", ".join(f"{name} {kind}" for name, kind in BESIDE.items()))
        .write.format("parquet")
        .option("compression", "zstd")
        .bucketBy(buckets, "ref")
        .saveAsTable(name)
    )
    return spark.table(name), name


def _stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """A compact stored copy and its name, so that it can be dropped when the next one is stored."""
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.format("parquet").option("compression", "zstd").saveAsTable(name)
    return df.sparkSession.table(name), name


# -- bundles and trees ----------------------------------------------------------------------------------------------


def _bundle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "h1", "h2", "doc", "text_key", "at", "windows"]
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            part = batch.slice(begin, 500)
            digests = []
            for text, starts, windows in zip(*(part.column(c) for c in ("text", "starts", "windows"))):
                words = words_of(text.as_py())
                for first, count in zip(starts.as_py(), windows.as_py()):
                    passage = b" ".join(words[first : first + count + WINDOW - 1])
                    digests.append(hashlib.blake2b(passage, digest_size=16).digest())
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            lists = part.column("keys")
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays(
                [
                    lists.flatten(),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    part.column("doc").take(pa.array(owner)),
                    part.column("text_key").take(pa.array(owner)),
                    part.column("starts").flatten(),
                    part.column("windows").flatten(),
                ],
                names,
            )


_PASSAGE = pa.schema(
    [("key", pa.int64()), ("windows", pa.int32()), ("words", pa.binary()), ("doc", pa.int64()), ("text_key", pa.int64()), ("at", pa.int32())]
)
_PASSAGE_SQL = "key long, windows int, words binary, doc long, text_key long, at int"


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the bundles that a document was asked for."""
    done = None
    for batch in batches:
        for begin in range(0, batch.num_rows, 100):
            out = []
            for row in batch.slice(begin, 100).to_pylist():
                # Repeated rows follow each other and hold the same passages.
                own = (row["doc"], row["text_key"])
                if own == done:
                    continue
                done, words = own, words_of(row["text"])
                for b in row["wanted"]:
                    if (b["doc"], b["text_key"]) == own:
                        passage = b" ".join(words[b["at"] : b["at"] + b["windows"] + WINDOW - 1])
                        out.append((b["key"], b["windows"], passage, *own, b["at"]))
            columns = list(zip(*out)) if out else [[] for _ in _PASSAGE]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PASSAGE)], schema=_PASSAGE)


def _with_words(beside: DataFrame, bundles: DataFrame) -> DataFrame:
    """``bundles`` with their words, from the documents of their first occurrences: the texts stay where they are."""
    wanted = bundles.groupBy(F.xxhash64("doc", "text_key").alias("ref")).agg(
        F.collect_list(F.struct("key", "windows", "doc", "text_key", "at")).alias("wanted")
    )
    # Asking documents costs one bounded list each: a document has at most as many bundles as words.
    joined = beside.where("text IS NOT NULL").select("ref", "doc", "text_key", "text").join(wanted.hint("merge"), "ref")
    return joined.select("doc", "text_key", "text", "wanted").mapInArrow(_passages, _PASSAGE_SQL)


def deep_nodes(suffixes: list[tuple[list[bytes], int]], depth: int) -> Iterator[list[int]]:
    """Leaves (indexes into ``suffixes``) below each node of the suffix tree that is ``depth`` words deep.

    ``suffixes``: (words, where the suffix begins), each with at least ``depth`` words left. The tree is built top down:
    a node's edge is as long as all its suffixes agree, then they part by their next word. Suffixes alone in a branch are
    reported as a node of one leaf.
    """
    open_nodes = [(list(range(len(suffixes))), 0)]
    while open_nodes:
        leaves, at = open_nodes.pop()
        while at < depth and len(leaves) > 1:
            branches: dict[bytes, list[int]] = {}
            for leaf in leaves:
                words, begin = suffixes[leaf]
                branches.setdefault(words[begin + at], []).append(leaf)
            at += 1
            if len(branches) > 1:
                open_nodes.extend((branch, at) for branch in branches.values())
                break
        else:
            yield leaves


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First suffix of each deep node, for each group of bundles; groups come one behind the other."""

    def bundles() -> Iterator[dict]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1_000):
                yield from batch.slice(begin, 1_000).to_pylist()

    out: list[dict] = []
    for _, group in itertools.groupby(bundles(), key=lambda row: row["key"]):
        suffixes, places = [], []
        for row in group:
            words = row["words"].split(b" ")
            for i in range(row["windows"]):
                suffixes.append((words, i))
                places.append((row["doc"], row["text_key"], row["at"] + i))
        for leaves in deep_nodes(suffixes, WINDOW):
            doc, text_key_, at = min(places[leaf] for leaf in leaves)
            out.append({"doc": doc, "text_key": text_key_, "at": at, "windows": 1})
        if len(out) >= 20_000:
            yield pa.RecordBatch.from_pylist(out, schema=_FIRST)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema=_FIRST)


_FIRST = pa.schema([("doc", pa.int64()), ("text_key", pa.int64()), ("at", pa.int32()), ("windows", pa.int32())])
_FIRST_SQL = "doc long, text_key long, at int, windows int"


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the bundles by itself, under its full prefix of WINDOW words."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            words = row["words"].split(b" ")
            for i in range(row["windows"]):
                rows.append({"prefix": b" ".join(words[i : i + WINDOW]), "doc": row["doc"], "text_key": row["text_key"], "at": row["at"] + i})
        schema = pa.schema([("prefix", pa.binary()), ("doc", pa.int64()), ("text_key", pa.int64()), ("at", pa.int32())])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def first_windows(beside: DataFrame, tree_bundles: int = TREE_BUNDLES) -> tuple[DataFrame, str]:
    """(doc, text_key, at, windows): runs of windows that occur nowhere earlier, of all windows with a repeated anchor; and
    the name of the table it reads, to be dropped when the rows are stored."""
    rows = beside.where("text IS NOT NULL").select("doc", "text_key", "text", "keys", "starts", "windows").mapInArrow(
        _bundle_rows, "key long, h1 long, h2 long, doc long, text_key long, at int, windows int"
    )
    first = F.min(F.struct("doc", "text_key", "at", "windows")).alias("first")
    bundles, name = _stored(rows.groupBy("key", "h1", "h2").agg(first).select("key", "first.*"), "bundles")
    several = bundles.groupBy("key").agg(F.count("*").alias("bundles")).where("bundles > 1")
    marked, marked_name = _stored(bundles.join(several, "key", "left"), "marked_bundles")
    bundles.sparkSession.sql(f"DROP TABLE {name}")
    alone = marked.where("bundles IS NULL").select("doc", "text_key", "at", "windows")
    grouped = _with_words(beside, marked.where(F.col("bundles") <= tree_bundles)).repartition("key").sortWithinPartitions("key")
    trees = grouped.mapInArrow(_tree_rows, _FIRST_SQL)
    long_prefix = (
        _with_words(beside, marked.where(F.col("bundles") > tree_bundles))
        .mapInArrow(_window_rows, "prefix binary, doc long, text_key long, at int")
        .groupBy("prefix")
        .agg(F.min(F.struct("doc", "text_key", "at")).alias("first"))
        .select("first.*", F.lit(1).alias("windows"))
    )
    return alone.unionAll(trees).unionAll(long_prefix), marked_name


# -- removal --------------------------------------------------------------------------------------------------------


def _runs(count: int, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which of ``count`` places lie in one of the runs of n places from at."""
    return np.cumsum(np.bincount(at, minlength=count + 1) - np.bincount(at + n, minlength=count + 1))[:count] > 0


def covered_words(count: int, starts: np.ndarray, windows: np.ndarray, first_at: np.ndarray, first_n: np.ndarray) -> np.ndarray:
    """Which of ``count`` words lie in a window that occurs earlier: the windows of the bundles but the first ones."""
    places = count - WINDOW + 1
    if places < 1:
        return np.zeros(count, bool)
    at = np.flatnonzero(_runs(places, starts, windows) & ~_runs(places, first_at, first_n))
    return _runs(count, at, np.full(len(at), WINDOW))


_REMOVED = pa.struct([("begin", pa.int64()), ("end", pa.int64())])


def _flat(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each row's list in the values of all lists; a null list is empty."""
    sizes = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False)
    return np.r_[0, np.cumsum(sizes, dtype=np.int64)], column.flatten()


def _final_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            part = batch.slice(begin, 500)
            doc, key = part.column("doc").to_numpy(), part.column("text_key").to_numpy()
            bounds, starts = _flat(part.column("starts"))
            starts, windows = starts.to_numpy(), _flat(part.column("windows"))[1].to_numpy()
            first_bounds, firsts = _flat(part.column("firsts"))
            owner = np.repeat(np.arange(part.num_rows), np.diff(first_bounds))
            # Documents may share a ref by chance: only what names the document itself counts.
            own = (firsts.field("doc").to_numpy() == doc[owner]) & (firsts.field("text_key").to_numpy() == key[owner])
            first_at, first_n = firsts.field("at").to_numpy(), firsts.field("windows").to_numpy()
            counts, digests, edges, sizes = [], part.column("digest").to_pylist(), [], []
            for i, text in enumerate(part.column("text")):
                removed = 0
                if digests[i] is None:
                    words = words_of(text.as_py())
                    mine, of = slice(bounds[i], bounds[i + 1]), slice(first_bounds[i], first_bounds[i + 1])
                    covered = covered_words(len(words), starts[mine], windows[mine], first_at[of][own[of]], first_n[of][own[of]])
                    removed = int(covered.sum())
                    kept = words if not removed else list(itertools.compress(words, (~covered).tolist()))
                    digests[i] = hashlib.sha256(b" ".join(kept)).hexdigest()
                counts.append(removed)
                spans = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8))) if removed else np.zeros(0, np.int64)
                edges.append(spans)
                sizes.append(len(spans) // 2)
            spans = np.concatenate(edges).reshape(-1, 2)
            removed = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(spans[:, 0].astype(np.int64)), pa.array(spans[:, 1].astype(np.int64))], fields=list(_REMOVED)),
            )
            doc_id = pc.if_else(part.column("no_id"), pa.scalar(None, pa.int64()), part.column("doc"))
            yield pa.RecordBatch.from_arrays(
                [doc_id, part.column("n_words"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), removed],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"],
            )


def dedup_substrings(docs: DataFrame, id_column: str = "doc_id", text: str = "text", tree_bundles: int = TREE_BUNDLES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, removed (ranges of words): one row per input row.

    A word goes when a window of WINDOW consecutive words covers it whose words also start earlier: in a document with a
    smaller id (null ids last), or earlier in the same document. Windows are judged on the input. Rows with the same id
    and text are one document and get the same result; with the same id but other texts they are ordered by a hash of the
    text. Null and empty texts have no words; an empty table gives an empty result. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    raw, own = whole_text(text), F.col(id_column).cast("long")
    rows = docs.select(
        F.coalesce(own, F.lit(LAST_ID)).alias("doc"), own.isNull().alias("no_id"), text_key(raw).alias("text_key"), raw.alias("text")
    ).withColumn("ref", F.xxhash64("doc", "text_key"))
    beside, beside_name = _store_beside(rows, repeated_bundles(rows))
    firsts, marked_name = first_windows(beside, tree_bundles)
    firsts = firsts.withColumn("ref", F.xxhash64("doc", "text_key"))
    per_document = firsts.groupBy("ref").agg(F.collect_list(F.struct("doc", "text_key", "at", "windows")).alias("firsts"))
    joined = beside.join(per_document, "ref", "left").select("doc", "no_id", "text_key", "n_words", "digest", "text", "starts", "windows", "firsts")
    result = stage(
        joined.mapInArrow(
            _final_rows, "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<begin: long, end: long>>"
        ),
        "substring-verdicts",
    )
    for name in (beside_name, marked_name):
        docs.sparkSession.sql(f"DROP TABLE {name}")
    return result
