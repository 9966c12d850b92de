"""SimHash near-dedup: fingerprints, pigeonhole blocks, verified links, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.llm.common import keep_documents, text_key, whole_text
from questmart.llm.components import smallest_reachable
from questmart.llm.shipping import ship_package
from questmart.session import stage

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 2
BLOCKS = 5


def shingles(text: str, shingle_words: int) -> list[bytes]:
    """Runs of ``shingle_words`` words; of fewer words the only run is all of them. No words: none.

    Bytes lower-case A-Z and split at the six blanks only, which is what the built-in byte methods do.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) < shingle_words:
        return [b" ".join(words)] if words else []
    return [b" ".join(s) for s in zip(*(words[i:] for i in range(shingle_words)))]


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits; a bit is set when over half of the shingles' hashes have it. No words: zero."""
    found = shingles(text, shingle_words)
    if not found:
        return 0
    counts, step = np.zeros(64, np.int64), 1 << 16
    for begin in range(0, len(found), step):
        part = found[begin : begin + step]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in part), np.uint64, len(part))
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(found)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) per row; fp is the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = batch.columns
            prints = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(prints)], ["doc_id", "text_key", "fp"])

    ship_package(docs.sparkSession)
    raw = whole_text(text)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_key(raw).alias("text_key"), raw.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def block_masks(distance: int = MAX_DISTANCE, blocks: int = BLOCKS) -> list[int]:
    """Masks of all choices of blocks - distance blocks: two prints at most ``distance`` bits apart agree on one choice.

    More blocks than distance + 1 make each shared key longer, so that far fewer prints meet by chance.
    """
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def close_pairs(prints: DataFrame, distance: int = MAX_DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints at most ``distance`` bits apart. ``prints``: distinct fp."""
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("value"))
            for i, mask in enumerate(block_masks(distance, blocks))
        ]
    )
    blocked = stage(prints.select("fp", F.explode(keys).alias("key")).select("fp", "key.block", "key.value"), "blocks")
    # A block value that one print has alone leads nowhere.
    shared = blocked.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    meeting = stage(blocked.join(shared, ["block", "value"]), "shared-blocks")
    left, right = meeting.withColumnRenamed("fp", "a"), meeting.withColumnRenamed("fp", "b")
    differing: Column = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = left.join(right, ["block", "value"]).where((F.col("a") < F.col("b")) & (differing <= distance))
    return pairs.select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", distance: int = MAX_DISTANCE, blocks: int = BLOCKS
) -> DataFrame:
    """doc_id, text_key, fingerprint (16 hex digits), component_id, component: one row per input row.

    Fingerprints at most ``distance`` bits apart are linked; component_id is the smallest id reachable over links. Equal
    fingerprints are one node, so copies never make pairs. Texts without words have fingerprint zero and are linked like
    any other; null counts as empty. Null ids are never the smallest, except where a component has no other: component_id
    is then null, but ``component``, the fingerprint that stands for it, never is. Repeated rows get the same result; an empty table gives an empty result. Other columns are not read.
    """
    rows = stage(fingerprints(docs, id_column, text), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    links = close_pairs(nodes.select("fp"), distance, blocks)
    labels = nodes.select(F.col("fp").alias("node"), F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id").alias("id")).alias("label"))
    parts = smallest_reachable(links, labels)
    # Stored, so that a fingerprint shared by very many rows meets a plain table and can be split.
    parts = stage(parts.select(F.col("node").alias("_fp"), F.col("label.id").alias("component_id"), F.col("root").alias("component")), "components")
    return rows.join(parts, F.col("fp") == F.col("_fp")).select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component"
    )


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per component, unchanged: the smallest id, null ids last, then the smallest text key."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    chosen = near_duplicates(docs, id_column, text).groupBy("component").agg(first).select("first.doc_id", "first.text_key")
    return keep_documents(docs, chosen, id_column, text).select("_row.*")
