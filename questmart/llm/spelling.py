"""Spelling variants: words one edit apart, found by comparing tiles of padded words, and the forms they stand for.

Words one edit apart agree in all but one of PIECES pieces, so words are grouped by the rest around each piece. A group is
cut into tiles of a bounded number of cells, and pairs of its tiles are spread over the tasks. In a pair of tiles all words
are compared at once: the lengths of the common prefix and the common suffix together reach the longer length minus one
exactly if the words are one edit apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.llm.common import ascii_lower, whole_text
from questmart.llm.shipping import ship_package
from questmart.session import stage

# Words are runs of Latin letters, whose code points are single bytes of ISO-8859-1.
RUN = r"[A-Za-zÀ-ÿ]+"
CHARSET = "ISO-8859-1"
MIN_CHARS = 5
MIN_COUNT = 3
TYPO_EVERY = 97
PIECES = 3
# Rows of a tile, and the most padded code points that a tile or one step of comparing holds.
TILE_ROWS = 512
TILE_CELLS = 4_000_000


def word_counts(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, typo_every: int = TYPO_EVERY
) -> DataFrame:
    """(word, n): lower-cased runs of at least ``min_chars`` letters that occur at least ``min_count`` times.

    One of ``typo_every`` pairs of document and run loses a letter before it counts, drawn by CRC-32; 0 keeps all whole.
    """
    rows = docs.select(F.col(id_column).cast("string").alias("id"), ascii_lower(whole_text(text)).alias("text"))
    runs = rows.select("id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("word"))
    if typo_every:
        draw = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "word").cast("binary"))
        runs = runs.select("word", draw.alias("draw"))
        at = (F.col("draw") % F.char_length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
        runs = runs.select(F.when(F.col("draw") % typo_every == 0, shorter).otherwise(F.col("word")).alias("word"))
    counted = runs.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _cut(shorter: Column, piece: int) -> Column:
    return F.floor(shorter * piece / PIECES).cast("int")


def _groups(words: DataFrame) -> DataFrame:
    """(size, piece, key, code, n): each word in the groups of pairs whose shorter word is as long as it, or one shorter."""
    length = F.char_length("word")
    places = []
    for less in (0, 1):
        size = length - less
        for piece in range(PIECES):
            begin, end = _cut(size, piece), _cut(size, piece + 1)
            rest = size - end
            around = F.concat_ws(" ", F.substring("word", F.lit(1), begin), F.when(rest > 0, F.substring("word", length - rest + 1, rest)).otherwise(""))
            places.append(F.struct(size.alias("size"), F.lit(piece).alias("piece"), F.xxhash64(around).alias("key")))
    return words.select("word", "n", F.explode(F.array(*places)).alias("at")).where("at.size > 0").select(
        "at.size", "at.piece", "at.key", F.encode("word", CHARSET).alias("code"), "n"
    )


BLOCK = ["size", "piece", "key", "low", "high"]


def _blocks(groups: DataFrame, tile_rows: int) -> DataFrame:
    """Rows of ``groups`` in every pair of tiles that their own tile takes part in; groups of one word lead nowhere."""
    counted = groups.groupBy("size", "piece", "key").agg(F.count("*").alias("words")).where("words > 1")
    rows = F.greatest(F.lit(1), F.least(F.lit(tile_rows), F.floor(F.lit(TILE_CELLS) / (F.col("size") + 1))))
    # Sort-merge at every size: the groups grow with the vocabulary, and a group of very many words is split.
    tiled = groups.join(counted.hint("merge"), ["size", "piece", "key"]).withColumn("tiles", F.ceil(F.col("words") / rows).cast("int"))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("code"), F.col("tiles")).cast("int"))
    spread = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("tile", "other"), F.greatest("tile", "other")
    return spread.select("size", "piece", "key", low.alias("low"), high.alias("high"), "tile", "code", "n")


def _padded(data: np.ndarray, begin: np.ndarray, lengths: np.ndarray, width: int, backwards: bool) -> np.ndarray:
    """Words as rows of equal width, zero behind their end; backwards: their last letter first."""
    step = np.arange(width)
    at = begin[:, None] + (lengths[:, None] - 1 - step if backwards else step)
    inside = step < lengths[:, None]
    return np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint8)


def _common(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of rows a and b."""
    differ = rows[a] != rows[b]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])


def _index_pairs(group: np.ndarray, tile: np.ndarray, across: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group, a stretch of one diagonal of the tiles at a time, at most ``most`` pairs.

    Where two different tiles meet (``across``), only pairs with a row from each.
    """
    left, step = np.arange(len(group)), 1
    while True:
        left = left[left + step < len(group)]
        left = left[group[left] == group[left + step]]
        if not len(left):
            return
        a = left[~across[left] | (tile[left] != tile[left + step])]
        for begin in range(0, len(a), most):
            yield a[begin : begin + most], a[begin : begin + most] + step
        step += 1


def near_rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (a, b) of all pairs one edit apart, each pair in one direction; ``table`` holds whole blocks, sorted."""
    codes = table.column("code").combine_chunks()
    codes = codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes
    wide = np.int64 if pa.types.is_large_binary(codes.type) else np.int32
    bounds = np.frombuffer(codes.buffers()[1], wide)[codes.offset : codes.offset + len(codes) + 1].astype(np.int64)
    data = np.frombuffer(codes.buffers()[2], np.uint8)
    lengths = np.diff(bounds)
    columns = {name: table.column(name).to_numpy() for name in [*BLOCK, "tile"]}
    fresh = np.zeros(len(lengths), bool)
    for name in BLOCK:
        fresh[1:] |= columns[name][1:] != columns[name][:-1]
    group = np.cumsum(fresh)
    across = columns["low"] != columns["high"]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # Rows are sorted by size, so each stretch of groups is padded to nearly its own width.
    firsts = np.r_[np.flatnonzero(np.r_[True, fresh[1:]]), len(lengths)]
    at = 0
    while at < len(firsts) - 1:
        upto = at + 1
        while upto < len(firsts) - 1 and (firsts[upto + 1] - firsts[at]) * (columns["size"][firsts[upto]] + 1) <= TILE_CELLS:
            upto += 1
        here = slice(firsts[at], firsts[upto])
        at = upto
        width, size, piece = int(lengths[here].max()), columns["size"][here], columns["piece"][here]
        own = lengths[here]
        ahead = _padded(data, bounds[:-1][here], own, width, False)
        behind = _padded(data, bounds[:-1][here], own, width, True)
        cuts = [size * k // PIECES for k in range(PIECES + 1)]
        for a, b in _index_pairs(group[here], columns["tile"][here], across[here], max(1, TILE_CELLS // width)):
            # Two words of the greater length are compared in the groups of that length.
            some = np.minimum(own[a], own[b]) == size[a]
            a, b = a[some], b[some]
            prefix, suffix = _common(ahead, a, b), _common(behind, a, b)
            near = prefix + suffix >= np.maximum(own[a], own[b]) - 1
            # A pair that shares several keys is found in several groups; the first piece that fits has it.
            first = np.full(len(a), PIECES)
            for k in reversed(range(PIECES)):
                fits = (prefix >= cuts[k][a]) & (suffix >= size[a] - cuts[k + 1][a])
                first[fits] = k
            near &= first == piece[a]
            found.append((a[near] + here.start, b[near] + here.start))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, other, other_n) in both directions. A block that goes on in the next batch is carried over to it."""
    kept: pa.Table | None = None

    def out(table: pa.Table) -> pa.RecordBatch:
        a, b = near_rows(table)
        left, right = pa.array(np.r_[a, b]), pa.array(np.r_[b, a])
        code, n = table.column("code").combine_chunks(), table.column("n").combine_chunks()
        return pa.RecordBatch.from_arrays([code.take(left), code.take(right), n.take(right)], ["code", "other", "other_n"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables([kept, table])
        same = np.ones(table.num_rows, bool)
        for name in BLOCK:
            column = table.column(name).to_numpy()
            same &= column == column[-1]
        last = table.num_rows if not len(same) else int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        kept = table.slice(last)
        if last:
            yield out(table.slice(0, last).combine_chunks())
    if kept is not None and kept.num_rows:
        yield out(kept.combine_chunks())


def near_words(words: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(word, other, other_n): every pair of different words one inserted, deleted or replaced letter apart, both ways."""
    ship_package(words.sparkSession)
    blocks = _blocks(stage(_groups(words), "word-groups"), tile_rows)
    ordered = blocks.repartition(*BLOCK).sortWithinPartitions(*BLOCK)
    pairs = ordered.mapInArrow(_compare, "code binary, other binary, other_n long")
    return pairs.select(F.decode("code", CHARSET).alias("word"), F.decode("other", CHARSET).alias("other"), "other_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last. Each round doubles the steps taken; counts grow along the way, so the
    rounds are few. Rounds are stored; one yes or no per round comes to the driver."""
    state = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("at"), F.col("root").alias("further"))
        moved = stage(state.join(ahead.hint("merge"), F.col("root") == F.col("at"), "left").select("word", "root", "further"), "roots")
        if moved.where("further IS NOT NULL").limit(1).count() == 0:
            return moved.select("word", "root")
        state = moved.select("word", F.coalesce("further", "root").alias("root"))


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text", tile_rows: int = TILE_ROWS, **counting: int) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of ``word_counts``, whose parameters ``counting`` may set.

    ``form`` is the near word of the largest n, of equals the smallest in code-point order, if that n is at least twice the
    word's own; else null. ``root`` follows forms to the last one; a word without a form is its own root. Null and empty
    texts have no words; a null id counts as an empty one; repeated rows count again; an empty table gives an empty result.
    Only the id and the text column are read, so others cannot clash. Words of any length are compared whole.
    """
    words = stage(word_counts(docs, id_column, text, **counting), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("order"), "other")).alias("best")
    near = near_words(words, tile_rows).groupBy("word").agg(F.count("*").alias("n_near"), best)
    near = near.select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.order")).alias("other_n"))
    fits = F.col("other_n") >= 2 * F.col("n")
    rows = words.join(near.hint("merge"), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("other")).alias("form"),
        F.when(fits, F.col("other_n")).alias("form_n"),
    )
    rows = stage(rows, "forms")
    roots = _roots(rows.where("form IS NOT NULL"))
    return rows.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
