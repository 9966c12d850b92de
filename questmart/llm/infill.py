"""Fill-in-middle: cuts found by rank queries on a wavelet matrix over the character classes of the texts' bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questmart.llm.common import whole_text
from questmart.llm.shipping import ship_package

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

# Classes of bytes; all but the first begin a character.
INNER, LINE_END, BLANK, WORD_BEGIN, WORD_REST = range(5)
LEVELS = 3
# The classes whose bytes begin a unit; a line unit begins behind its line end.
UNITS = {"char": (LINE_END, BLANK, WORD_BEGIN, WORD_REST), "word": (WORD_BEGIN,), "line": (LINE_END,)}

# Bytes of text that are worked on at a time, unless one text alone has more.
PART_BYTES = 4_000_000


def byte_classes(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Class of each byte of UTF-8 texts that lie behind one another and begin at ``begins``."""
    inner = (data & 0xC0) == 0x80
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    fresh = np.empty(len(data) + 1, bool)
    fresh[1:] = blank
    fresh[begins] = True
    out = np.where(fresh[:-1], WORD_BEGIN, WORD_REST).astype(np.uint8)
    out[blank] = BLANK
    out[data == 0x0A] = LINE_END
    out[inner] = INNER
    return out


class BitVector:
    """Bits with counts of ones up to each 64-bit word: one byte and a half per eight bits."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.upto = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.upto[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Classes of a long sequence, one bit vector per level, highest bit first; zeros move stably before ones."""

    def __init__(self, classes: np.ndarray, levels: int = LEVELS) -> None:
        self.length, self.levels = len(classes), []
        for level in reversed(range(levels)):
            bits = (classes >> level) & 1
            vector = BitVector(bits)
            self.levels.append((level, vector, len(classes) - int(vector.upto[-1])))
            classes = np.r_[classes[bits == 0], classes[bits == 1]]

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often the class occurs before each position."""
        begin = np.zeros_like(at)
        for level, vector, zeros in self.levels:
            ones_at, ones_begin = vector.rank(at), vector.rank(begin)
            if symbol >> level & 1:
                at, begin = zeros + ones_at, zeros + ones_begin
            else:
                at, begin = at - ones_at, begin - ones_begin
        return at - begin

    def boundaries(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many positions before each have one of the classes: their ranks added up."""
        return sum(self.rank(symbol, at) for symbol in symbols)

    def behind(self, symbols: tuple[int, ...], count: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least position in [low, high] with ``count`` boundaries before it, by bisection on ranks, all at once.

        ``high`` may be one behind the sequence. No rank is asked for there: only searches still open ask, and each below its high.
        """
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            enough = self.boundaries(symbols, middle) >= count[open_]
            high[open_[enough]] = middle[enough]
            low[open_[~enough]] = middle[~enough] + 1
        return low


def cut_texts(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, the units of its prefix and middle, and the two cuts as byte positions in ``data``.

    Text i lies at [offsets[i], offsets[i + 1]). ``draws`` has two numbers per text; each modulo (units + 1) is a cut.
    """
    begin, end = offsets[:-1], offsets[1:]
    classes = byte_classes(data, begin[begin < end])
    matrix, symbols = WaveletMatrix(classes), UNITS[unit]
    # One rank query for each end of a text; texts lie behind one another, so an end is the next begin.
    upto = matrix.boundaries(symbols, offsets)
    units = np.diff(upto)
    cuts = np.sort(draws % (units + 1)[:, None], axis=1)
    places = []
    for k in range(2):
        # A text of c units is cut before unit c + 1 begins: there, c + 1 boundaries lie before the next byte. A line
        # begins behind its boundary, so there c boundaries are enough.
        if unit == "line":
            place = matrix.behind(symbols, upto[:-1] + cuts[:, k], begin, end)
        else:
            place = matrix.behind(symbols, upto[:-1] + cuts[:, k] + 1, begin, end + 1) - 1
            place = np.where(cuts[:, k] == units, end, place)
        places.append(np.where(cuts[:, k] == 0, begin, place))
    return units, np.stack([cuts[:, 0], cuts[:, 1] - cuts[:, 0]]), places[0], places[1]


def _arrange(batch: pa.RecordBatch, unit: str, plain_from: int, spm_below: int) -> pa.RecordBatch:
    texts = batch.column("text")
    wide = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    draws = np.stack([batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)], axis=1)
    units, sizes, first, second = cut_texts(data, offsets, draws[:, :2], unit)
    whole = data.tobytes()
    marks = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
    forms, outputs = [], []
    for i, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        text = whole[begin:end]
        a, b = int(first[i]) - begin, int(second[i]) - begin
        if not text or any(mark in text for mark in marks) or draws[i, 2] % 100 >= plain_from:
            forms.append(PLAIN)
            outputs.append(text)
        elif draws[i, 3] % 100 < spm_below:
            forms.append(SPM)
            outputs.append(b"".join([marks[1], text[b:], marks[0], text[:a], marks[2], text[a:b]]))
        else:
            forms.append(PSM)
            outputs.append(b"".join([marks[0], text[:a], marks[1], text[b:], marks[2], text[a:b]]))
    plain = np.array([form == PLAIN for form in forms], bool)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(units),
            pa.array(forms, pa.string()),
            pa.array(sizes[0], mask=plain),
            pa.array(sizes[1], mask=plain),
            pa.array(outputs, pa.binary()),
        ],
        ["doc_id", "n", "form", "prefix_units", "middle_units", "output"],
    )


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about PART_BYTES of text each, one row at least."""
    sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
    begin = 0
    while begin < batch.num_rows:
        done = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, done + PART_BYTES, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def draw(doc_id: Column, seed: int, part: int) -> Column:
    """The part-th 32-bit number of a document's draws: hexadecimal digits of the SHA-256 of seed, colon and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * part - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", unit: str = "char", seed: int = 1, plain_from: int = 90, spm_below: int = 20
) -> DataFrame:
    """doc_id, n, form, prefix_units, middle_units, output (binary, UTF-8): one row per input row.

    A text of n units (``char``: code points; ``word``: words with the blanks behind them, blanks in front of the first word
    belong to it; ``line``: lines with their ends) is cut twice at units drawn from the id. ``psm`` gives prefix, suffix,
    middle behind their marks, ``spm`` suffix, prefix, middle; ``plain`` leaves texts as they are that are empty, hold a
    mark, or draw so. Null counts as empty; a null id draws as an empty one; rows with equal ids draw alike; an empty table
    gives an empty result. Only the id and the text column are read, so others cannot clash. Texts of any length are whole.
    """
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit!r}, known are {sorted(UNITS)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                yield _arrange(part, unit, plain_from, spm_below)

    ship_package(docs.sparkSession)
    own = F.col(id_column).cast("long")
    rows = docs.select(own.alias("doc_id"), whole_text(text).cast("binary").alias("text"), *[draw(own, seed, i).alias(f"h{i}") for i in (1, 2, 3, 4)])
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_units long, middle_units long, output binary")


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from what was made of it. Texts that hold a mark stay plain, so the first of each mark parts it."""
    made = output.cast("string")

    def between(left: str, right: str | None) -> Column:
        behind = F.split_part(made, F.lit(left), F.lit(2))
        return behind if right is None else F.split_part(behind, F.lit(right), F.lit(1))

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(made)
