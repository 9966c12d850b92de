"""Byte-level BPE encoding and decoding with a rank queue over hierarchical bitmaps."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.llm.common import whole_text
from questmart.llm.shipping import ship_package

# Pre-tokens in each of the cache's two generations.
CACHED_TOKENS = 250_000
# Symbols that share a queue, unless one pre-token alone has more.
QUEUED_SYMBOLS = 1_000_000
# Waiting positions from which on a bucket is merged by arrays and not one by one.
ARRAY_POSITIONS = 24
# Bytes of text that are worked on at a time, unless one text alone has more.
PART_BYTES = 4_000_000
NONE = -1


class RankQueue:
    """Positions by merge rank, the lowest rank first.

    A bucket per rank lists its positions. Which buckets hold any is kept in bitmaps of 64-bit words: a bit of one level
    says that the word below it is not zero, so the lowest rank is found by one find-first-set per level.
    """

    BITS = 6

    def __init__(self, ranks: int) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        words = max(ranks, 1)
        while True:
            words = (words + 63) >> self.BITS
            self.levels.append([0] * words)
            if words == 1:
                break

    def push(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        for level in self.levels:
            word, bit = rank >> self.BITS, 1 << (rank & 63)
            before = level[word]
            level[word] = before | bit
            if before:
                break
            rank = word

    def lowest(self) -> int:
        """The lowest rank that has a position; NONE if the queue is empty."""
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return NONE
            at = (at << self.BITS) | ((word & -word).bit_length() - 1)
        return at

    def take(self, rank: int) -> list[int]:
        """All positions of a rank that has some, the leftmost at the end; the bucket is then empty."""
        positions = self.buckets.pop(rank)
        for level in self.levels:
            word = rank >> self.BITS
            level[word] &= ~(1 << (rank & 63))
            if level[word]:
                break
            rank = word
        positions.sort(reverse=True)
        return positions


class TokenStore(dict[str, int]):
    """Pre-tokens, numbered as they come up, and their ids."""

    def __init__(self) -> None:
        self.begin = self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def __missing__(self, token: str) -> int:
        number = self[token] = len(self)
        return number

    def add(self, length: np.ndarray, ids: np.ndarray, where: np.ndarray) -> None:
        """The ids of the pre-tokens with the numbers ``where``, one behind the other."""
        more = len(self) - len(self.begin)
        if more:
            self.begin, self.length = (np.r_[a, np.zeros(more, np.int64)] for a in (self.begin, self.length))
        self.begin[where] = len(self.ids) + np.cumsum(length) - length
        self.length[where] = length
        self.ids = np.r_[self.ids, ids.astype(np.int32)]

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of the numbered pre-tokens has, and the ids, one behind the other."""
        length = self.length[numbers]
        at = np.repeat(self.begin[numbers] - np.cumsum(length) + length, length)
        at += np.arange(len(at))
        return length, self.ids[at]


def _probe(pattern: str, characters: str) -> str:
    """The characters that the pattern matches as the public library understands it: its Unicode tables need not be Python's."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    library = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
    return bytes(library.encode_ordinary(characters)).decode()


def _ranges(characters: str) -> str:
    """A character set as the inside of a bracket expression."""
    codes = sorted(map(ord, characters))
    out, begin = [], 0
    for i, code in enumerate(codes):
        if i + 1 == len(codes) or codes[i + 1] != code + 1:
            out.append(f"\\U{codes[begin]:08x}" if begin == i else f"\\U{codes[begin]:08x}-\\U{code:08x}")
            begin = i + 1
    return "".join(out)


def compiled(pattern: str, last: int = 0x10FFFF) -> re.Pattern[str]:
    """The splitting pattern with its Unicode classes written out, so that it splits exactly as the public library does.

    Only for texts without a character above ``last``, as classes end there.
    """
    every = "".join(chr(c) for c in range(last + 1) if not 0xD800 <= c < 0xE000)
    inside: dict[str, str] = {}
    for name in set(re.findall(r"\\p\{\w+\}|\\s", pattern.replace("\\S", "\\s"))):
        inside[name] = _ranges(_probe(name, every))
    out, bracket = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|[\[\]]|[^\\\[\]]+", pattern, re.S):
        if part == "\\S" and not bracket:
            part = f"[^{inside['\\s']}]"
        elif part in inside:
            part = inside[part] if bracket else f"[{inside[part]}]"
        bracket = (bracket or part == "[") and part != "]"
        out.append(part)
    return re.compile("".join(out))


class BytePairModel:
    """Ranks of byte sequences; a rank is also the id of its token."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.tokens: dict[int, bytes] = {int(rank): base64.b64decode(token) for token, rank in lines}
        ranks = {token: rank for rank, token in self.tokens.items()}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the ranks must hold every single byte")
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        self.size = max(self.tokens) + 1
        # Pairs of tokens whose bytes together are a token, by left id and right id.
        self.merges: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.merges[left * self.size + right] = rank
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        order = np.argsort(keys)
        self.merge_keys = np.r_[keys[order], np.iinfo(np.int64).max]
        self.merge_ranks = np.r_[np.fromiter(self.merges.values(), np.int64, len(keys))[order], NONE]
        # Whether every pair with the token has a higher rank than the token: a merge to it brings up no better pair.
        self.settled = np.ones(self.size, bool)
        for side in (self.merge_keys[:-1] // self.size, self.merge_keys[:-1] % self.size):
            self.settled[side[self.merge_ranks[:-1] < side]] = False
        self.first_pairs = np.array([[ranks.get(bytes([a, b]), NONE) for b in range(256)] for a in range(256)])
        self.patterns = [(re.compile(f"[^\\0-{chr(last)}]"), compiled(pattern, last)) for last in (0xFF, 0xFFFF)]
        self.patterns.append((None, compiled(pattern)))
        self.cache, self.older = TokenStore(), TokenStore()
        # By id; a decimal ends with a space.
        self.token_bytes = pa.array(map(self.tokens.get, range(self.size)), pa.large_binary())
        self.decimal = pa.array([b"%d " % i for i in range(self.size)], pa.large_binary())

    def encode_tokens(self, tokens: Sequence[bytes]) -> list[tuple[int, ...]]:
        """Ids of each pre-token."""
        length, ids = self.merge(tokens)
        ends, flat = np.cumsum(length).tolist(), ids.tolist()
        return [tuple(flat[begin:end]) for begin, end in zip([0, *ends], ends)]

    def merge(self, tokens: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each pre-token has, and the ids, one behind the other: a whole token is its id; else the pair of
        lowest rank, leftmost of equals, is merged until no pair has a rank.

        The symbols of all pre-tokens are one linked list over their bytes, cut between pre-tokens, with one queue: merges
        of different pre-tokens do not touch, so only their order within one counts. An entry whose pair has been changed
        by a neighbour's merge meanwhile is stale and skipped. A merge takes a few steps, however long the pre-token is.
        The positions of a large bucket are merged together, those of a small one one by one.
        """
        if not tokens:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size, merges = self.size, self.merges
        whole = np.fromiter(map(self.ranks.get, tokens, [NONE] * len(tokens)), np.int64, len(tokens))
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        count = len(raw)
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(tokens)), lengths)
        symbols, pairs = self.single[raw], np.full(count, NONE, np.int64)
        pairs[:-1] = self.first_pairs[raw[:-1], raw[1:]]
        pairs[ends - 1] = NONE
        # A whole token keeps its first symbol only.
        pairs[(whole != NONE)[owner]] = symbols[(whole != NONE)[owner]] = NONE
        symbols[(ends - lengths)[whole != NONE]] = whole[whole != NONE]
        # Neighbours of the same pre-token; NONE beyond its ends.
        nexts, lasts = np.arange(1, count + 1), np.arange(-1, count - 1)
        nexts[ends - 1] = lasts[ends - lengths] = NONE
        queue = RankQueue(size)
        found = np.flatnonzero(pairs != NONE)
        self._push(queue, pairs[found], found)
        # The same arrays, for the steps of one position.
        symbol, pair, after, before = map(memoryview, (symbols, pairs, nexts, lasts))
        get, push = merges.get, queue.push
        while (rank := queue.lowest()) != NONE:
            waiting = queue.take(rank)
            if len(waiting) >= ARRAY_POSITIONS:
                at = np.array(waiting[::-1])
                at = at[pairs[at] == rank]
                at = at[np.r_[True, at[1:] != at[:-1]][: len(at)]]
                settled = self.settled[rank]
                if settled:
                    # Every other one of a chain in which each position's right symbol is the next one's left.
                    place = np.arange(len(at))
                    chained = np.r_[False, nexts[at[:-1]] == at[1:]][: len(at)]
                    now = (place - np.maximum.accumulate(np.where(chained, 0, place))) & 1 == 0
                else:
                    # A better pair may come up in the pre-token: its other positions wait.
                    now = np.r_[True, owner[at[1:]] != owner[at[:-1]]][: len(at)]
                waiting = at[::-1].tolist()
                if 2 * np.count_nonzero(now) >= max(len(at), ARRAY_POSITIONS):
                    if not settled and not now.all():
                        push(rank, at[~now].tolist())
                    at = at[now]
                    gone = nexts[at]
                    right = nexts[gone]
                    symbols[at], symbols[gone], nexts[at] = rank, NONE, right
                    pairs[at] = pairs[gone] = NONE
                    inner = right != NONE
                    lasts[right[inner]] = at[inner]
                    left = lasts[at]
                    near = np.r_[left[left != NONE], at[inner]]
                    keys = symbols[near] * size + symbols[nexts[near]]
                    slot = np.searchsorted(self.merge_keys, keys)
                    made = pairs[near] = np.where(self.merge_keys[slot] == keys, self.merge_ranks[slot], NONE)
                    self._push(queue, made[made != NONE], near[made != NONE])
                    continue
            lower = False
            while waiting:
                at = waiting.pop()
                if pair[at] != rank:
                    continue
                gone = after[at]
                symbol[at], symbol[gone] = rank, NONE
                pair[at] = pair[gone] = NONE
                right = after[at] = after[gone]
                if right != NONE:
                    before[right] = at
                    made = pair[at] = get(rank * size + symbol[right], NONE)
                    if made != NONE:
                        push(made, [at])
                        lower = made < rank
                left = before[at]
                if left != NONE:
                    made = pair[left] = get(symbol[left] * size + rank, NONE)
                    if made != NONE:
                        push(made, [left])
                        lower = lower or made < rank
                if lower:
                    # A better pair has come up: the rest of this rank waits.
                    if waiting:
                        push(rank, waiting)
                    break
        kept = symbols != NONE
        return np.bincount(owner[kept], minlength=len(tokens)), symbols[kept]

    @staticmethod
    def _push(queue: RankQueue, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Puts every position into the bucket of its rank."""
        order = np.argsort(ranks, kind="stable")
        ranks, held = ranks[order], positions[order].tolist()
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begin = 0
        for rank, end in zip(ranks[np.r_[0, cuts]].tolist() if held else [], [*cuts.tolist(), len(held)]):
            queue.push(rank, held[begin:end])
            begin = end

    def split(self, text: str) -> list[str]:
        """The matches of the pattern. Texts without rarer characters take the same pattern with smaller classes."""
        for limit, pattern in self.patterns:
            if limit is None or not limit.search(text):
                return pattern.findall(text)
        raise AssertionError("the last pattern takes every text")

    def learn(self, tokens: Iterable[str]) -> np.ndarray:
        """The numbers of the pre-tokens in the cache, which gets the ids of those it did not hold. A full cache becomes the
        older generation, from which pre-tokens that come up again return."""
        if len(self.cache) > CACHED_TOKENS:
            self.cache, self.older = TokenStore(), self.cache
        cache, older = self.cache, self.older
        known = len(cache)
        try:
            numbers = np.fromiter(map(cache.__getitem__, tokens), np.int64)
            unknown = list(islice(cache, known, None))
            held = np.fromiter(map(older.get, unknown, [NONE] * len(unknown)), np.int64, len(unknown))
            cache.add(*older.gather(held[held != NONE]), known + np.flatnonzero(held != NONE))
            begin, left = 0, np.flatnonzero(held == NONE)
            raw = [unknown[i].encode() for i in left.tolist()]
            while begin < len(raw):
                end, symbols = begin, 0
                while end < len(raw) and symbols < QUEUED_SYMBOLS:
                    symbols += len(raw[end])
                    end += 1
                cache.add(*self.merge(raw[begin:end]), known + left[begin:end])
                begin = end
        except BaseException:
            # Numbers without ids must not stay.
            self.cache = TokenStore()
            raise
        return numbers

    def encode_flat(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, one behind the other, and where each text's begin, with the end of the last: each match of
        the pattern by itself, no special tokens."""
        split = [self.split(text) for text in texts]
        numbers = self.learn(chain.from_iterable(split))
        length, ids = self.cache.gather(numbers)
        ends = np.r_[0, np.cumsum(length)]
        return ids, ends[np.r_[0, np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]]

    def encode_all(self, texts: Sequence[str]) -> Iterator[list[int]]:
        """Ids of whole texts, a list for each."""
        ids, bounds = self.encode_flat(texts)
        for begin, end in zip(bounds.tolist(), bounds[1:].tolist()):
            yield ids[begin:end].tolist()

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode_all(self, ids: pa.Array, bounds: np.ndarray) -> list[memoryview]:
        """The bytes of the ids of each text, joined; they need not be whole characters."""
        return _joined(self.token_bytes, ids, bounds)

    def decode(self, ids: Sequence[int]) -> bytes:
        return bytes(self.decode_all(pa.array(ids, pa.int64()), np.array([0, len(ids)]))[0])


@functools.lru_cache(maxsize=2)
def load_model(path: str, pattern: str) -> BytePairModel:
    """One model per worker process."""
    return BytePairModel(path, pattern)


def _joined(table: pa.Array, ids: pa.Array, bounds: np.ndarray) -> list[memoryview]:
    """The values of the table at the ids, joined from each bound to the next."""
    values = table.take(ids)
    if values.null_count:
        raise KeyError("an id without a token")
    if not len(values):
        return [memoryview(b"")] * (len(bounds) - 1)
    ends = np.frombuffer(values.buffers()[1], np.int64)[bounds].tolist()
    data = memoryview(values.buffers()[2])
    return [data[begin:end] for begin, end in zip(ends, ends[1:])]


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about PART_BYTES of text each, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        done = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, done + PART_BYTES, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _texts(batch: pa.RecordBatch, column: int) -> list[str]:
    """Bytes that are no UTF-8 become replacement characters, as in any reader of text."""
    return [value.as_py().decode("utf-8", "replace") for value in batch.column(column)]


def _map(docs: DataFrame, path: str, pattern: str, id_column: str, text: str, schema: str, work) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(path, pattern)
        for batch in batches:
            for part in _parts(batch, 1):
                yield work(model, part)

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids: one row per input row.

    Null and empty texts have no ids; repeated rows repeat; null ids stay null; an empty table gives an empty result. Only
    the id and the text column are read, so others cannot clash. A pre-token of any length is encoded whole. The rank file
    must have the same path on every machine; tokenizers are installed there like any library.
    """

    def work(model: BytePairModel, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = model.encode_flat(_texts(batch, 1))
        ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return _map(docs, path, pattern, id_column, text, "doc_id long, ids array<int>", work)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, decoded (binary) of (doc_id, ids); null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(path, pattern)
        for batch in batches:
            ids = batch.column(1)
            bounds = np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]
            decoded = pa.array(list(map(bytes, model.decode_all(ids.flatten(), bounds))), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), decoded], ["doc_id", "decoded"])

    ship_package(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes every whole text and decodes its ids again, rows as in
    ``encode_documents``."""

    def work(model: BytePairModel, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = model.encode_flat(_texts(batch, 1))
        ids = pa.array(ids)
        encoded = [hashlib.sha256(text[:-1]).hexdigest() for text in _joined(model.decimal, ids, bounds)]
        decoded = [hashlib.sha256(text).hexdigest() for text in model.decode_all(ids, bounds)]
        columns = [batch.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _map(docs, path, pattern, id_column, text, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", work)
