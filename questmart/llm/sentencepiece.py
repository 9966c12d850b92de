"""SentencePiece BPE encoding and decoding with vectorised merge rounds."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.llm.common import whole_text
from questmart.llm.shipping import ship_package

SPACE = "▁"
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# How the library shows an unknown piece when it decodes.
UNKNOWN_SURFACE = " ⁇ "
CACHED_WORDS = 200_000
NO_RANK = np.iinfo(np.int64).max


class PieceModel:
    """The vocabulary of a model file: BPE, identity normalisation, dummy prefix, white space kept, byte fallback."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        plain = spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
        if trainer.model_type != 2 or not plain or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no text normalisation are supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        if any(kind in (USER_DEFINED, UNUSED) for kind in self.kinds):
            raise ValueError("user-defined and unused pieces are not supported")
        self.ids = {piece: i for i, piece in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.bytes = [0] * 256
        for i, kind in enumerate(self.kinds):
            if kind == BYTE:
                self.bytes[int(self.pieces[i][3:5], 16)] = i
        self.unknown = self.kinds.index(UNKNOWN)
        self.end = trainer.eos_id
        # No merge crosses from other characters to a space, so words can be merged apart from each other.
        crossing = re.compile(f"[^{SPACE}]{SPACE}")
        if any(crossing.search(piece) for piece in self.ids):
            raise ValueError("pieces with a space behind other characters are not supported")
        self.word = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self._rank(proto)
        self.surface = [self._surface(i) for i in range(len(self.pieces))]
        self.controls = [i for i, kind in enumerate(self.kinds) if kind == CONTROL]
        self.decimal = [str(i) for i in range(len(self.pieces))]
        self.cache: dict[str, tuple[int, ...]] = {}

    def _rank(self, proto) -> None:
        """Ranks of pieces (best score first, equal scores alike) and the table of pairs that make a piece."""
        scores = sorted({proto.pieces[i].score for i in self.ids.values()}, reverse=True)
        place = {score: i for i, score in enumerate(scores)}
        rank = {piece: place[proto.pieces[i].score] for piece, i in self.ids.items()}
        # Symbols are pieces by id; single characters outside the vocabulary get numbers behind it while encoding.
        pairs: dict[tuple[int, int], int] = {}
        alone: set[str] = set()
        for piece in self.ids:
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                a, b = self._symbol(left), self._symbol(right)
                if a is not None and b is not None:
                    pairs[a, b] = self.ids[piece]
                # A longer piece that is no worse may take a part away before the part's next occurrence is merged.
                for part in (left, right):
                    if part in rank and rank[piece] <= rank[part]:
                        alone.add(part)
        # Neighbouring characters that stand side by side in no piece are never merged, however the text goes on.
        beside = {(a, b) for piece in self.ids for a, b in zip(piece, piece[1:])}
        size = len(self.pieces)
        self.beside = np.sort(np.fromiter(((self.ids.get(a, size + ord(a)) << 32) | self.ids.get(b, size + ord(b)) for a, b in beside), np.int64, len(beside)))
        self.reach = 2 * max(map(len, self.ids))
        keys = np.fromiter(((a << 32) | b for a, b in pairs), np.int64, len(pairs))
        made = np.fromiter(pairs.values(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.pair_keys, self.pair_made = keys[order], made[order]
        self.rank_of = np.full(len(self.pieces), NO_RANK, np.int64)
        self.one_by_one = np.zeros(len(self.pieces), bool)
        for piece, i in self.ids.items():
            self.rank_of[i] = rank[piece]
            self.one_by_one[i] = piece in alone

    def _symbol(self, text: str) -> int | None:
        """A piece's id; single characters that are no piece have numbers of their own behind the vocabulary."""
        found = self.ids.get(text)
        if found is None and len(text) == 1:
            return len(self.pieces) + ord(text)
        return found

    # -- encoding -------------------------------------------------------------------------------------------------

    def encode_words(self, words: Sequence[str]) -> list[tuple[int, ...]]:
        """Ids of each word, all words merged together.

        All symbols lie in one flat array. In every round the best pair rank of each word is found by a segmented
        minimum; the word's pairs of that rank are merged from left to right, all words at once, and the array is
        compacted. Words are cut beforehand where no piece can join two characters, so that a long word is many short
        parts. Where a merged piece could be taken away by a longer piece at once, hits near each other are merged one by
        one, the leftmost first; hits out of each other's reach go in one round. Parts without a pair left are set aside.
        """
        ids, size = self.ids, len(self.pieces)
        flat = np.fromiter((ids.get(c, size + ord(c)) for word in words for c in word), np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        if not len(flat):
            return [() for _ in words]
        keys = (flat[:-1] << 32) | flat[1:]
        at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
        cut = np.r_[True, (self.beside[at] != keys) | (word[1:] != word[:-1])]
        owner, word_of = np.cumsum(cut) - 1, word[cut]
        place = np.arange(len(flat))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, made = self._pairs(flat, owner, np.arange(len(flat)))
        while len(flat):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, starts)
            segment = np.cumsum(np.r_[False, owner[1:] != owner[:-1]])
            live = (best != NO_RANK)[segment]
            if not live.all():
                done.append((owner[~live], flat[~live]))
                place = place[live]
                flat, owner, rank, made, segment = flat[live], owner[live], rank[live], made[live], best[segment][live]
                if not len(flat):
                    break
                hit = rank == segment
            else:
                hit = rank == best[segment]
            hit = self._leftmost(hit, made, owner, place)
            at = np.flatnonzero(hit)
            flat[at] = made[at]
            stay = np.ones(len(flat), bool)
            stay[at + 1] = False
            flat, owner, place, rank, made = flat[stay], owner[stay], place[stay], rank[stay], made[stay]
            # Only the pairs on both sides of a merged symbol are new.
            at = at - np.arange(len(at))
            fresh = np.r_[at, at[at > 0] - 1]
            rank[fresh], made[fresh] = self._pairs(flat, owner, fresh)
        owner = np.concatenate([o for o, _ in done])
        symbols = np.concatenate([s for _, s in done])
        order = np.argsort(owner, kind="stable")
        symbols, bounds = symbols[order].tolist(), np.searchsorted(word_of[owner[order]], np.arange(len(words) + 1)).tolist()
        return [self._finish(symbols[bounds[i] : bounds[i + 1]]) for i in range(len(words))]

    def _pairs(self, flat: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the symbols at some places, each with its right neighbour in the same part."""
        rank, made = np.full(len(at), NO_RANK, np.int64), np.zeros(len(at), np.int64)
        right = np.minimum(at + 1, len(flat) - 1)
        keys = (flat[at] << 32) | flat[right]
        found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        good = np.flatnonzero((self.pair_keys[found] == keys) & (right > at) & (owner[at] == owner[right]))
        made[good] = self.pair_made[found[good]]
        rank[good] = self.rank_of[made[good]]
        return rank, made

    def _leftmost(self, hit: np.ndarray, made: np.ndarray, owner: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Of neighbouring hits every second one from the left; of pieces merged one by one the first hit of each stretch in
        which hits are within reach of the one before. ``place``: where in the texts a symbol begins.

        What a merge sets off stays within the longest piece around it, so hits two longest pieces apart cannot meet.
        """
        at = np.flatnonzero(hit)
        run = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])]
        begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        take = (np.arange(len(at)) - begin) % 2 == 0
        first = np.r_[True, owner[at[1:]] != owner[at[:-1]]]
        word = np.cumsum(first) - 1
        # If any piece of the word's round is merged one by one, the whole word goes one by one in this round.
        single = np.bitwise_or.reduceat(self.one_by_one[made[at]], np.flatnonzero(first))[word]
        out = np.zeros(len(hit), bool)
        ahead = first | np.r_[True, place[at[1:]] - place[at[:-1]] > self.reach]
        out[at[np.where(single, ahead, take)]] = True
        return out

    def _finish(self, symbols: list[int]) -> tuple[int, ...]:
        out: list[int] = []
        for symbol in symbols:
            if symbol < len(self.pieces):
                out.append(symbol)
            else:
                out.extend(self.bytes[b] for b in chr(symbol - len(self.pieces)).encode("utf-8", "surrogatepass"))
        return tuple(out)

    def split(self, text: str) -> list[str]:
        """Words of the normalised text: spaces as marks, one mark in front. No text, no words."""
        return self.word.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, words: set[str]) -> None:
        """Puts the ids of the words into the cache; it is emptied when it has grown too large."""
        unknown = [word for word in words if word not in self.cache]
        if len(self.cache) + len(unknown) > CACHED_WORDS:
            self.cache.clear()
            unknown = list(words)
        step, begin = 0, 0
        while begin < len(unknown):  # about a million symbols at a time
            step, symbols = begin, 0
            while step < len(unknown) and (symbols < 1_000_000):
                symbols += len(unknown[step])
                step += 1
            part = unknown[begin:step]
            self.cache.update(zip(part, self.encode_words(part)))
            begin = step

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        self.learn(set(words))
        return [i for word in words for i in self.cache[word]] + [self.end]

    def _surface(self, i: int) -> bytes:
        """What an id adds to the decoded text, in UTF-8."""
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.kinds[i] == NORMAL:
            return self.pieces[i].replace(SPACE, " ").encode()
        return UNKNOWN_SURFACE.encode() if self.kinds[i] == UNKNOWN else b""

    # -- decoding -------------------------------------------------------------------------------------------------

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids: bytes are joined, bad bytes become U+FFFD each, one leading space is taken off."""
        if ids and self.kinds[ids[-1]] == CONTROL:
            ids = ids[:-1]
        if not ids:
            return ""
        if any(control in ids for control in self.controls):
            return self._decode_by_runs(ids)
        first = ids[0]
        joined = b"".join([self.surface[i] for i in ids])
        try:
            # Pieces are whole characters, so the joined bytes are good exactly if every run of single bytes is.
            whole = joined.decode()
        except UnicodeDecodeError:
            return self._decode_by_runs(ids)
        return whole[1:] if self.kinds[first] == NORMAL and self.pieces[first].startswith(SPACE) else whole

    def _decode_by_runs(self, ids: Sequence[int]) -> str:
        """Run by run, where some bytes are no characters or control pieces part them."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if self.kinds[i] == BYTE:
                run.append(int(self.pieces[i][3:5], 16))
                continue
            if run:
                out.append(_from_bytes(run))
                run = bytearray()
            if self.kinds[i] == UNKNOWN:
                out.append(UNKNOWN_SURFACE)
            elif self.kinds[i] == NORMAL:
                piece = self.pieces[i]
                if not out and piece.startswith(SPACE):
                    piece = piece[1:]
                    out.append("")
                out.append(piece.replace(SPACE, " "))
        if run:
            out.append(_from_bytes(run))
        return "".join(out)


def _from_bytes(run: bytearray) -> str:
    """UTF-8 text; each byte that starts no character becomes one replacement character."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for length in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[i : i + length]).decode())
                    i += length
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


@functools.lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    """One model per worker process."""
    return PieceModel(path)


def encode_documents(docs: DataFrame, model_path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (with an end id behind the last), one row per input row.

    Null and empty texts have only the end id; repeated rows repeat; an empty table gives an empty result. The model file
    must have the same path on every machine; tokenizers are installed there like any library.
    """
    return _map(docs, model_path, id_column, text, "doc_id long, ids array<int>", _encode_batch)


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, decoded text of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for batch in batches:
            texts = [model.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    ship_package(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded string")


def digest_documents(docs: DataFrame, model_path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes every whole text and decodes its ids again."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _map(docs, model_path, id_column, text, schema, _digest_batch)


def tokenize_documents(docs: DataFrame, model_path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256, decoded_sha256, one row per input row."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>"
    return _map(docs, model_path, id_column, text, schema, _tokenize_batch)


def _map(docs, model_path, id_column, text, schema, work) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                yield work(model, batch.slice(begin, 256))

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return rows.mapInArrow(run, schema)


def _encoded(model: PieceModel, batch: pa.RecordBatch) -> Iterator[list[int]]:
    split = [model.split(text.as_py()) for text in batch.column(1)]
    model.learn({word for words in split for word in words})
    for words in split:
        yield [i for word in words for i in model.cache[word]] + [model.end]


def _encode_batch(model: PieceModel, batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = pa.array(list(_encoded(model, batch)), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])


def _digest_batch(model: PieceModel, batch: pa.RecordBatch) -> pa.RecordBatch:
    return _tokenize_batch(model, batch, keep=False)


def _tokenize_batch(model: PieceModel, batch: pa.RecordBatch, keep: bool = True) -> pa.RecordBatch:
    counts, encoded, decoded, kept = [], [], [], []
    for ids in _encoded(model, batch):
        counts.append(len(ids))
        encoded.append(hashlib.sha256(" ".join([model.decimal[i] for i in ids]).encode()).hexdigest())
        decoded.append(hashlib.sha256(model.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
        if keep:
            kept.append(ids)
    columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if keep:
        columns.append(pa.array(kept, pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)
