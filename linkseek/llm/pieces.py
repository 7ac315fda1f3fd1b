"""SentencePiece encoding with seeded merge-dropout, and decoding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkseek.llm.batches import list_array, mix, span_hashes, starts, text_slices
from linkseek.llm.merges import PairTable, merge_words

DROPOUT = 0.1
# Independent draws a word's segmentations come from; its occurrences spread over them by hash.
DRAWS = 32
_SPACE = "▁"
# Characters that are no piece of their own are symbols from here on.
_OTHER = 1 << 21


class Pieces:
    """A BPE model's pieces with byte fallback, read on the driver and sent to workers."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.array(
            [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32
        )
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i)
                   or model.is_unused(i) or model.is_byte(i)}
        normal = {names[i]: i for i in range(n) if i not in special}
        scores = np.array([model.get_score(i) for i in range(n)])
        order = np.unique(-scores, return_inverse=True)[1].tolist()
        symbol = {c: _OTHER + ord(c) for piece in normal for c in piece} | normal
        self.table = PairTable({
            (symbol[piece[:k]], symbol[piece[k:]]): (order[i], i)
            for piece, i in normal.items() for k in range(1, len(piece))
            if piece[:k] in symbol and piece[k:] in symbol
        })
        self.of_char = np.arange(_OTHER, _OTHER + 0x110000, dtype=np.int32)
        for piece, i in normal.items():
            if len(piece) == 1 and piece != _SPACE:
                self.of_char[ord(piece)] = i
        # A literal U+2581 isn't a space: it goes through its bytes, so that it comes back.
        self.of_char[ord(" ")] = self.space = normal[_SPACE]
        # If no piece has a space after another character, words never merge with each other.
        self.by_word = not any(_SPACE in piece.lstrip(_SPACE) for piece in normal)
        as_bytes = [names[i].replace(_SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.byte_ids.tolist()):
            as_bytes[i] = bytes([b])
        for i in range(n):
            if model.is_control(i) or model.is_unknown(i):
                as_bytes[i] = b""
        self.bytes = np.frombuffer(b"".join(as_bytes), np.uint8)
        self.bytes_start = starts([len(x) for x in as_bytes])

    def encode(
        self, texts: list[bytes], keys: np.ndarray, dropout: float = 0.0, seed: int = 0,
        draws: int = DRAWS,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts, and where each text's start in them (one more than texts).

        Each word takes one of `draws` by a hash of the seed, the text's key and the word's place.
        On the agenda, a hash of the seed, the draw, the word, the symbol's place and the
        piece it would become decides whether that merge is skipped.
        """
        strings = [" " + x.decode("utf-8", "replace") if x else "" for x in texts]
        text_start = starts([len(x) for x in strings])
        code = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        symbol = self.of_char[code]
        if not len(symbol):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        new = np.zeros(len(symbol), bool)
        if self.by_word:
            space = symbol == self.space
            new[1:] = space[1:] & ~space[:-1]
        new[text_start[:-1][np.diff(text_start) > 0]] = True
        begin = np.flatnonzero(new)
        size = np.diff(begin, append=len(symbol))
        word_start = np.searchsorted(begin, text_start)
        own = span_hashes(symbol, begin, begin + size)
        key = own
        if dropout > 0:
            text = np.repeat(np.arange(len(texts)), np.diff(word_start))
            place = (np.arange(len(begin)) - word_start[text]).astype(np.uint64)
            salt = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(seed * 2 + 1))
            draw = mix(salt[text] + place) % np.uint64(draws)
            key = mix(own + mix(draw + np.uint64(seed + 1)))
        _, first, where = np.unique(key, return_index=True, return_inverse=True)
        flat, flat_start = _gather(symbol, begin[first], size[first])
        again, _ = _gather(flat, flat_start[where], size)  # what hashes say is equal, compared
        if not (np.array_equal(size[first][where], size) and np.array_equal(again, symbol)):
            first = where = np.arange(len(begin))
            flat, flat_start = symbol, np.append(begin, len(symbol))
        flat_start = np.append(flat_start, len(flat)) if len(flat_start) == len(first) else flat_start
        word_key = key[first]

        def skip(word, at, into):
            h = mix(word_key[word] ^ (at.astype(np.uint64) << np.uint64(32) | into.astype(np.uint64)))
            return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < dropout

        ids, ids_start = merge_words(flat, flat_start, self.table, skip if dropout > 0 else None)
        ids, ids_start = self._spell(ids, ids_start)
        count = np.diff(ids_start)
        out, out_start = _gather(ids, ids_start[where], count[where])
        return out, np.append(out_start, len(out))[word_start]

    def _spell(self, ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no pieces, as pieces of their bytes."""
        other = np.flatnonzero(ids >= _OTHER)
        if not len(other):
            return ids, start
        spelled = [chr(i - _OTHER).encode() for i in ids[other].tolist()]
        size = np.ones(len(ids), np.int64)
        size[other] = [len(x) for x in spelled]
        at = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        out = np.repeat(ids, size)
        of_bytes, _ = _ranges(at[:-1][other], size[other])
        out[of_bytes] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return out, at[start]

    def decode(self, ids: np.ndarray, start: np.ndarray) -> list[bytes]:
        """The texts of lists of ids, the space put before each text taken off again."""
        size = np.diff(self.bytes_start)[ids]
        data, at = _gather(self.bytes, self.bytes_start[ids], size)
        data, at = data.tobytes(), np.append(at, len(data))[start].tolist()
        return [data[a:b].removeprefix(b" ") for a, b in zip(at, at[1:])]


def _ranges(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    return np.repeat(begin - at[:-1], size) + np.arange(at[-1]), at[:-1]


def _gather(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans one after the other, and where each starts."""
    index, at = _ranges(begin, size)
    return values[index], at


@lru_cache(maxsize=4)
def load_pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_pieces(
    docs: DataFrame, path: str, dropout: float = DROPOUT, seed: int = 0, draws: int = DRAWS
) -> DataFrame:
    """(`doc_id`, `n_pieces`, `ids`, `lossless`), a row per row of `docs` (`doc_id`, `text`).

    With no dropout, ids are those of the library for the model at `path`, but that a literal
    U+2581 is spelled in bytes. `lossless` says that decoding gave the text's bytes back. A null
    text is empty and has no ids; a null `doc_id` draws as 0; equal rows get equal ids; an
    empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch, texts in text_slices(batches):
            keys = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            ids, start = pieces.encode(texts, keys, dropout, seed, draws)
            back = pieces.decode(ids, start)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_pieces": pa.array(np.diff(start)),
                "ids": list_array(pa.array(ids), start),
                "lossless": pa.array([a == b for a, b in zip(texts, back)], pa.bool_()),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_pieces long, ids array<int>, lossless boolean"
    )


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """(`doc_id`, `text`) of (`doc_id`, `ids`); null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x or [] for x in batch.column("ids").to_pylist()]
            ids = np.array([i for x in lists for i in x], np.int64)
            texts = shared.value.decode(ids, starts([len(x) for x in lists]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "text": pa.array([x.decode("utf-8", "replace") for x in texts], pa.string()),
            })

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, text string"
    )
