"""Arrow batches as numpy arrays, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that one numpy pass works on; a longer single text makes its own slice.
SLICE_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# ASCII white space, as in the pattern [\x20\x09-\x0D].
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches cut into slices, with each row's text in UTF-8 (null: empty)."""
    for batch in batches:
        texts = batch.column(column).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8))
        start, held = 0, 0
        for row, n in enumerate(sizes.tolist()):
            if held and held + n > SLICE_BYTES:
                yield batch.slice(start, row - start), _values(texts, start, row)
                start, held = row, 0
            held += n
        if start < len(texts):
            yield batch.slice(start), _values(texts, start, len(texts))


def _values(texts: pa.Array, start: int, stop: int) -> list[bytes]:
    return [x or b"" for x in texts.slice(start, stop - start).to_pylist()]


def starts(sizes: list[int]) -> np.ndarray:
    """Start of each part, and the end of the last."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of `values`, from one pass of prefix sums modulo 2**64."""
    powers = np.full(len(values), _P, np.uint64)
    powers[:1] = 1
    np.cumprod(powers, out=powers)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers, out=prefix[1:])
    inverse = np.full(len(values) + 1, _P_INVERSE, np.uint64)
    inverse[:1] = 1
    np.cumprod(inverse, out=inverse)
    return mix((prefix[end] - prefix[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def words(
    texts: list[bytes], lower: bool = True, gap: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, split at ASCII white space (or `gap`) and lower-cased (A-Z),
    and the places in them where each text's words start (one more than texts)."""
    begin, end, data, text_start = word_spans(texts, gap)
    if lower:
        data = _LOWER[data]
    return span_hashes(data, begin, end), np.searchsorted(begin, text_start)


def word_spans(
    texts: list[bytes], gap: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word in the joined texts, those bytes, and where each text starts.
    A space after each text keeps words of two texts apart; `gap` tells the bytes between words."""
    text_start = starts([len(x) + 1 for x in texts])
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = gap[data]
    edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
    return edge[::2], edge[1::2], data, text_start


def list_array(values: pa.Array, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
