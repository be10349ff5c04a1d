"""Vectorised word hashing over Arrow string columns; runs inside tasks, holds one batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at a time; a word is never cut.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(_BASE)) | U(1)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, U)
    steps[0] = 1
    return np.cumprod(steps)


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK, n) + 1
    if size not in _cache:
        _cache.clear()
        _cache[size] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _cache[size]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their n+1 offsets; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word [^\\x20\\x09-\\x0D]+; a word never spans two texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space[:-1], space[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = True, True
    return np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1


def _hash_chunk(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _tables(len(data))
    total = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the n+1 offsets of each text's words.

    Works through the bytes in chunks that end at a word's end, so memory beside the
    result stays near CHUNK even for one very long text.
    """
    found, firsts, at = [], [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        if end < len(data):
            cut = np.flatnonzero(_SPACE[data[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:
                later, step = end, CHUNK
                while later < len(data) and not _SPACE[data[later : later + step]].any():
                    later += step
                end = min(len(data), later + int(np.argmax(_SPACE[data[later : later + step]])) + 1) if later < len(data) else len(data)
        inside = offsets[(offsets >= at) & (offsets < end)] - at
        starts, ends = word_spans(data[at:end], inside)
        found.append(_hash_chunk(data[at:end], starts, ends))
        firsts.append(starts + at)
        at = end
    if not found:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(firsts), offsets)


#: Multipliers without a linear relation among few of them.
FACTORS = mix(np.arange(1000, 1064, dtype=U)) | U(1)


def combine(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words."""
    n = max(0, len(words) - k + 1)
    total = np.zeros(n, U)
    for i in range(k):
        total = mix(total + words[i : i + n] * FACTORS[i % 64])
    return total


def rolled(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words from one running sum: for long runs, as its cost doesn't grow with k."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, U)
    power, inverse = _tables(len(words))
    total = np.zeros(len(words) + 1, U)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return mix((total[k:] - total[:n]) * inverse[:n] + U(k))


def slices(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, one row at least."""
    at = 0
    if not batch.num_rows:
        return
    sizes = np.cumsum(np.nan_to_num(np.asarray(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False), float)))
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield batch.slice(at, end - at)
        at = end


_ZSTD = pa.Codec("zstd")
#: Shorter arrays aren't compressed.
_LEAST = 256


def pack(x: np.ndarray) -> bytes:
    """Numbers as bytes by significance, compressed: counts, ranks and steps have mostly zero high bytes."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes() if len(x) else b""
    return len(x).to_bytes(8, "little") + (_ZSTD.compress(planes, asbytes=True) if len(planes) >= _LEAST else planes)


def unpack(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(_ZSTD.decompress(data[8:], n * size, asbytes=True) if n * size >= _LEAST else data[8:], np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their steps."""
    return pack(np.diff(keys, prepend=keys.dtype.type(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, U), dtype=U)


def part_of(keys: np.ndarray, parts: int, bits: int = 64) -> np.ndarray:
    """The part of the range of keys of so many bits that each key is in; it ascends with the keys."""
    return (((keys << U(64 - bits)) >> U(32)) * U(parts) >> U(32)).astype(np.int64)


def squeeze(x: bytes) -> bytes:
    return len(x).to_bytes(8, "little") + _ZSTD.compress(x, asbytes=True)


def squeezed(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with each text as compressed bytes, for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                data, offsets = buffers(b.column("text"))
                made = [squeeze(data[i:j].tobytes()) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text binary")


def unsqueezed(column: pa.Array) -> pa.Array:
    rows = column.to_pylist()
    return pa.array([_ZSTD.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True) for x in rows], pa.large_binary()).cast(pa.large_string())
