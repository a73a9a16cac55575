"""Words of many texts at once, as Arrow and numpy arrays."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are held as words at one time (a longer single text is taken alone).
SLICE_BYTES = 2_000_000


def slices(batches: Iterator[pa.RecordBatch], text_col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in batches of at most `limit` bytes of text or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(begin, end - begin)
            give_back()
            begin = end


def give_back() -> None:
    """Lets the system have what Arrow and the C library hold in reserve, before the next slice is taken."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run):
    """run, a function of batches, which gives back what it held when its task ends: a worker that waits for other tasks, or takes one of another stage, keeps nothing of it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def forget() -> None:
    """Drops what per_worker() keeps: for tasks that need the memory for something else."""
    sys.__dict__.pop("_casemill_kept", None)


def compact(texts: pa.Array) -> pa.Array:
    """The same strings in buffers of their own, null being empty.

    Kernels that change strings misread an array that is a slice of a larger one and was cast.
    """
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = data.slice(at[0], at[-1] - at[0]) if data is not None else pa.py_buffer(b"")
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), data)


def split(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words [^\\x20\\x09-\\x0D]+ of each text: where each text's begin, their codes, and the different words.

    The first array has one more entry than there are texts. Null has no words. With lower, A-Z are lower-cased.
    """
    texts = compact(texts)
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    flat = parts.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    real = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)])
    encoded = flat.filter(real).dictionary_encode()
    return kept[offsets], encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def strings(words: pa.Array) -> list[str]:
    """The words as Python strings, made at once: to_pylist() takes several times as long."""
    return words.to_numpy(zero_copy_only=False).tolist()


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same everywhere."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, strings(words)), np.uint64, len(words))


def per_worker(key: str, make):
    """What make() gave the first time that a task of this Python worker asked for that key."""
    # Kept beside sys, as a module's own names were seen to be lost between the tasks of a worker.
    kept = sys.__dict__.setdefault("_casemill_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit depends on all (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def windows(word_hashes: np.ndarray, begins: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words within each text, and how many each text has.

    A text with fewer words, but any, has one run: all its words.
    """
    n = np.diff(begins)
    counts = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    total = len(word_hashes)
    out = np.zeros(total, np.uint64)
    for k in range(min(width, total)):  # a position beyond the text is never used below
        out[: total - k] = mix(out[: total - k] * np.uint64(0x9E3779B97F4A7C15) + word_hashes[k:])
    at = np.repeat(begins[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    out = out[at]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        where = (np.cumsum(counts) - counts)[short]
        for i, w in zip(short, where, strict=True):
            h = np.uint64(n[i])
            for x in word_hashes[begins[i] : begins[i + 1]]:
                h = mix(np.array([(int(h) * 0x9E3779B97F4A7C15 + int(x)) % 2**64], np.uint64))[0]
            out[w] = mix(np.array([h], np.uint64) ^ np.uint64(0x5851F42D4C957F2D))[0]
    return out, counts
