"""Whole texts of Arrow batches as byte arrays: tokens, hashes and rolling windows without a Python loop over rows.

The hashes are 64-bit. Two different tokens, word runs or byte strings share one with a chance of about
n^2 / 2^65 among n distinct ones; operators that must not err on that compare the bytes as well."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time within a task; a longer single text is one part.
PART_BYTES = 600_000



def _give_back_memory() -> None:
    """Let freed arrays go back to the system at once, in the process that imports this (a driver or a Python worker).
    glibc otherwise raises its threshold for that with every large array, and a worker keeps its highest use for good."""
    if sys.platform == "linux":
        try:
            ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD
        except (OSError, AttributeError):
            return  # another C library
        pa.set_memory_pool(pa.system_memory_pool())


_give_back_memory()


def give_back() -> None:
    """Give what was freed back to the machine, where the C library can."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return

#: ASCII white space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.default_rng(20_240_229)
_BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    found = _powers.get(int(base))
    if found is None or len(found) < n:
        found = np.empty(max(n, 1 << 16), dtype=np.uint64)
        found[0] = 1
        found[1:] = base
        np.cumprod(found, out=found)
        if n <= 4 * PART_BYTES:
            _powers[int(base)] = found
    return found[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def parts(batch: pa.RecordBatch, column: str = "text", limit: int = PART_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``limit`` bytes of text: (rows, bytes, bounds); text i is bytes[bounds[i]:bounds[i+1]].
    Null texts are empty."""
    texts = batch.column(column)
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "" if not pa.types.is_binary(texts.type) else b"")
    n = len(texts)
    if n == 0:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, n)
        yield batch.slice(first, last - first), whole[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; see ``between``."""
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUE[data] * _power(_BASE, len(data)), out=sums[1:])
    return sums


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], equal for equal strings wherever they stand."""
    return mix((sums[end] - sums[start]) * _power(_INVERSE, len(sums))[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words ``[^\\x20\\x09-\\x0D]+``; a word ends where its text ends."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    inside = ~SEPARATOR[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and the number of its text."""
    starts, ends, owner = words(data, bounds)
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64), owner
    return between(prefix_hash(LOWER[data]), starts, ends), owner


def run_hashes(hashes: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` words within a text; a text with fewer words gives its whole sequence as one."""
    n = len(hashes)
    if n == 0:
        return hashes, owner
    mixed = np.zeros(n, dtype=np.uint64)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    counts = np.diff(np.r_[first, n])
    last = np.repeat(first + counts, counts)  # end of the text of each word
    for k in range(length):
        at = np.arange(k, n + k)
        inside = at < last
        step = np.zeros(n, dtype=np.uint64)
        step[inside] = hashes[at[inside]] * np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 2**64))
        mixed = mix(mixed + step)
    place = np.arange(n) - np.repeat(first, counts)
    keep = (place == 0) | (place + length <= np.repeat(counts, counts))
    return mixed[keep], owner[keep]


def unique_per_text(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each of n texts in ascending order, and the bounds of each text's share."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[keep], o[keep]
    return h, np.searchsorted(o, np.arange(n + 1))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each pair, one after another."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    skip = np.repeat(starts - np.r_[0, np.cumsum(counts)[:-1]], counts)
    return np.arange(total) + skip
