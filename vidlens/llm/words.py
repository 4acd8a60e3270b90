"""Words of whole Arrow batches as 64-bit hashes, without a Python loop over words.

A word is a maximal run of bytes other than space and 0x09-0x0D, with A-Z
lowered. Its hash sums a random number for each byte times a power of an odd
base, taken from running sums over the text bytes, and is mixed at the end.
"""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _tables():
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    gap = np.zeros(256, dtype=bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))[lower]
    return gap, value


@functools.lru_cache(maxsize=2)
def _powers(n: int):
    base, inverse = _BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, base, dtype=np.uint64), np.full(n, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, first word of each text and the total at the end)."""
    hashes, starts, _, first, _ = word_spans(texts)
    return hashes, first


def word_spans(texts: pa.Array, marks: bytes = b""):
    """(hashes, starts, ends, first word of each text, text bytes); starts and ends are byte offsets.

    With ``marks``, a run of these that ends a word behind an ASCII letter is a word of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None and len(texts) else np.empty(0, np.uint8)
    offsets = offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)
    gap, value = _tables()
    is_mark = np.zeros(256, dtype=bool)
    is_mark[list(marks)] = True
    letter = np.zeros(256, dtype=bool)
    letter[65:91] = letter[97:123] = True
    hashes, starts, stops, at, n = [], [], [], 0, len(data)
    while at < n:
        end = min(n, at + SEGMENT)
        # Cut behind a gap or between texts; a single longer word widens the segment.
        while end < n:
            gaps = np.flatnonzero(gap[data[at:end]])
            cut = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
            cut = max(cut, at + int(gaps[-1]) + 1 if len(gaps) else at)
            if cut > at:
                end = cut
                break
            end = min(n, end + SEGMENT)
        part = data[at:end]
        out = gap[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        inner = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end, side="right")] - at
        edge[inner] = True
        edge[0] = True
        begins = ~out
        begins[1:] &= out[:-1] | edge[1:-1]
        last = ~out
        last[:-1] &= out[1:] | edge[1:-1]
        if marks:
            mark = is_mark[part]
            # tail[i]: everything from i to the word's end is marks
            blocks = np.where(~mark & ~out, np.arange(len(part)), -1)
            last_other = np.maximum.accumulate(blocks)
            e_all = np.flatnonzero(last)
            split = last_other[e_all]
            b_all = np.flatnonzero(begins)
            cut = (split >= b_all) & (split < e_all)
            cut[cut] &= letter[part[split[cut]]]
            begins[split[cut] + 1] = True
            last[split[cut]] = True
        b, e = np.flatnonzero(begins), np.flatnonzero(last)
        up, down = _powers(max(SEGMENT, 1 << (len(part) - 1).bit_length() if len(part) else 1))
        running = np.cumsum(value[part] * up[:len(part)])
        before = np.where(b > 0, running[b - 1], np.uint64(0))
        hashes.append(mix((running[e] - before) * down[b] + (e - b + 1).astype(np.uint64)))
        starts.append(b + at)
        stops.append(e + 1 + at)
        at = end
    h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    s = np.concatenate(starts) if starts else np.empty(0, np.int64)
    e = np.concatenate(stops) if stops else np.empty(0, np.int64)
    return h, s, e, np.searchsorted(s, offsets), data


def released(batches):
    """The batches; then the worker, which lives on between tasks, gives freed memory back to the system."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def hash_word(word: bytes) -> np.uint64:
    return word_hashes(pa.array([word.decode()]))[0][0]
