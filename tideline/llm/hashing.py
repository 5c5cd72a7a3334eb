"""Numpy helpers over the UTF-8 bytes of Arrow batches: word hashes and word shingles.

Batches are taken in slices of about a megabyte, and a longer text in pieces cut at white space, so memory is
bounded by the longest word and the words of the longest text, not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
WORDS = 5
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


BYTE = np.where(SPACES, np.uint64(0), constants(11, 256))
PLACE = constants(12, SLICE)
WORD = constants(13, WORDS + 1)


def byte_slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``limit`` bytes, or one longer row. Texts are not null."""
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield row, raw[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word, in order."""
    if len(offsets) > 2 or len(data) <= SLICE:
        return hash_words(data, offsets)
    hashes, at = [], 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and not SPACES[data[end]]:
            end += 1
        hashes.append(hash_words(data[at:end], np.asarray([0, end - at]))[1])
        at = end
    both = np.concatenate(hashes)
    return np.zeros(len(both), np.int64), both


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    black = ~SPACES[data]
    first = black.copy()
    first[1:] &= ~black[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = black[begins]
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place = np.arange(len(data)) - starts[np.maximum(np.cumsum(first) - 1, 0)]
    sums = np.add.reduceat(BYTE[LOWER[data]] * PLACE[place & (SLICE - 1)], starts)
    length = np.add.reduceat(black.astype(np.uint64), starts)
    return np.searchsorted(offsets, starts, "right") - 1, mix(sums + length * WORD[WORDS])


def shingles(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each row its distinct shingles of five words, sorted; fewer words make one shingle, none an empty set."""
    row, word = words_of(data, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1)
    ends = np.cumsum(n)
    hashed = np.zeros(0, np.uint64)
    if len(word) >= WORDS:
        hashed = mix(sum((word[i:len(word) - WORDS + 1 + i] * WORD[i] for i in range(1, WORDS)), word[:len(word) - WORDS + 1] * WORD[0]))
    for a, b in zip((ends - n).tolist(), ends.tolist()):
        if b - a >= WORDS:
            yield np.unique(hashed[a:b - WORDS + 1])
        elif b > a:
            yield mix((word[a:b] * WORD[:b - a]).sum(keepdims=True) + np.asarray([b - a], np.uint64) * WORD[WORDS])
        else:
            yield np.zeros(0, np.uint64)
