"""Vectorised hashing of words, for use inside tasks.

Words are runs of bytes that are neither spaces nor \\x09-\\x0D. Hashes have 64 bits; equal
words have equal hashes on every worker, and different word sequences of one corpus share a
hash with a probability of about n * n / 2**65 for n sequences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a column of texts; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def lower_ascii(data: bytes) -> bytes:
    return data.translate(_LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int = 1) -> np.ndarray:
    """n odd pseudo-random 64-bit numbers, the same everywhere; a longer list begins alike."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE)
               + np.uint64(seed)) | np.uint64(1)


_POWERS = multipliers(256)


def _block_hashes(buf: np.ndarray) -> np.ndarray:
    gap = _SEPARATOR[buf]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    longest = int(lengths.max())
    powers = _POWERS if longest <= len(_POWERS) else multipliers(longest)
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = (buf[~gap].astype(np.uint64) + np.uint64(1)) * powers[at]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def slices(data: bytes, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Begin and end of parts of about `size` bytes, cut at separators."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and not _SEPARATOR[data[end]]:
            end += 1
        yield at, end
        at = end


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash for each word of `data`, in order. Works through long texts in blocks
    cut between words, so memory follows the block (or the longest word), not the text."""
    buf = np.frombuffer(data, np.uint8)
    if len(buf) <= BLOCK_BYTES:
        return _block_hashes(buf)
    return np.concatenate([_block_hashes(buf[at:end]) for at, end in slices(data)])


def hashes_of(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """Word hashes of each text; short texts share one vectorised call."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        if group and size + len(text) > BLOCK_BYTES // 2:
            yield from _together(group)
            group, size = [], 0
        group.append(text)
        size += len(text) + 3
    yield from _together(group)


_MARK = b" \x00 "  # a word of its own between texts


def _together(group: list[bytes]) -> Iterator[np.ndarray]:
    if len(group) == 1:
        yield word_hashes(group[0])
        return
    if not group:
        return
    joined = _MARK.join(group)
    hashes = word_hashes(joined)
    gap = _SEPARATOR[np.frombuffer(joined, np.uint8)]
    starts = np.flatnonzero(np.diff(gap, prepend=True) & ~gap)
    ends = np.cumsum([len(t) + len(_MARK) for t in group])[:-1]
    begin = 0
    for mark in [*np.searchsorted(starts, ends - 2).tolist(), len(hashes)]:
        yield hashes[begin:mark]
        begin = mark + 1


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for every run of `length` consecutive words: two overlapping or adjoining
    halves are combined until the length is reached."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    have, out = 1, hashes
    while have < length:
        step = min(have, length - have)
        out = mix(out[:len(out) - step] * np.uint64(_BASE) + out[step:] + np.uint64(have + step))
        have += step
    return out


def long_array(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
