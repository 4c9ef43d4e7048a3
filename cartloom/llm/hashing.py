"""64-bit hashes of the words of a text, computed for all its bytes at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
# Bytes hashed together, so that long texts need little memory.
CHUNK_BYTES = 1 << 17
_BASE = 0x2545F4914F6CDD1D


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


# Powers of an odd base and of its inverse: a word's sum of bytes, weighted by their places in the chunk and divided by the
# weight of its start, doesn't depend on where it stands.
POWERS = _powers(_BASE, CHUNK_BYTES + 1), _powers(pow(_BASE, -1, 1 << 64), CHUNK_BYTES + 1)

WHITE_SPACE = np.zeros(256, dtype=bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Of the one-byte characters only letters and digits, of the others all.
NO_WORD = np.ones(256, dtype=bool)
NO_WORD[128:] = False
NO_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def scrambled(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes, separators: np.ndarray) -> np.ndarray:
    """A hash for each run of bytes that are no separators, in order."""
    parts = [_hashes_of(chunk, separators) for chunk in chunks(data, separators)]
    return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint64), *parts])


def chunks(data: bytes, separators: np.ndarray) -> Iterator[bytes]:
    """``data`` in parts that end at a separator."""
    start = 0
    while len(data) - start > CHUNK_BYTES:
        last = np.flatnonzero(separators[np.frombuffer(data, dtype=np.uint8, count=CHUNK_BYTES, offset=start)])[-1:]
        if not len(last):  # a word longer than a chunk
            rest = np.frombuffer(data, dtype=np.uint8, offset=start + CHUNK_BYTES)
            last = CHUNK_BYTES + np.append(np.flatnonzero(separators[rest]), len(rest) - 1)[:1]
        end = start + int(last[0]) + 1
        yield data[start:end]
        start = end
    if start < len(data):
        yield data[start:]


def _hashes_of(data: bytes, separators: np.ndarray) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], separators[b], [True]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    powers, inverse = POWERS if len(b) <= CHUNK_BYTES else (_powers(int(p[1]), len(b)) for p in POWERS)
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b + np.uint64(1)) * powers[: len(b)], out=sums[1:])
    return scrambled((sums[ends] - sums[starts]) * inverse[starts] * MIX + (ends - starts).astype(np.uint64))
