"""Rolling hashes and sliding minima over whole arrays.

All arithmetic is modulo 2^64. A polynomial prefix sum gives the hash of any
span in constant time; `mix` spreads it over all bits. Hashes only name
candidates: what they propose is compared byte by byte or word by word, except
where a docstring says that 128 bits stand for a text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


_powers: tuple[np.ndarray, np.ndarray] | None = None


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `size` powers of the base and of its inverse."""
    global _powers
    if _powers is None or len(_powers[0]) < size:
        length = max(1 << 16, 1 << (size - 1).bit_length())
        both = []
        for factor in (_BASE, _INVERSE):
            steps = np.full(length, factor, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers = (both[0], both[1])
    return _powers[0][:size], _powers[1][:size]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers, one longer than the input."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=sums[1:])
    return sums


def byte_prefix_sums(data: np.ndarray) -> np.ndarray:
    return prefix_sums(_byte_values()[data])


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every span [start, end), whatever its place."""
    inverse = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(sums: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` values at every place."""
    count = len(sums) - length
    if count <= 0:
        return np.zeros(0, np.uint64)
    return mix((sums[length:] - sums[:-length]) * powers(count)[1])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, in linear time.

    Blocks of `width` values are scanned from both ends; every window is the
    end of one block and the start of the next.
    """
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


# Low bits of a winnowing key that hold the place, high bits hold the hash.
PLACE_BITS = 28


def rightmost_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest hash in every window; the last one wins ties.

    Hashes are compared by their upper 36 bits. An array longer than 2^28 would
    wrap the places, so callers pass less.
    """
    if len(hashes) >= 1 << PLACE_BITS:
        raise ValueError("one text has more than 2^28 units")
    low = np.uint64((1 << PLACE_BITS) - 1)
    places = low - np.arange(len(hashes), dtype=np.uint64)
    least = sliding_minimum((hashes & ~low) | places, width)
    return (low - (least & low)).astype(np.int64)
