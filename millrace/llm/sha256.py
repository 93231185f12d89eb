"""SHA-256 over many messages at once in numpy, from any state between two blocks.

A state is the eight words that a message's blocks so far have led to, so it can be stored and
resumed elsewhere, which hash objects of the standard library can't.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64
STATE = 32


def _roots(power: int, count: int) -> np.ndarray:
    """The first 32 bits after the point of the square or cube roots of the first primes."""
    primes, n = [], 2
    while len(primes) < count:
        if all(n % p for p in primes):
            primes.append(n)
        n += 1
    found = []
    for p in primes:
        wanted = p << 32 * power
        low, high = 0, 1 << 40
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if middle**power <= wanted else (low, middle)
        found.append(low & 0xFFFFFFFF)
    return np.array(found, np.uint32)


FRESH = _roots(2, 8)
_ROUND = _roots(3, 64)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (8, n) after one more block (16, n) each, both as 32-bit words."""
    w = list(block)
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        s0 = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
        s1 = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
        w.append(w[t - 16] + s0 + w[t - 7] + s1)
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        s1 = _turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)
        first = h + s1 + (g ^ (e & (f ^ g))) + (w[t] + _ROUND[t])
        s0 = _turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)
        second = s0 + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def words(blocks: np.ndarray) -> np.ndarray:
    """Blocks (n, 64) of bytes as (16, n) words."""
    return np.ascontiguousarray(blocks).view(">u4").astype(np.uint32).T.copy()


def closing(sizes: np.ndarray) -> np.ndarray:
    """The last block (16, n) of messages of so many whole blocks."""
    block = np.zeros((16, len(sizes)), np.uint32)
    block[0] = 0x80000000
    bits = sizes.astype(np.uint64) * np.uint64(8 * BLOCK)
    block[14], block[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return block


def stored(state: np.ndarray) -> np.ndarray:
    """States (8, n) as (n, 32) bytes."""
    return np.ascontiguousarray(state.T).astype(">u4").view(np.uint8)


def resumed(data: np.ndarray) -> np.ndarray:
    """States (8, n) from (n, 32) bytes."""
    return np.ascontiguousarray(data).view(">u4").astype(np.uint32).T.copy()


def hexed(state: np.ndarray) -> np.ndarray:
    """Final states (8, n) as (n, 64) bytes of lower-case hex, which are one block each."""
    data = stored(state)
    return _HEX[np.stack([data >> 4, data & 15], axis=2).reshape(len(data), BLOCK)]
