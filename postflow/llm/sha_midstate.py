"""SHA-256 over many messages at once, with states that can be copied, stored and resumed.

The standard library's hash objects can be copied but not stored. Here a state between two blocks
of 64 bytes is eight 32-bit words, so a table can hold it and any task can go on from it. A digest
in hexadecimal is exactly one block.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

BLOCK_BYTES = 64
LANES = 4096  # messages that are hashed together: their arrays stay in the cache


def primes(count: int) -> list[int]:
    found, number = [], 2
    while len(found) < count:
        if all(number % p for p in found):
            found.append(number)
        number += 1
    return found


def cube_root(value: int) -> int:
    """The whole part, by bisection."""
    low, high = 0, 1 << (value.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle ** 3 <= value else (low, middle - 1)
    return low


# The standard's constants: fractions of the roots of the first primes.
ROUND = [np.uint32(cube_root(p << 96) & 0xFFFFFFFF) for p in primes(64)]
INITIAL = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in primes(8)], dtype=np.uint32)
HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def compressed(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states (n x 8 words) after one more block each (n x 16 words)."""
    out = np.empty_like(states)
    for at in range(0, len(states), LANES):
        part = slice(at, at + LANES)
        w = list(np.ascontiguousarray(blocks[part].T))
        before = list(np.ascontiguousarray(states[part].T))
        a, b, c, d, e, f, g, h = before
        for i in range(64):
            if i >= 16:
                x, y = w[i - 15], w[i - 2]
                w.append(w[i - 16] + (turned(x, 7) ^ turned(x, 18) ^ (x >> np.uint32(3))) + w[i - 7]
                         + (turned(y, 17) ^ turned(y, 19) ^ (y >> np.uint32(10))))
            one = (h + (turned(e, 6) ^ turned(e, 11) ^ turned(e, 25)) + (g ^ (e & (f ^ g)))
                   + ROUND[i] + w[i])
            two = (turned(a, 2) ^ turned(a, 13) ^ turned(a, 22)) + ((a & b) | (c & (a | b)))
            a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
        for column, (old, new) in enumerate(zip(before, (a, b, c, d, e, f, g, h))):
            out[part, column] = old + new
    return out


def initial(count: int) -> np.ndarray:
    return np.repeat(INITIAL[None], count, axis=0)


def finished(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests of messages of so many whole blocks, from the states after them."""
    closing = np.zeros((len(states), 16), dtype=np.uint32)
    closing[:, 0] = 1 << 31
    closing[:, 15] = blocks * (8 * BLOCK_BYTES)
    return compressed(states, closing)


def words_of(digests: list[bytes]) -> np.ndarray:
    """Raw digests as rows of eight words."""
    return np.frombuffer(b"".join(digests), dtype=">u4").astype(np.uint32).reshape(-1, 8)


def raw(words: np.ndarray) -> np.ndarray:
    """Words as bytes (n x 32)."""
    return np.ascontiguousarray(words.astype(">u4")).view(np.uint8).reshape(
        len(words), 4 * words.shape[1])


def hex_bytes(words: np.ndarray) -> np.ndarray:
    """Digests in hexadecimal (n x 64 bytes)."""
    data = raw(words)
    return HEX[np.stack([data >> 4, data & 15], axis=2)].reshape(len(words), 2 * data.shape[1])


def hex_blocks(words: np.ndarray) -> np.ndarray:
    """Digests in hexadecimal, as the words of one block each."""
    return np.ascontiguousarray(hex_bytes(words)).view(">u4").astype(np.uint32).reshape(-1, 16)
