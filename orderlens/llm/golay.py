"""The binary Golay code (23, 12, 7), vectorised.

The code is perfect: every 23-bit word is within three bits of exactly one
codeword.  ``near_indices`` lists the codewords within four bits of a word (one
for words within two bits of a codeword, six for the others).  Two words at
most two bits apart share one of them: flip one of the differing bits, and the
codeword nearest to that midpoint is within four bits of both.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
BITS = 23


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words modulo the generator."""
    r = words.astype(np.int64).copy()
    for top in range(BITS - 1, 10, -1):
        r ^= ((r >> top) & 1) * (GENERATOR << (top - 11))
    return r


def _error_table() -> np.ndarray:
    errors = [0] + [sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(BITS), n)]
    errors = np.array(errors, dtype=np.int64)
    table = np.full(1 << 11, -1, dtype=np.int64)
    table[_remainders(errors)] = errors
    assert (table >= 0).all()  # perfect: each remainder has one error of at most three bits
    return table


_ERRORS = _error_table()


def nearest_index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the nearest codeword of each word."""
    words = words.astype(np.int64)
    return (words ^ _ERRORS[_remainders(words)]) >> 11


def near_indices(words: np.ndarray) -> np.ndarray:
    """(n, 24) indices of all codewords within four bits; repeats are -1."""
    words = words.astype(np.int64)
    flips = np.concatenate([[0], 1 << np.arange(BITS)]).astype(np.int64)
    found = np.sort(nearest_index((words[:, None] ^ flips[None, :]).ravel()).reshape(len(words), -1), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found
