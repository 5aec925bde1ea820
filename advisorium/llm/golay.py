"""Fuzzy hashing with the binary Golay code of length 23: vectors that differ in two bits or fewer share a key.

The code is perfect: every vector lies within three bits of exactly one codeword. The keys of a vector are the
indices of all codewords within four bits. Two vectors u, v that differ in at most two bits have a vector
between them that is within one bit of both; its codeword is within four bits of u and of v, so it is a key of
both. A vector at distance three from its codeword has six keys, any other has one.
"""

from itertools import combinations

GENERATOR = 0b110001110101  # fixed value: generator polynomial of the code
LENGTH, CHECKS = 23, 11


def remainder(vector):
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if vector >> bit & 1:
            vector ^= GENERATOR << (bit - CHECKS)
    return vector


def tables():
    """(remainder of each index shifted by the check bits, error patterns of weight up to four by syndrome)."""
    import numpy as np

    shifted = np.array([remainder(index << CHECKS) for index in range(1 << (LENGTH - CHECKS))], np.int64)
    single = [remainder(1 << bit) for bit in range(LENGTH)]
    patterns = [[] for _ in range(1 << CHECKS)]
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= single[bit]
            patterns[syndrome].append(sum(1 << bit for bit in bits))
    width = max(map(len, patterns))
    return shifted, np.array([p + [-1] * (width - len(p)) for p in patterns], np.int64)


def keys(vectors, made):
    """(position in ``vectors``, codeword index) of every key; ``made`` is what ``tables`` gives."""
    import numpy as np

    shifted, patterns = made
    errors = patterns[shifted[vectors >> CHECKS] ^ (vectors & ((1 << CHECKS) - 1))]
    at, column = np.nonzero(errors >= 0)
    return at, (vectors[at] ^ errors[at, column]) >> CHECKS
