"""Words as numbers: hashes of words and of runs of words, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesift.llm.bpe import Words
from lakesift.llm.common import one_space, text_of

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd
_MIX = np.uint64(0xD6E8FEB86659FD93)  # odd

#: Null ids come after all others.
LAST_ID = 2**63 - 1


def hasher() -> Words:
    """A bounded table from word to its 64-bit hash."""
    return Words(xxhash.xxh64_intdigest)


def word_hashes(words: list[bytes], known: Words) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the word."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words, by doubling; empty if there are fewer words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, at, power, part, reach = np.zeros(n, np.uint64), 0, np.array([_BASE]), hashes, 1
    while reach <= length:
        if length & reach:
            out = out * power + part[at : at + n]
            at += reach
        if 2 * reach <= length:
            part = part[:-reach] * power + part[reach:]
        power, reach = power * power, 2 * reach
    return mixed(out)


def sequence_key(text_col: str) -> list[Column]:
    """128 bits that tell sequences of words apart; white space does not matter."""
    text = F.trim(one_space(text_of(text_col)))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]
