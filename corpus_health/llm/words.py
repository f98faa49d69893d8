"""Words and five-word shingles as the near-duplicate operators see them."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters between words: fixed values, space and the five ASCII controls from tab to carriage return.
GAPS = " \t\n\x0b\x0c\r"
GAP_PATTERN = r"[\x20\x09-\x0D]+"
#: Words of a shingle.
SHINGLE = 5

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP_PATTERN), "")


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all bits."""
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a text with fewer words is one shingle, without words none."""
    found = (text or "").encode("utf-8", "surrogatepass").split()  # splits bytes at exactly the characters of GAPS
    if not found:
        return np.empty(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    n = max(1, len(hashed) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(min(size, len(hashed))):
        out = mixed(out * _STEP + hashed[i : i + n])
    return np.unique(out)
