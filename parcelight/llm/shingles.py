"""Word shingles as 64-bit hashes, and the SimHash fingerprint of such hashes."""

from __future__ import annotations

import numpy as np
import xxhash


def shingle_hashes(text: bytes, size: int, seed: int = 42) -> np.ndarray:
    """The XXH64 values of a text's lower-cased word shingles; of the whole sequence if it has fewer than size words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, k = b" ".join(words), min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)


def majority(h: np.ndarray) -> int:
    """The 64 bits of which each is set if it is set in over half of the hashes; 0 for none."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        some = h[at : at + (1 << 16)].astype(">u8")
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(h)).tobytes(), "big")
