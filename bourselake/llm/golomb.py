"""Golomb-Rice coding of sorted 64-bit hashes, vectorised over one message."""

from __future__ import annotations

import numpy as np

HEADER = 13  # first hash, count, remainder bits


def encode(sorted_hashes: np.ndarray) -> bytes:
    """Distinct ascending uint64 hashes as a header, remainders and unary quotients.

    The gap to the previous hash is split by a power of two near the mean gap:
    the quotient goes in unary, the remainder in that many plain bits.
    """
    n = len(sorted_hashes)
    if n == 0:
        return b""
    gaps = np.diff(sorted_hashes)
    mean = int(sorted_hashes[-1] - sorted_hashes[0]) // max(1, n - 1)
    width = max(0, int(mean * 0.69).bit_length() - 1)
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    low = gaps & np.uint64((1 << width) - 1)
    places = np.arange(width, dtype=np.uint64)
    plain = ((low[:, None] >> places) & np.uint64(1)).astype(np.uint8).ravel()
    unary = np.zeros(int(quotients.sum()) + len(gaps), dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    head = int(sorted_hashes[0]).to_bytes(8, "little") + n.to_bytes(4, "little")
    return head + bytes([width]) + np.packbits(np.concatenate([plain, unary])).tobytes()


def decode(message: bytes) -> np.ndarray:
    """The hashes of ``encode``."""
    if not message:
        return np.empty(0, dtype=np.uint64)
    first = np.uint64(int.from_bytes(message[:8], "little"))
    n, width = int.from_bytes(message[8:12], "little"), message[12]
    bits = np.unpackbits(np.frombuffer(message, dtype=np.uint8, offset=HEADER))
    plain = bits[: (n - 1) * width].reshape(n - 1, width).astype(np.uint64)
    low = (plain << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    ends = np.flatnonzero(bits[(n - 1) * width :])[: n - 1]
    quotients = np.diff(ends, prepend=-1) - 1
    gaps = (quotients.astype(np.uint64) << np.uint64(width)) + low
    return first + np.concatenate([[np.uint64(0)], np.cumsum(gaps, dtype=np.uint64)])
