"""64-bit keys dealt to buckets by their first bits and packed into few bytes."""

from __future__ import annotations

import numpy as np


def short_keys(keys: np.ndarray, bits: int) -> bytes:
    """40 bits of each key behind the bucket's; more pieces are compared if two agree by chance."""
    rest = (keys << np.uint64(bits)) >> np.uint64(24)
    return rest.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()


def long_keys(packed: bytes) -> np.ndarray:
    five = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return np.concatenate([np.zeros((len(five), 3), np.uint8), five], 1).copy().view(">u8").ravel().astype(np.uint64)


def bucket_cuts(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of ascending keys with the first and last place of each."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.empty(0, np.int64)
    return bucket[heads], heads, np.append(heads[1:], len(keys))[: len(heads)]
