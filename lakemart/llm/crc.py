"""CRC-32 of joined byte strings, from those of their parts, for whole arrays.

The check sum of ``a + b`` is that of ``a`` moved over as many zero bytes as ``b`` has, XOR that
of ``b``. Moving is linear over bits, so it takes four look-ups by byte; tables hold the moves
over up to ``SHORT`` bytes, longer ones go by powers of two.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np

POLYNOMIAL = 0xEDB88320
SHORT = 64


def _moved(tables: np.ndarray, sums: np.ndarray) -> np.ndarray:
    out = tables[0][sums & 255]
    for k in (1, 2, 3):
        out = out ^ tables[k][(sums >> np.uint32(8 * k)) & np.uint32(255)]
    return out


@cache
def _short_moves() -> np.ndarray:
    """Moves over 0 to ``SHORT`` zero bytes: one table for each byte of a sum."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> np.uint32(1)) ^ (np.uint32(POLYNOMIAL) * (step & np.uint32(1)))
    moves = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
    for _ in range(SHORT):
        last = moves[-1]
        moves.append((last >> np.uint32(8)) ^ step[last & np.uint32(255)])
    return np.stack(moves)


@cache
def _doubled(k: int) -> np.ndarray:
    """The move over ``2 ** k`` zero bytes."""
    if k == 0:
        return _short_moves()[1]
    half = _doubled(k - 1)
    return _moved(half, half)


def joined(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of ``a + b`` from those of ``a`` and ``b`` and the bytes of each ``b``."""
    left, lengths = left.astype(np.uint32), lengths.astype(np.int64)
    moves = _short_moves().ravel()
    at = np.minimum(lengths, SHORT) * 1024
    out = np.zeros(len(left), np.uint32)
    for k in range(4):
        part = (left >> np.uint32(8 * k)) & np.uint32(255)
        out ^= moves.take(at + part + 256 * k)
    long = np.flatnonzero(lengths > SHORT)
    if len(long):
        rest, sums, k = lengths[long] - SHORT, out[long], 0
        while rest.any():
            odd = (rest & 1).astype(bool)
            sums[odd] = _moved(_doubled(k), sums[odd])
            rest, k = rest >> 1, k + 1
        out[long] = sums
    return out ^ right.astype(np.uint32)


def sums_of(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, parts), np.uint32, len(parts))
