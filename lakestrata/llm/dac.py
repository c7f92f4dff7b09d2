"""Directly addressable codes of token ids (numpy, one block at a time).

An id is cut into chunks of eight bits. Level 0 holds the lowest chunk of every
id, level 1 the next chunk of the ids that need one, and so on. A bitmap per
level says which chunks go on; the number of ones before every 512th bit (the
rank directory) leads from a place in one level to its place in the next. So
any id is read from as many places as it has chunks, without decoding others.

Bytes of a block, all numbers little-endian: ``DAC1``, the number of ids and of
levels (uint32 each); then per level the number of chunks (uint32), the chunks,
the bitmap padded to whole 8-byte words, and the directory (uint32 each). The
last level has neither bitmap nor directory.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
_STEP = 512


def encode(ids: np.ndarray) -> bytes:
    """The block of ``ids`` (unsigned 32 bit)."""
    rest = np.ascontiguousarray(ids, np.uint32)
    levels = []
    while True:
        chunk, rest = (rest & 255).astype(np.uint8), rest >> 8
        more = rest > 0
        if not more.any():
            levels.append(struct.pack("<I", len(chunk)) + chunk.tobytes())
            break
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)])
        ones = np.add.reduceat(more, np.arange(0, len(more), _STEP), dtype=np.uint32)
        before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
        levels.append(
            struct.pack("<I", len(chunk)) + chunk.tobytes() + bits.tobytes() + before.tobytes()
        )
        rest = rest[more]
    return MAGIC + struct.pack("<II", len(ids), len(levels)) + b"".join(levels)


class Reader:
    """Random access to the ids of a block."""

    def __init__(self, block: bytes | memoryview):
        magic, self.size, n_levels = struct.unpack_from("<4sII", block)
        if magic != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        at, self.levels = 12, []
        for level in range(n_levels):
            (n,) = struct.unpack_from("<I", block, at)
            chunks = np.frombuffer(block, np.uint8, n, at + 4)
            at += 4 + n
            if level == n_levels - 1:
                self.levels.append((chunks, None, None))
                break
            n_bytes, n_steps = (n + 63) // 64 * 8, -(-n // _STEP)
            bits = np.frombuffer(block, np.uint8, n_bytes, at)
            before = np.frombuffer(block, "<u4", n_steps, at + n_bytes)
            at += n_bytes + 4 * n_steps
            self.levels.append((chunks, bits, before))

    def _rank(self, level: int, place: int) -> int:
        """Ones of a level's bitmap before ``place``."""
        _, bits, before = self.levels[level]
        step = min(place // _STEP, len(before) - 1)
        part = bits[step * _STEP // 8 : (place + 7) // 8].copy()
        if place % 8:
            part[-1] &= (1 << place % 8) - 1
        return int(before[step]) + int(np.bitwise_count(part).sum())

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, place: int) -> int:
        if not 0 <= place < self.size:
            raise IndexError(place)
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[place]) << (8 * level)
            if bits is None or not bits[place >> 3] >> (place & 7) & 1:
                break
            place = self._rank(level, place)
        return value

    def slice(self, begin: int, end: int) -> np.ndarray:
        """Ids from ``begin`` up to ``end``; only their chunks are touched."""
        ids = np.zeros(end - begin, np.uint32)
        where = np.arange(end - begin)
        for level, (chunks, bits, _) in enumerate(self.levels):
            ids[where] |= chunks[begin:end].astype(np.uint32) << np.uint32(8 * level)
            if bits is None or end == begin:
                break
            first = begin & ~7
            flags = np.unpackbits(bits[first >> 3 : (end + 7) >> 3], bitorder="little")
            more = flags[begin - first : end - first].astype(bool)
            begin = self._rank(level, begin)
            end = begin + int(more.sum())
            where = where[more]
        return ids
