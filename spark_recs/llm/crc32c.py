"""CRC-32C (Castagnoli) of many byte strings at once, with NumPy.

The remainder is linear: a message is cut into blocks from its end, each byte
of a block has a table for its distance from the block's end, and block
remainders are merged 16 at a time with tables that shift by a block length.
"""

from __future__ import annotations

import numpy as np

POLY = 0x82F63B78
BLOCK, FAN = 64, 16


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ (np.uint32(POLY) * (t & np.uint32(1)))
    return t


class Crc32c:
    def __init__(self):
        base = _byte_table()
        step = lambda c: base[c & np.uint32(255)] ^ (c >> np.uint32(8))  # one zero byte
        tables = [base]
        for _ in range(BLOCK - 1):
            tables.append(step(tables[-1]))
        self.block = tables[::-1]
        images = step(np.uint32(1) << np.arange(32, dtype=np.uint32))
        self.doubling = [images]  # [k]: images of the 32 bits, shifted by 2**k zero bytes
        for _ in range(40):
            images = self._apply(images, images)
            self.doubling.append(images)
        self.merge: list[list[np.ndarray]] = []

    @staticmethod
    def _apply(images: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for b in range(32):
            out ^= images[b] * ((x >> np.uint32(b)) & np.uint32(1))
        return out

    def _shift(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        """x moved by n zero bytes each."""
        out, n, k = x.copy(), n.astype(np.int64), 0
        while n.any():
            odd = (n & 1).astype(bool)
            if odd.any():
                out[odd] = self._apply(self.doubling[k], out[odd])
            n, k = n >> 1, k + 1
        return out

    def _merge_tables(self, level: int) -> list[np.ndarray]:
        """For each place in a group of FAN: 4 tables, by byte of the remainder."""
        while len(self.merge) <= level:
            length, group = BLOCK * FAN ** len(self.merge), []
            every = np.arange(256, dtype=np.uint32)
            for i in range(FAN):
                far = np.full(256, length * (FAN - 1 - i))
                group.append([self._shift(every << np.uint32(8 * b), far) for b in range(4)])
            self.merge.append(group)
        return self.merge[level]

    @staticmethod
    def _at_end(x: np.ndarray, counts: np.ndarray, unit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pads each run of `counts` in front with zeros to a multiple of `unit`."""
        groups = -(-counts // unit)
        shift = np.cumsum(groups * unit) - np.cumsum(counts)
        out = np.zeros(int(groups.sum()) * unit, dtype=x.dtype)
        out[np.arange(len(x)) + np.repeat(shift, counts)] = x
        return out.reshape(-1, unit), groups

    def many(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of consecutive messages of these lengths in a uint8 array."""
        lengths = lengths.astype(np.int64)
        counts = -(-lengths // BLOCK)
        rows = np.zeros((int(counts.sum()), BLOCK), dtype=np.uint8)
        flat, at = rows.reshape(-1), 0
        for n, end in zip(lengths.tolist(), (np.cumsum(counts) * BLOCK).tolist()):
            flat[end - n: end] = data[at: at + n]
            at += n
        part = np.zeros(len(rows), dtype=np.uint32)
        cols = np.ascontiguousarray(rows.T)
        for j in range(BLOCK):
            part ^= self.block[j][cols[j]]
        level = 0
        while len(counts) and counts.max() > 1:
            tables = self._merge_tables(level)
            groups, counts = self._at_end(part, counts, FAN)
            part = np.zeros(len(groups), dtype=np.uint32)
            for i in range(FAN):
                c = groups[:, i]
                for b in range(4):
                    part ^= tables[i][b][(c >> np.uint32(8 * b)) & np.uint32(255)]
            level += 1
        out = np.zeros(len(lengths), dtype=np.uint32)
        out[counts > 0] = part
        return out ^ self._shift(np.full(len(lengths), 0xFFFFFFFF, dtype=np.uint32), lengths) ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """The checksum as record files store it, so that a checksum of data that
    holds checksums stays sound."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)
