"""CRC-32 of many byte spans at once, by a table of positions.

A CRC is linear over XOR but for a constant of the length. ``table[distance][byte]`` is what a byte contributes when
``distance`` bytes follow it, so a span's CRC is the XOR of its bytes' contributions and of the CRC of as many zero
bytes. Contributions of all spans are laid end to end and reduced by ``bitwise_xor.reduceat``. Spans beyond the table's
depth are cut into blocks counted from their end; the blocks' values are folded pairwise, each left value moved past
the zero bytes that stand for the right one.
"""

from __future__ import annotations

import numpy as np

POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32 as zlib and Spark have it, bits reflected
ONES = np.uint32(0xFFFFFFFF)
# spans are laid out in runs of at most about this many bytes, so memory doesn't grow with the text
LAID_OUT = 1 << 19


def _after_zeros(table0: np.ndarray, register: np.ndarray) -> np.ndarray:
    """The register after one more zero byte."""
    return (register >> np.uint32(8)) ^ table0[register & np.uint32(255)]


class PositionCrc:
    def __init__(self, depth: int = 256):
        self.depth = depth
        first = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            first = np.where(first & 1, (first >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), first >> np.uint32(1))
        rows, constants = [first], [ONES]
        for _ in range(depth - 1):
            rows.append(_after_zeros(first, rows[-1]))
        for _ in range(depth):
            constants.append(_after_zeros(first, constants[-1]))
        self.table = np.concatenate(rows)                # [distance * 256 + byte]
        self.constants = np.array(constants, np.uint32) ^ ONES  # CRC of 0 .. depth zero bytes
        # one zero byte as a linear map: the images of the 32 bits
        self.one_byte = _after_zeros(first, np.uint32(1) << np.arange(32, dtype=np.uint32))
        block = self.one_byte
        for _ in range(depth.bit_length() - 1):
            block = self.moved(block, block)
        self.one_block = block
        if depth & (depth - 1):
            raise ValueError("depth must be a power of two")

    @staticmethod
    def moved(operator: np.ndarray, values: np.ndarray) -> np.ndarray:
        """``values`` moved past the zero bytes that ``operator`` stands for."""
        bits = (values[..., None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
        return np.bitwise_xor.reduce(np.where(bits.astype(bool), operator, np.uint32(0)), axis=-1)

    def _zeros(self, n: int) -> np.uint32:
        """CRC of ``n`` zero bytes."""
        register, operator = np.array([ONES]), self.one_byte
        while n:
            if n & 1:
                register = self.moved(operator, register)
            operator, n = self.moved(operator, operator), n >> 1
        return register[0] ^ ONES

    def _contributions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """XOR of the bytes' contributions, for spans of 1 to ``depth`` bytes."""
        out = np.empty(len(starts), np.uint32)
        lengths = ends - starts
        upto = np.cumsum(lengths)
        at = 0
        while at < len(starts):
            done = int(upto[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(upto, done + LAID_OUT, "right")))
            n = lengths[at:to]
            first = upto[at:to] - n - done
            left = np.repeat(first + n - 1, n) - np.arange(int(first[-1] + n[-1]))  # bytes that follow
            bytes_at = np.repeat(ends[at:to] - 1, n) - left
            values = self.table.take(left * 256 + data.take(bytes_at))
            out[at:to] = np.bitwise_xor.reduceat(values, first)
            at = to
        return out

    def _long(self, data: np.ndarray, start: int, end: int) -> np.uint32:
        cuts = np.arange(end, start, -self.depth)[::-1]
        values = self._contributions(data, np.maximum(cuts - self.depth, start), cuts)
        operator = self.one_block
        while len(values) > 1:
            if len(values) % 2:  # a block of zero bytes in front adds nothing
                values = np.concatenate([np.zeros(1, np.uint32), values])
            values = self.moved(operator, values[0::2]) ^ values[1::2]
            operator = self.moved(operator, operator)
        return values[0] ^ self._zeros(end - start)

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 (uint32) of ``data[start:end]`` for every span; ``data`` is uint8, spans hold a byte or more."""
        starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
        lengths = ends - starts
        short = lengths <= self.depth
        out = np.empty(len(starts), np.uint32)
        if short.all():
            return self._contributions(data, starts, ends) ^ self.constants[lengths]
        out[short] = self._contributions(data, starts[short], ends[short]) ^ self.constants[lengths[short]]
        for i in np.flatnonzero(~short):
            out[i] = self._long(data, int(starts[i]), int(ends[i]))
        return out
