"""Fingerprints of bytes that were copied, by which a rewritten file is known."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable

from appendlake.sources.files import read_blocks

TAIL_BYTES = 4096
# Fixed value: the polynomial of CRC-32, lowest power in the highest bit.
POLYNOMIAL = 0xEDB88320


def tail(path: str, end: int) -> str:
    """Digest of up to ``TAIL_BYTES`` bytes before ``end``."""
    start = max(0, end - TAIL_BYTES)
    return hashlib.md5(b"".join(read_blocks(path, start, end, TAIL_BYTES))).hexdigest()


def checksum(path: str, start: int, end: int, block_bytes: int) -> int:
    """CRC-32 of a range, block by block."""
    crc = 0
    for block in read_blocks(path, start, end, block_bytes):
        crc = zlib.crc32(block, crc)
    return crc


def _product(a: int, b: int) -> int:
    """Product of two polynomials modulo CRC-32's; the highest of 32 bits is the power 0."""
    out = 0
    for power in range(31, -1, -1):
        if a >> power & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


def _shift(length: int) -> int:
    """x to the power of eight times ``length``."""
    out, square = 1 << 31, 1 << 23  # the powers 0 and 8
    while length:
        if length & 1:
            out = _product(out, square)
        square = _product(square, square)
        length >>= 1
    return out


def combined(parts: Iterable[tuple[int, int]]) -> int:
    """CRC-32 of bytes from (CRC-32, length) of their consecutive parts.

    Behind n more bytes a checksum counts as its product with x^8n, so the parts'
    checksums add up without their bytes.
    """
    crc = 0
    for part, length in parts:
        crc = _product(_shift(length), crc) ^ part
    return crc
