"""Zip archives put together from members that many tasks have compressed in pieces.

A piece is a raw deflate stream that ends at a byte's border without a last block, so pieces that follow one another are one stream, and
the CRC-32 of the whole follows from theirs. Putting an archive together only copies bytes, and all sizes are known before its first.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

#: The polynomial of CRC-32, reflected, as zip archives use it.
_POLY = 0xEDB88320
#: A last block that is empty.
LAST = b"\x03\x00"
#: What a gzip file begins with.
GZIP = b"\x1f\x8b\x08\0\0\0\0\0\4\xff"
_FULL = 0xFFFFFFFF


class Piece(NamedTuple):
    """Where a piece lies in a file; the bytes of its text and their CRC-32."""

    path: str
    start: int
    size: int
    text: int
    crc: int


class Press:
    """Compresses one piece."""

    def __init__(self):
        self.press, self.text, self.crc = zlib.compressobj(1, zlib.DEFLATED, -15), 0, 0

    def put(self, text: bytes | memoryview) -> bytes:
        self.text, self.crc = self.text + len(text), zlib.crc32(text, self.crc)
        return self.press.compress(text)

    def end(self) -> bytes:
        return self.press.flush(zlib.Z_FULL_FLUSH)


def _times(a: int, b: int) -> int:
    """The product of two polynomials modulo that of CRC-32."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (_POLY if b & 1 else 0)
    return out


def crc_of_both(first: int, second: int, size: int) -> int:
    """The CRC-32 of two texts one after the other, from theirs and the bytes of the second."""
    power, square, n = 1 << 31, 1 << 30, size * 8
    while n:
        if n & 1:
            power = _times(square, power)
        square, n = _times(square, square), n >> 1
    return _times(power, first) ^ second


def put_together(fs, members: list[tuple[str, str, list[Piece]]]) -> Iterator[bytes]:
    """The bytes of an archive of members (name, head, pieces), whose texts are the head and then the pieces in their order."""
    at, central = 0, []
    for name, head, pieces in members:
        press, encoded = Press(), name.encode()
        begin = press.put(head.encode()) + press.end()
        crc, text, size = press.crc, press.text, len(begin) + sum(p.size for p in pieces) + len(LAST)
        for p in pieces:
            crc, text = crc_of_both(crc, p.crc, p.text), text + p.text
        # 8: deflate, 33: the first of January 1980, 45: sizes of 64 bits
        own = struct.pack("<4s5H3L2H", b"PK\3\4", 45, 0, 8, 0, 33, crc, _FULL, _FULL, len(encoded), 20) + encoded + struct.pack("<2H2Q", 1, 16, text, size)
        central.append(struct.pack("<4s6H3L5H2L", b"PK\1\2", 45, 45, 0, 8, 0, 33, crc, _FULL, _FULL, len(encoded), 28, 0, 0, 0, 0, _FULL) + encoded + struct.pack("<2H3Q", 1, 24, text, size, at))
        yield own + begin
        for p in pieces:
            with fs.open_input_file(p.path) as f:
                f.seek(p.start)
                left = p.size
                while left:
                    block = f.read(min(left, 4 << 20))
                    if not block:
                        raise EOFError(f"{p.path} ends early")
                    left -= len(block)
                    yield block
        yield LAST
        at += len(own) + size
    listed, n = b"".join(central), len(members)
    yield listed + struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, len(listed), at) + struct.pack("<4sLQL", b"PK\6\7", 0, at + len(listed), 1) + struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, n, n, len(listed), _FULL, 0)
