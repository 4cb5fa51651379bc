"""Block-compressed files: members of at most 64 KiB, each a gzip member that names its own size."""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from typing import BinaryIO

from ..functions.coords import VirtualPosition
from . import files

#: Fixed values of the format: the empty member that ends a file, the header up to the size, and the data in one member.
EOF = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
_HEAD = bytes.fromhex("1f8b08040000000000ff060042430200")
BLOCK = 65280
NONE, FAST, BEST = 0, 1, 9


def pack_block(data: bytes, level: int = 6) -> bytes:
    """One member; data that does not shrink is stored."""
    for lv in (level, 0):
        z = zlib.compressobj(lv, zlib.DEFLATED, -15)
        body = z.compress(data) + z.flush()
        if len(body) + 26 <= 65536:
            return _HEAD + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))
    raise ValueError("too much data for a block")


def read_block(file: BinaryIO, at: int) -> tuple[bytes, int]:
    """(data, offset of the next member) of the member at ``at``; empty data at the end of the file."""
    file.seek(at)
    head = file.read(12)
    if not head:
        return b"", at
    if len(head) < 12 or head[:4] != b"\x1f\x8b\x08\x04":
        raise ValueError(f"no block at offset {at}")
    extra = file.read(struct.unpack("<H", head[10:12])[0])
    size, i = None, 0
    while i + 4 <= len(extra):
        n = struct.unpack("<H", extra[i + 2 : i + 4])[0]
        if extra[i : i + 2] == b"BC" and n == 2:
            size = struct.unpack("<H", extra[i + 4 : i + 6])[0] + 1
        i += 4 + n
    if size is None:
        raise ValueError(f"the block at offset {at} has no size")
    body = file.read(size - 12 - len(extra))
    data = zlib.decompress(body[:-8], -15)
    if struct.unpack("<II", body[-8:]) != (zlib.crc32(data), len(data)):
        raise ValueError(f"the block at offset {at} is damaged")
    return data, at + size


class Reader:
    """Sequential and random reading; positions are virtual."""

    def __init__(self, path: str, start: int = 0):
        self.file = files.open_input(path)
        self.block, self.data, self.at, self.next = 0, b"", 0, 0
        self.seek(start)

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()

    def size(self) -> int:
        """Compressed bytes of the file."""
        return self.file.seek(0, 2)

    def seek(self, position: int | VirtualPosition) -> None:
        v = int(position)
        self.block = v >> 16
        self.data, self.next = read_block(self.file, self.block)
        self.at = v & 0xFFFF
        self._skip_empty()

    def _skip_empty(self) -> None:
        while self.at >= len(self.data):
            data, after = read_block(self.file, self.next)
            if after == self.next:
                return
            self.block, self.data, self.at, self.next = self.next, data, 0, after

    def tell(self) -> int:
        """The virtual position of the next byte, as a number."""
        return self.block << 16 | self.at if self.at < len(self.data) else self.next << 16

    def virtual_position(self) -> VirtualPosition:
        return VirtualPosition.from_u64(self.tell())

    def read(self, n: int) -> bytes:
        out = b""
        while len(out) < n and self.at < len(self.data):
            part = self.data[self.at : self.at + n - len(out)]
            out += part
            self.at += len(part)
            self._skip_empty()
        return out

    def read_all(self) -> bytes:
        parts = []
        while part := self.read(1 << 16):
            parts.append(part)
        return b"".join(parts)

    def read_line(self) -> bytes:
        out = b""
        while self.at < len(self.data):
            stop = self.data.find(b"\n", self.at)
            part = self.data[self.at : len(self.data) if stop < 0 else stop + 1]
            out += part
            self.at += len(part)
            self._skip_empty()
            if out.endswith(b"\n"):
                break
        return out


class OffsetIndex:
    """A GZI file: compressed and uncompressed offsets of the blocks behind the first."""

    def __init__(self, entries: list[tuple[int, int]]):
        self.entries = entries

    @classmethod
    def from_path(cls, path: str) -> OffsetIndex:
        with open(path, "rb") as f:
            n = struct.unpack("<Q", f.read(8))[0]
            return cls([struct.unpack("<QQ", f.read(16)) for _ in range(n)])

    @classmethod
    def of_file(cls, path: str) -> OffsetIndex:
        """Walk the blocks of a file."""
        entries, at, total = [], 0, 0
        with open(path, "rb") as f:
            while True:
                data, after = read_block(f, at)
                if after == at:
                    return cls(entries)
                total, at = total + len(data), after
                entries.append((at, total))

    def write(self, path: str) -> None:
        with open(path, "wb") as f:
            f.write(struct.pack("<Q", len(self.entries)) + b"".join(struct.pack("<QQ", *e) for e in self.entries))

    def __len__(self) -> int:
        return len(self.entries)

    def query(self, position: int) -> VirtualPosition:
        """Where the byte at an uncompressed offset is."""
        i = bisect_right(self.entries, position, key=lambda e: e[1])
        block, begin = self.entries[i - 1] if i else (0, 0)
        return VirtualPosition(block, position - begin)


class Writer:
    def __init__(self, path: str, level: int = 6):
        if not 0 <= level <= 9:
            raise ValueError("the level must be from 0 to 9")
        self.file, self.level, self.rest = files.open_output(path), level, bytearray()
        self.written = 0

    def __enter__(self) -> Writer:
        return self

    def __exit__(self, *_: object) -> None:
        self.finish()

    def position(self) -> int:
        """Compressed bytes so far."""
        return self.written

    def tell(self) -> int:
        """The virtual position of the next byte, as a number."""
        return self.written << 16 | len(self.rest)

    def virtual_position(self) -> VirtualPosition:
        return VirtualPosition(self.written, len(self.rest))

    def _put(self, data: bytes) -> None:
        block = pack_block(data, self.level)
        self.file.write(block)
        self.written += len(block)

    def write(self, data: bytes) -> None:
        self.rest += data
        while len(self.rest) >= BLOCK:
            self._put(bytes(self.rest[:BLOCK]))
            del self.rest[:BLOCK]

    def flush(self) -> None:
        if self.rest:
            self._put(bytes(self.rest))
            self.rest.clear()

    def finish(self) -> None:
        if not self.file.closed:
            self.flush()
            self.file.write(EOF)
            self.file.close()
