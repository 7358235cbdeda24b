"""Reading ZIP archives by ranges: the directory first, then only the bytes that are asked for.

The end record, the ZIP64 locator and end record, and the central directory are parsed here, from any file object
that can seek. Members must be stored (neither compressed nor encrypted) to be read by range.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

_END, _END64_AT, _END64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_LONGEST_COMMENT = 0xFFFF


class BadArchive(ValueError):
    """Bytes that are no readable archive, with what is wrong."""


@dataclass(frozen=True)
class Member:
    name: str
    stored: bool
    size: int
    crc: int
    #: Where the local header starts, from the beginning of the file.
    header: int


def read_at(file, start: int, length: int) -> bytes:
    file.seek(start)
    data = file.read(length)
    if len(data) != length:
        raise BadArchive(f"cut off: {length} bytes wanted at {start}, {len(data)} found")
    return data


def members(file, size: int) -> list[Member]:
    """The central directory of a file of ``size`` bytes, in its order. Bytes before the archive are allowed."""
    tail_at = max(0, size - 22 - _LONGEST_COMMENT)
    tail = read_at(file, tail_at, size - tail_at)
    at = tail.rfind(_END)
    # The last mark whose comment ends with the file: a comment may hold the mark itself.
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at + 3) if at else -1
    if at < 0:
        raise BadArchive("no end of central directory")
    disk, first_disk, _, count, length, offset = struct.unpack_from("<HHHHII", tail, at + 4)
    end = tail_at + at
    end, disk, first_disk, count, length, offset = _wide_end(file, end, (disk, first_disk, count, length, offset))
    if disk or first_disk:
        raise BadArchive("archives of several disks are not read")
    shift = end - length - offset
    if shift < 0:
        raise BadArchive("central directory lies outside the file")
    return _entries(read_at(file, offset + shift, length), count, shift)


def _wide_end(file, end: int, narrow: tuple[int, ...]) -> tuple[int, ...]:
    """The ZIP64 end record, named by the locator right before the end record; without one, the narrow values hold."""
    if end < 20 or (locator := read_at(file, end - 20, 20))[:4] != _END64_AT:
        return (end, *narrow)
    named = struct.unpack_from("<Q", locator, 8)[0]
    # Where bytes stand before the archive the named place is early; the record then ends at the locator.
    for at in (named, end - 20 - 56):
        if 0 <= at <= end - 20 - 56 and (record := read_at(file, at, 56))[:4] == _END64:
            disk, first_disk, _, count, length, offset = struct.unpack_from("<IIQQQQ", record, 16)
            return at, disk, first_disk, count, length, offset
    if _FULL16 in narrow[:3] or _FULL32 in narrow[3:]:
        raise BadArchive("no ZIP64 end of central directory")
    return (end, *narrow)


def _entries(data: bytes, count: int, shift: int) -> list[Member]:
    out, at = [], 0
    for _ in range(count):
        if data[at : at + 4] != _ENTRY or at + 46 > len(data):
            raise BadArchive(f"bad directory entry {len(out)}")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        crc, packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIIHHH", data, at + 16)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + n_name]
        extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
        plain, packed, header = _widened(extra, plain, packed, header)
        stored = method == 0 and not flags & 1 and packed == plain
        out.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), stored, plain, crc, header + shift))
        at += 46 + n_name + n_extra + n_comment
    return out


def _widened(extra: bytes, *values: int) -> list[int]:
    """Those of size, packed size and offset that are full, from the ZIP64 extra field, which holds only them, in this order."""
    wide, at = b"", 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = extra[at + 4 : at + 4 + length]
        at += 4 + length
    out, at = [], 0
    for value in values:
        if value == _FULL32 and at + 8 <= len(wide):
            value, at = struct.unpack_from("<Q", wide, at)[0], at + 8
        out.append(value)
    return out


def data_at(file, member: Member) -> int:
    """Where the bytes of a stored member start."""
    if not member.stored:
        raise BadArchive(f"member {member.name} is not stored")
    header = read_at(file, member.header, 30)
    if header[:4] != _LOCAL:
        raise BadArchive(f"no local header of {member.name}")
    n_name, n_extra = struct.unpack_from("<HH", header, 26)
    return member.header + 30 + n_name + n_extra
