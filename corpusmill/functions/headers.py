"""Type and size of an image from the head of its file.

The six types are told by their first bytes, not by their name. Each is read as far as its size needs, and checked as far as that is
cheap: a PNG chunk by chunk with its checksums, a JPEG by its segments up to the frame. Pixels are not decoded.
"""

from __future__ import annotations

import struct
from zlib import crc32


class BadHeader(ValueError):
    """The bytes are no readable image of a known type."""


def image_size(data: bytes) -> tuple[int, int]:
    """Width and height; :class:`BadHeader` if there are none."""
    try:
        for magic, read in _READERS:
            if data[: len(magic)] == magic:
                width, height = read(data)
                break
        else:
            raise BadHeader("unknown type")
    except (struct.error, IndexError) as short:
        raise BadHeader("cut off") from short
    if width <= 0 or height <= 0:
        raise BadHeader("no area")
    return width, height


def _png(data: bytes) -> tuple[int, int]:
    at, size = 8, None
    while True:
        length, kind = struct.unpack_from(">I4s", data, at)
        (check,) = struct.unpack_from(">I", data, at + 8 + length)
        if crc32(data[at + 4 : at + 8 + length]) != check:
            raise BadHeader("checksum")
        if size is None:
            if kind != b"IHDR":
                raise BadHeader("no IHDR")
            size = struct.unpack_from(">II", data, at + 8)
        if kind == b"IEND":
            return size
        at += 12 + length


# JPEG markers of a frame, and markers without a length.
_FRAMES = {*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC}
_BARE = {0x01, *range(0xD0, 0xD9)}


def _jpeg(data: bytes) -> tuple[int, int]:
    at = 2
    while True:
        if data[at] != 0xFF:
            raise BadHeader("no marker")
        while data[at] == 0xFF:
            at += 1
        marker = data[at]
        at += 1
        if marker in _BARE:
            continue
        if marker in (0xD9, 0xDA):
            raise BadHeader("no frame")
        (length,) = struct.unpack_from(">H", data, at)
        if marker in _FRAMES:
            height, width = struct.unpack_from(">HH", data, at + 3)
            return width, height
        at += length


def _bmp(data: bytes) -> tuple[int, int]:
    (header,) = struct.unpack_from("<I", data, 14)
    if header == 12:
        return struct.unpack_from("<HH", data, 18)
    width, height = struct.unpack_from("<ii", data, 18)
    return width, abs(height)


# TIFF tags of width and height, and the struct codes of their field types.
_TIFF_TAGS = {256: 0, 257: 1}
_TIFF_KINDS = {1: "B", 3: "H", 4: "I"}


def _tiff(data: bytes) -> tuple[int, int]:
    order = "<" if data[:2] == b"II" else ">"
    (at,) = struct.unpack_from(f"{order}I", data, 4)
    (n,) = struct.unpack_from(f"{order}H", data, at)
    size = [0, 0]
    for i in range(n):
        tag, kind, _ = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * i)
        if tag in _TIFF_TAGS:
            if kind not in _TIFF_KINDS:
                raise BadHeader("field type")
            (size[_TIFF_TAGS[tag]],) = struct.unpack_from(order + _TIFF_KINDS[kind], data, at + 10 + 12 * i)
    return size[0], size[1]


def _webp(data: bytes) -> tuple[int, int]:
    length, form, kind = struct.unpack_from("<I4s4s", data, 4)
    if form != b"WEBP" or length + 8 > len(data):
        raise BadHeader("container")
    if kind == b"VP8X":
        width, height = (int.from_bytes(data[i : i + 3], "little") + 1 for i in (24, 27))
        if len(data) < 30:
            raise BadHeader("cut off")
        return width, height
    if kind == b"VP8L":
        if data[20] != 0x2F:
            raise BadHeader("signature")
        (bits,) = struct.unpack_from("<I", data, 21)
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8 ":
        if data[23:26] != b"\x9d\x01\x2a":
            raise BadHeader("start code")
        width, height = struct.unpack_from("<HH", data, 26)
        return width & 0x3FFF, height & 0x3FFF
    raise BadHeader("chunk")


# First bytes of the types.
_READERS = (
    (b"\x89PNG\r\n\x1a\n", _png),
    (b"\xff\xd8", _jpeg),
    (b"BM", _bmp),
    (b"II*\x00", _tiff),
    (b"MM\x00*", _tiff),
    (b"RIFF", _webp),
)
