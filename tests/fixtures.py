"""Files that tests make for themselves."""

from __future__ import annotations

import io
import os
import struct
import tarfile
import zlib

import numpy as np


def png(width: int, height: int, seed: int = 0) -> bytes:
    """An 8-bit RGB image with pixels that depend on the seed."""
    pixels = np.random.default_rng(seed).integers(0, 256, (height, width, 3), dtype=np.uint8)
    raw = b"".join(b"\0" + row.tobytes() for row in pixels)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def read_png(content: bytes) -> np.ndarray:
    """Pixels of an image made by :func:`png`; anything else raises."""
    if content[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    width, height = struct.unpack(">II", content[16:24])
    at, data = 8, b""
    while at < len(content):
        (size,) = struct.unpack(">I", content[at : at + 4])
        if content[at + 4 : at + 8] == b"IDAT":
            data += content[at + 8 : at + 8 + size]
        at += size + 12
    rows = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(height, 1 + 3 * width)
    return rows[:, 1:].reshape(height, width, 3)


def write(path: str, content: bytes | str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(content.encode() if isinstance(content, str) else content)
    return path


def tar(path: str, members: dict[str, bytes]) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with tarfile.open(path, "w") as archive:
        for name, content in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            archive.addfile(info, io.BytesIO(content))
    return path


def image_tree(root: str) -> str:
    """Good, broken, small, odd-shaped, repeated, hidden, empty and mis-named files."""
    good = png(8, 8, 1)
    write(f"{root}/a.png", good)
    write(f"{root}/sub/copy.PNG", good)
    write(f"{root}/sub/other.png", png(9, 8, 2))
    write(f"{root}/small.png", png(3, 3, 3))
    write(f"{root}/wide.png", png(40, 8, 4))
    write(f"{root}/cut.png", png(8, 8, 5)[:40])
    write(f"{root}/text.jpg", "no image")
    write(f"{root}/.png", good)
    write(f"{root}/empty.webp", b"")
    write(f"{root}/note.txt", "a note")
    return root


def archive(path: str, first: int, n: int = 6) -> str:
    """``n`` samples: the second has no sidecar, the third is broken, the fourth repeats the first."""
    members = {}
    for i in range(n):
        key = f"{first + i:06d}"
        image = png(16, 16, first + i)
        if i == 2:
            image = b"broken"
        members[f"{key}.png"] = image
        if i != 1:
            members[f"{key}.txt"] = f" caption\t{i} é\n".encode()
    return tar(path, members)
