"""Lower-cased words of letters, digits and non-ASCII characters, taken from UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from corpusmill.llm import bytetext

# Every ASCII byte that is no letter or digit becomes a blank; bytes of non-ASCII characters stay as they are.
_TABLE = bytes(int(bytetext.LOWER[b]) if bytetext.ALPHANUMERIC[bytetext.LOWER[b]] else 32 for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


def texts(column: pa.Array) -> Iterator[bytes]:
    """Texts of an Arrow column as UTF-8; NULL is empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""
