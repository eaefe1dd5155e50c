"""Number columns packed into binary rows, for shuffles of many small numbers."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard

#: Rows that travel: the partition they go to, what they hold, and the packed columns.
SCHEMA = "part int, kind int, data binary"

_HEAD = struct.Struct("<cBq")


def pack(*columns: np.ndarray) -> bytes:
    """Bytes of like weight stand together, so that numbers that are small or change slowly take little room."""
    head, body = [bytes([len(columns)])], []
    for c in columns:
        c = np.ascontiguousarray(c)
        head.append(_HEAD.pack(c.dtype.kind.encode(), c.dtype.itemsize, len(c)))
        body.append(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.dtype.itemsize).T).tobytes())
    return b"".join(head) + zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(data: bytes) -> list[np.ndarray]:
    n, at, shapes = data[0], 1, []
    for _ in range(n):
        kind, width, length = _HEAD.unpack_from(data, at)
        shapes.append((np.dtype(f"<{kind.decode()}{width}"), length))
        at += _HEAD.size
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at:]), np.uint8)
    out, at = [], 0
    for dtype, length in shapes:
        size = dtype.itemsize * length
        planes = raw[at : at + size].reshape(dtype.itemsize, length)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += size
    return out


def joined(blobs: list[list[np.ndarray]], width: int) -> list[np.ndarray]:
    """Columns of several unpacked rows, one after the other."""
    return [np.concatenate([b[i] for b in blobs]) for i in range(width)]


def rows(found: Iterable[tuple[int, int, bytes]], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of ``SCHEMA``, each of a few MB."""
    out, held = [], 0

    def batch() -> pa.RecordBatch:
        parts, kinds, data = zip(*out)
        arrays = [pa.array(parts, pa.int32()), pa.array(kinds, pa.int32()), pa.array(data, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["part", "kind", "data"])

    for row in found:
        out.append(row)
        held += len(row[2])
        if held >= size:
            yield batch()
            out, held = [], 0
    if out:
        yield batch()


def dealt(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, where its rows are, in their order) for each part that occurs."""
    order = np.argsort(parts, kind="stable")
    cuts = np.flatnonzero(np.diff(parts[order])) + 1
    for where in np.split(order, cuts):
        if len(where):
            yield int(parts[where[0]]), where


def spread(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each 64-bit hash, by its upper bits."""
    return ((hashes >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
