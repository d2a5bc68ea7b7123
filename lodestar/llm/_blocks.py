"""Arrays of whole numbers as compressed blocks, for rows that Spark shuffles or stores."""

from __future__ import annotations

import numpy as np
import zstandard


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as one zstd block, their bytes plane by plane."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(block: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    planes = raw.reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of whole numbers >= 0 as blocks, each after its size."""
    out = []
    for values in arrays:
        block = squeeze(values.astype(np.uint64))
        out += [len(block).to_bytes(4, "little"), block]
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        size = int.from_bytes(blob[at:at + 4], "little")
        out.append(unsqueeze(blob[at + 4:at + 4 + size], np.uint64).astype(np.int64))
        at += 4 + size
    return out
