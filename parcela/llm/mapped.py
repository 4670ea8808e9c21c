"""Arrays as one file that workers map into memory, and a bounded way for it to reach them."""

from __future__ import annotations

import json

import numpy as np


def pack_arrays(arrays: dict[str, np.ndarray]) -> bytes:
    """A header line with names, types, lengths and offsets, then the arrays' bytes at multiples of 64."""
    at, head, parts = 0, [], []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head.append([name, a.dtype.str, len(a), at])
        parts.append(raw + b"\0" * (-len(raw) % 64))
        at += len(parts[-1])
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 64) + b"\n"
    return b"".join([line, *parts])


def map_arrays(path: str) -> dict[str, np.ndarray]:
    """Views of the mapped pages."""
    with open(path, "rb") as f:
        line = f.readline()
    data = np.memmap(path, np.uint8, "r")
    return {name: data[len(line) + at:len(line) + at + n * np.dtype(kind).itemsize].view(kind)
            for name, kind, n, at in json.loads(line)}
