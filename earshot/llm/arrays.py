"""Sorted arrays of 64-bit keys: counted in tasks, met in shards, stored and mapped into memory.

Shards are ranges of keys.  Files are in a folder that driver and executors have mounted;
a task that runs again replaces its file by the same one.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ h >> np.uint64(30)
    h *= MIX_A
    h ^= h >> np.uint64(27)
    h *= MIX_B
    return h ^ h >> np.uint64(31)


def local_folder(folder: str) -> str:
    """The folder as a path, which it must be for files in it to be mapped into memory."""
    scheme, colon, rest = folder.partition(":")
    if colon and scheme == "file":
        return "/" + rest.lstrip("/")
    if colon and "/" not in scheme:
        raise ValueError(f"arrays are mapped into memory and need a mounted folder, not {folder}")
    return folder


def store(folder: str, name: str, shard: int, values: np.ndarray) -> None:
    path = f"{folder}/{name}-{shard}"
    passing = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    values.tofile(passing)
    os.replace(passing, path)


_MAPS: dict[str, dict[tuple[str, int], np.ndarray]] = {}


def mapped(folder: str, name: str, shard: int, kind: str, n: int) -> np.ndarray:
    """A stored array of ``n`` values; a file that is not there, or not whole, raises.

    A worker keeps the mappings of one folder at a time.
    """
    if not n:  # shards that nothing fell into have no file
        return np.empty(0, kind)
    if folder not in _MAPS:
        _MAPS.clear()
        _MAPS[folder] = {}
    known = _MAPS[folder]
    if (name, shard) not in known:
        path = f"{folder}/{name}-{shard}"
        there = os.path.getsize(path) if os.path.exists(path) else None
        if there != n * np.dtype(kind).itemsize:
            raise RuntimeError(
                f"{path} should hold {n} values, this machine finds {there} bytes: the folder has "
                "to be the same on all machines"
            )
        known[name, shard] = np.memmap(path, kind, "r")
    return known[name, shard]


def runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of equal values: value, first, one past the last."""
    if len(values):
        firsts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        for a, b in zip(firsts, np.append(firsts[1:], len(values)), strict=True):
            yield int(values[a]), int(a), int(b)


def places(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where sorted ``wanted`` stand in sorted ``known``, -1 for absent ones."""
    if not len(known):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(known, wanted)
    at[at == len(known)] = 0
    return np.where(known[at] == wanted, at, -1)


def range_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key; ``shards`` is a power of two."""
    bits = shards.bit_length() - 1
    return (keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys))).astype(np.int64)


def power_of_two(n: int) -> int:
    """The least power of two from ``n`` on."""
    return 1 << max(0, n - 1).bit_length()


def packed(values: np.ndarray) -> bytes:
    """Steps between sorted values, byte by byte of each: the high bytes, all zero, compress."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def planes(values: np.ndarray) -> bytes:
    """Values byte by byte of each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data), dtype=np.uint64)


def texts_in_chunks(
    batches: Iterator[pa.RecordBatch], size: int, *names: str
) -> Iterator[tuple[list, ...]]:
    """Columns ``names``, then texts as UTF-8 (null: empty), about ``size`` bytes at a time."""
    rows, total = [], 0
    for batch in batches:
        columns = (batch.column(c) for c in (*names, "text"))
        for *values, text in zip(*columns, strict=True):
            data = (text.as_py() or "").encode()
            rows.append((*(v.as_py() for v in values), data))
            total += len(data)
            if total >= size:
                yield tuple(map(list, zip(*rows, strict=True)))
                rows, total = [], 0
    if rows:
        yield tuple(map(list, zip(*rows, strict=True)))
