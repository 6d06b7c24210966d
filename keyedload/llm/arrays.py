"""Sorted arrays in files of the shared folder: written by tasks, memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pyarrow.fs as pafs
import zstandard


def _at(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def save(uri: str, values: np.ndarray) -> None:
    """Writes an array under a name of its own and then renames it, so an attempt that fails leaves no half file."""
    fs, path = _at(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as out:
        out.write(np.ascontiguousarray(values).tobytes())
    fs.move(own, path)


def mapped(uri: str, kind: type) -> np.ndarray:
    """The array of a file, memory-mapped. A file that is not on a mounted file system is fetched first, unlinked once mapped."""
    fs, path = _at(uri)
    if not isinstance(fs, pafs.LocalFileSystem):
        with tempfile.NamedTemporaryFile() as local, fs.open_input_stream(path) as source:
            while chunk := source.read(1 << 22):
                local.write(chunk)
            local.flush()
            return _map(local.name, kind)
    return _map(path, kind)


def _map(path: str, kind: type) -> np.ndarray:
    # As a plain array, whose slices cost less; it keeps the map.
    return np.asarray(np.memmap(path, kind, "r")) if os.path.getsize(path) else np.zeros(0, kind)


# Numbers that have a byte each; larger ones stand in a list beside them.
SMALL = 255


def save_counts(uri: str, counts: np.ndarray) -> None:
    """Counts of one byte each, with a list of the places and values of those that have no room."""
    large = np.flatnonzero(counts >= SMALL)
    save(uri, np.minimum(counts, SMALL).astype(np.uint8))
    save(f"{uri}.large", np.stack([large, counts[large].astype(np.int64)]))


def counts_at(uri: str, places: np.ndarray) -> np.ndarray:
    """The counts at some places of what ``save_counts`` has written."""
    few = mapped(uri, np.uint8)[places]
    out, full = few.astype(np.int64), np.flatnonzero(few == SMALL)
    if len(full):
        large, values = mapped(f"{uri}.large", np.int64).reshape(2, -1)
        out[full] = values[np.searchsorted(large, places[full])]
    return out


# Numbers asked for one after another in the same stretch, from which on the stretch is searched by itself.
RUN = 32


def firsts_of(*columns: np.ndarray) -> np.ndarray:
    """Where rows of ``columns`` are not as the row before."""
    differ = np.ones(len(columns[0]), bool)
    differ[1:] = columns[0][1:] != columns[0][:-1]
    for x in columns[1:]:
        differ[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(differ)


def ascending(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes, sorted, and where each was.

    Their top bits are sorted with their places below, many times as fast as places alone; where those bits do not tell them
    apart, all are compared.
    """
    below = np.uint64((1 << len(values).bit_length()) - 1)
    by = (values & ~below) | np.arange(len(values), dtype=np.uint64)
    by.sort()
    by = (by & below).astype(np.int64)
    out = values[by]
    if (out[1:] < out[:-1]).any():
        by = np.argsort(values)
        out = values[by]
    return out, by


def by_pair(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int) -> np.ndarray:
    """The order of pairs of numbers below ``size_a`` and ``size_b``; as in ``ascending`` with their places, where there is room."""
    bits, at = size_b.bit_length(), len(a).bit_length()
    if size_a.bit_length() + bits > 64:
        return np.lexsort((b, a))
    packed = (a.astype(np.uint64) << np.uint64(bits)) | b.astype(np.uint64)
    if size_a.bit_length() + bits + at > 64:
        return np.argsort(packed)
    packed = (packed << np.uint64(at)) | np.arange(len(a), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << at) - 1)).astype(np.int64)


def count_triples(a: np.ndarray, b: np.ndarray, c: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """The distinct triples of numbers below ``size``, ascending, and how often each comes."""
    bits = size.bit_length()
    if 3 * bits > 64:
        by = np.lexsort((c, b, a))
        firsts = firsts_of(a[by], b[by], c[by])
        first = by[firsts]
        return a[first], b[first], c[first], np.diff(firsts, append=len(a))
    one, two = np.uint64(bits), np.uint64(2 * bits)
    packed = (a.astype(np.uint64) << two) | (b.astype(np.uint64) << one) | c.astype(np.uint64)
    packed.sort()
    firsts = firsts_of(packed)
    packed, n = packed[firsts], np.diff(firsts, append=len(packed))
    low = np.uint64((1 << bits) - 1)
    return *(x.astype(np.int64) for x in (packed >> two, (packed >> one) & low, packed & low)), n


def within(values: np.ndarray, low: np.ndarray, high: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each number asked for stands in its own stretch ``low`` to ``high`` of ``values``, which ascends there; -1: nowhere."""
    at = low.copy()
    starts = firsts_of(low, high)
    sizes = np.diff(starts, append=len(low))
    many = sizes >= RUN
    for i, n in zip(starts[many].tolist(), sizes[many].tolist()):
        at[i : i + n] += values[low[i] : high[i]].searchsorted(asked[i : i + n])
    # All others at once, those not yet found among them.
    open_ = np.flatnonzero(np.repeat(~many, sizes) & (low < high))
    begin, end, x = low[open_], high[open_], asked[open_]
    while len(open_):
        middle = (begin + end) >> 1
        less = values[middle] < x
        begin, end = np.where(less, middle + 1, begin), np.where(less, end, middle)
        going = begin < end
        if not going.all():
            at[open_[~going]] = begin[~going]
            open_, begin, end, x = open_[going], begin[going], end[going], x[going]
    out = np.full(len(low), -1, np.int64)
    inside = np.flatnonzero(at < high)
    same = inside[values[at[inside]] == asked[inside]]
    out[same] = at[same]
    return out


def squeeze(values: np.ndarray, ascending: bool = False) -> bytes:
    """An array as compressed bytes; ascending ones as differences."""
    if ascending and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    # Bytes of one weight together compress better.
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    values = np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)
    return np.cumsum(values, dtype=kind) if ascending else values
