"""Vectorised views of a batch of texts: one byte array with document and word boundaries, no Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are looked at together; a longer text is a chunk of its own.
CHUNK_BYTES = 4_000_000

_seeds = np.random.default_rng(20260101)
_BYTE = _seeds.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _seeds.integers(0, 2**64, 8192, dtype=np.uint64) | np.uint64(1)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, document offsets into them) of consecutive rows; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_bounds(separator: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end positions of the runs without a separator; a document's end also ends a run."""
    inside = ~separator
    begin = inside.copy()
    begin[1:] &= separator[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(inside)]
    begin[edges] = inside[edges]
    starts = np.flatnonzero(begin)
    stop = inside.copy()
    stop[:-1] &= separator[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    stop[last] = inside[last]
    return starts, np.flatnonzero(stop) + 1


def hash_runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``data``; runs are consecutive, start at ``starts`` and fill ``data``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    return mix64(np.add.reduceat(_BYTE[data] * _PLACE[place & 8191], starts) + lengths.astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash (A-Z lower-cased), document index and byte length of every word between ASCII white space."""
    space = SPACE[data]
    starts, ends = word_bounds(space, offsets)
    lengths = ends - starts
    packed = LOWER[data[~space]]
    at = np.cumsum(lengths) - lengths
    return hash_runs(packed, at, lengths), np.searchsorted(offsets, starts, "right") - 1, lengths
