"""Helpers for functions that run on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task (a longer text is handled alone).
SLICE_BYTES = 4 << 20


def slices(batches: Iterable[pa.RecordBatch], text: int = -1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into row ranges whose column number ``text`` has about ``limit`` bytes."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(size) - size) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, z in zip(np.r_[0, cuts], np.r_[cuts, b.num_rows]):
            yield b.slice(int(a), int(z - a))


def column(name: str, values, kind: pa.DataType) -> tuple[str, pa.Array]:
    return name, pa.array(values, type=kind)


def batch(*columns: tuple[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c for _, c in columns], names=[n for n, _ in columns])


def binary(data: bytes | np.ndarray, ends: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """A binary (or string) array over one buffer; ``ends`` are the end offsets of its values."""
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.Array.from_buffers(kind or pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all spans, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
