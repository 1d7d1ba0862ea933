"""Helpers shared by the operators: Arrow batches in tasks, words as spans of a byte buffer."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lendscape.sources.store import scratch

# Bytes of text handled at once inside a task (more where only distinct words are kept), and
# bytes hashed at once. Byte and word arrays take about twenty times a slice.
SLICE_BYTES = 2 << 20
WORD_BYTES = 16 << 20
HASH_BYTES = 1 << 20

# Fixed multipliers of the word hash (odd 64-bit numbers) and of the mixing function.
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it back.

    Cuts lineage: the files outlive any executor, and consumers do not compute the frame anew.
    """
    path = f"{scratch(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reachable(df: DataFrame) -> DataFrame:
    """Let Python workers on this machine import the package from where the driver has it.

    On a cluster the package is installed or shipped with ``--py-files`` as usual.
    """
    root, sc = str(Path(__file__).parents[2]), df.sparkSession.sparkContext
    paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return df


def map_tables(
    df: DataFrame, fn: Callable[[pa.Table], pa.Table | None], schema: str | T.StructType
) -> DataFrame:
    """Apply a function of Arrow tables to every batch; a returned None adds no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(pa.Table.from_batches([batch]))
            if out is not None and out.num_rows:
                yield from out.combine_chunks().to_batches()

    return reachable(df).mapInArrow(run, schema)


def texts(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """Text column as one large-string array, NULL read as the empty text."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.string())
    return pc.fill_null(array.cast(pa.large_string()), "")


def slices(array: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges holding about ``most`` bytes each; a longer text stands alone."""
    ends = offsets_of(array)[1:]
    at, base = 0, int(offsets_of(array)[0])
    while at < len(array):
        stop = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield at, stop
        base, at = int(ends[stop - 1]), stop


def offsets_of(array: pa.Array) -> np.ndarray:
    """Byte offsets of a large-string array, one more than rows."""
    raw = np.frombuffer(array.buffers()[1], np.int64) if len(array) else np.zeros(1, np.int64)
    return raw[array.offset : array.offset + len(array) + 1]


def buffer_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins (rows + 1 offsets)."""
    offsets = offsets_of(array)
    data = array.buffers()[2] if len(array) else None
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_class(pattern: Callable[[int], bool]) -> np.ndarray:
    return np.array([pattern(b) for b in range(256)])


# Words of the contracts: runs of bytes other than ASCII white space.
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def spans(
    data: np.ndarray, offsets: np.ndarray, member: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of member bytes, never across texts: starts, ends, first run of each text.

    The third array has an entry per text and one more, as offsets into the runs.
    """
    inside = member[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = inside
    after = np.append(inside, False)
    starts = np.flatnonzero(after[:-1] & (~before[:-1] | border[:-1]))
    ends = np.flatnonzero(inside & (~after[1:] | border[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(BASE, -1, 1 << 64)
_TABLES: list[np.ndarray] = []


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes; equal bytes give equal hashes in every task.

    Polynomial in an odd base modulo 2**64 over running sums, mixed with the length.
    """
    if not _TABLES:
        _TABLES.extend((_powers(BASE, HASH_BYTES), _powers(_INVERSE, HASH_BYTES)))
    up, down = _TABLES
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, base + HASH_BYTES, "right")))
        part = data[base : int(ends[stop - 1])].astype(np.uint64) + np.uint64(1)
        if len(part) > HASH_BYTES:  # one very long span
            total, unit = 0, pow(BASE, HASH_BYTES, 1 << 64)
            for i in range(0, len(part), HASH_BYTES):
                piece = part[i : i + HASH_BYTES]
                total += int((piece * up[: len(piece)]).sum()) * pow(
                    unit, i // HASH_BYTES, 1 << 64
                )
            out[at] = np.uint64(total % (1 << 64))
        else:
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * up[: len(part)], out=sums[1:])
            a = starts[at:stop] - base
            out[at:stop] = (sums[ends[at:stop] - base] - sums[a]) * down[a]
        at = stop
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(MIX[1]))


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values over each text's range ``first[i]:first[i + 1]``."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def coded_words(array: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """White-space words: a code for each, where each text begins, and the distinct words."""
    parts = pc.ascii_split_whitespace(array)
    flat = parts.flatten()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    coded = flat.dictionary_encode()
    ends = np.asarray(parts.offsets)
    return np.asarray(coded.indices), ends - ends[0], coded.dictionary.to_pylist()


def gather(lengths: np.ndarray, starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Concatenate ``values[starts[i]:starts[i] + lengths[i]]`` over all i."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
