"""Hashes of many parts of texts at once, in numpy, and how blocks of them travel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base to the power 0 ... n - 1, modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def prefix(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers) of bytes or code points, from which span() takes the hash of any span."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    values = _BYTES[data] if data.dtype == np.uint8 else mix(data.astype(np.uint64)) | np.uint64(1)
    np.cumsum(values * powers(_ODD, n), out=sums[1:])
    return sums, powers(_INVERSE, n + 1)


def span(pre: tuple[np.ndarray, np.ndarray], start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The 64-bit hash of each span; equal spans have equal hashes wherever they stand."""
    sums, inverse = pre
    return mix((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def scatter(bucket: np.ndarray, records: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Records by bucket: (bucket, bytes of its records)."""
    order = np.argsort(bucket, kind="stable")
    bucket, records = bucket[order], records[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.append(0, cuts) if len(bucket) else cuts
    for a, b in zip(starts.tolist(), [*cuts.tolist(), len(bucket)]):
        yield int(bucket[a]), records[a:b].tobytes()


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """Batches of (bucket, blob, ...) sorted by bucket -> each bucket with all its blobs (tuples when there are several)."""
    at, held = None, []
    for batch in batches:
        blobs = batch.column(1).to_pylist() if batch.num_columns == 2 else zip(*(c.to_pylist() for c in batch.columns[1:]))
        for bucket, blob in zip(batch.column(0).to_pylist(), blobs):
            if held and bucket != at:
                yield at, held
                held = []
            at = bucket
            held.append(blob)
    if held:
        yield at, held
