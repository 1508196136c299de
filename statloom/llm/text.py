"""Words, lines and rolling hashes of whole Arrow batches, in numpy.

Texts are handled as UTF-8 bytes. A word is a run of bytes other than the six ASCII blanks
(space and 0x09 to 0x0D). Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CHAIN = np.uint64(0xD6E8FEB86659FD93)

SOLID = np.ones(256, dtype=bool)
SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(values: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of runs of texts of about `limit` bytes; a longer text is a run of its own."""
    values = pc.fill_null(pc.cast(values, pa.large_binary()), b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    start = 0
    while start < len(values):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(values))
        yield data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def runs(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs of true values; runs end where texts end."""
    filled = offsets[:-1][np.diff(offsets) > 0]
    before = np.zeros(len(solid), dtype=bool)
    before[1:] = solid[:-1]
    before[filled] = False
    after = np.zeros(len(solid), dtype=bool)
    after[:-1] = solid[1:]
    after[filled[1:] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs(SOLID[data], offsets)


def code_points(data: np.ndarray) -> np.ndarray:
    """Number of code points that begin before each byte, with one entry more than bytes."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans from one prefix sum."""
    powers = np.full(len(data) + 1, BASE, dtype=np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=prefix[1:])
    powers[1:] = BASE_INVERSE
    powers[0] = 1
    np.cumprod(powers, out=powers)
    lengths = (ends - starts).astype(np.uint64)
    return mix((prefix[ends] - prefix[starts]) * powers[starts] + mix(lengths))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the `n` entries from each place on; `n - 1` fewer entries than given."""
    size = max(len(hashes) - n + 1, 0)
    out = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        out = out * CHAIN + hashes[i : i + size]
    return mix(out)


def complete(owner: np.ndarray, n: int) -> np.ndarray:
    """Which windows of `n` entries lie within one text."""
    size = max(len(owner) - n + 1, 0)
    return owner[:size] == owner[len(owner) - size :] if size else np.zeros(0, dtype=bool)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry whether its value occurs twice or more, and how often it occurs."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, int)
    counts = np.diff(np.append(first, len(keys)))
    times = np.empty(len(keys), dtype=np.int64)
    times[order] = np.repeat(counts, counts)
    return times > 1, times
