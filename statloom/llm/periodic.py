"""Periodic runs of words within a text: seeds on diagonals, extended to maximal runs."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import text as tx

LEAST_WORDS = 6
LEAST_PERIODS = 4

SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "n_runs", "start", "length", "period", "exponent_milli")]
    + [T.StructField(c, T.StringType()) for c in ("runs_sha256", "collapsed_sha256")]
)


def lag_classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """(gram, smallest lag, largest lag) for all periods that a text of `longest` words can hold.

    Two copies of a run of period q overlap, shifted by q, in at least max(6, 4q) - q words, so a
    gram of that many words recurs at lag q. The largest lag of a class is half its gram at most.
    """
    yield LEAST_WORDS - 1, 1, 2
    low = 3
    while LEAST_PERIODS * low <= longest:
        high = 3 * low // 2
        yield (LEAST_PERIODS - 1) * low, low, high
        low = high + 1


def numbered(keys: np.ndarray) -> np.ndarray:
    """Numbers of equal keys; -1 for a key that occurs once."""
    _, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    number[times[number] == 1] = -1
    return number


def doubled(name: np.ndarray, size: int) -> np.ndarray:
    """Names of grams of twice `size` words, from those of `size` words."""
    out = np.full(len(name), -1, dtype=np.int64)
    places = np.flatnonzero(name[: max(len(name) - size, 0)] >= 0)
    places = places[name[places + size] >= 0]
    out[places] = numbered(name[places] * len(name) + name[places + size])
    return out


def seeds(name: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Per class of lags: places of grams that recur, the lag to the next occurrence, and the gram.

    `name` numbers the words that occur twice or more in their own text, exactly. Only the next
    occurrence is paired, and that is enough: a gram of at least two periods that recurred sooner
    would have a shorter period as well, and so would the run. A gram that does not recur is no part
    of a longer one that does, so the places left shrink from class to class.
    """
    size = 1
    places = np.flatnonzero(name >= 0)
    for gram, low, high in lag_classes(longest):
        while 2 * size <= gram:
            name = doubled(name, size)
            size *= 2
        places = places[places + gram <= len(name)]
        first, last = name[places], name[places + gram - size]
        both = (first >= 0) & (last >= 0)
        places, key = places[both], first[both] * len(name) + last[both]
        order = np.argsort(key, kind="stable")
        places, key = places[order], key[order]
        same = key[1:] == key[:-1]
        lag = np.diff(places)
        found = same & (lag >= low) & (lag <= high)
        yield places[:-1][found], lag[found], gram
        again = np.zeros(len(places), dtype=bool)
        again[1:] |= same
        again[:-1] |= same
        places = np.sort(places[again])
        if not len(places):
            return


def runs(name: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of the runs, by start and period.

    On each lag the seeds are taken by place, with the furthest place covered so far. A seed on a
    covered diagonal is not extended again: within one stretch each seed follows the seed before it
    by one word, so the last of them ends where the extension ends.
    """
    found = []
    for place, lag, gram in seeds(name, longest):
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        opens = np.ones(len(place), dtype=bool)
        opens[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(place)) - 1 if len(first) else first
        start, period = place[first], lag[first]
        length = place[last] + gram - start + period
        whole = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append((start[whole], length[whole], period[whole]))
    start, length, period = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def looped(owner: np.ndarray, counts: np.ndarray, loops: list) -> np.ndarray:
    """For each word the number of the word that takes its place. A loop (a, p) of a text repeats
    the p words from word a on to the end of the text."""
    source = np.arange(len(owner))
    begins = np.cumsum(counts) - counts
    for t, loop in enumerate(loops):
        if loop is not None and counts[t]:
            start, period = loop
            tail = np.arange(counts[t] - start)
            source[begins[t] + start : begins[t] + counts[t]] = begins[t] + start + tail % period
    return source


def digest(data: bytes | memoryview) -> str:
    return hashlib.sha256(data).hexdigest()


def measure(data: np.ndarray, offsets: np.ndarray, loop_of) -> list[tuple]:
    """One row of SCHEMA per text of a slice. `loop_of` gives a loop or None for (text, words)."""
    starts, ends, owner = tx.words(data, offsets)
    n_texts = len(offsets) - 1
    counts = np.bincount(owner, minlength=n_texts)
    begins = np.cumsum(counts) - counts
    lengths = ends - starts
    packed = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(starts),
        [None, pa.py_buffer(np.append(0, np.cumsum(lengths)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[tx.SOLID[data]]))],
    )
    word = pc.dictionary_encode(packed).indices.to_numpy().astype(np.int64)
    source = looped(owner, counts, [loop_of(t, int(n)) for t, n in enumerate(counts)])
    word, starts, lengths = word[source], starts[source], lengths[source]
    longest = int(counts.max(initial=0))
    start, length, period = runs(numbered(owner * (len(word) + 1) + word), longest)
    text_of = owner[start] if len(start) else start
    bounds = np.searchsorted(text_of, np.arange(n_texts + 1))

    edges = np.zeros(len(word) + 1, dtype=np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges)[:-1] == 0
    sizes = np.where(kept, lengths + 1, 0)
    stops = np.append(0, np.cumsum(sizes))
    take = np.arange(stops[-1]) + np.repeat(starts - stops[:-1], sizes)
    joined = data[np.minimum(take, len(data) - 1)]
    joined[stops[1:][kept] - 1] = 0x20
    joined = memoryview(joined)

    rows = []
    for t in range(n_texts):
        a, b = bounds[t], bounds[t + 1]
        lines = "".join(f"{s - begins[t]},{n},{p}\n" for s, n, p in zip(start[a:b], length[a:b], period[a:b]))
        left, right = stops[begins[t]], stops[begins[t] + counts[t]]
        collapsed = digest(joined[left : max(right - 1, left)])
        best = [None] * 4
        if b > a:
            i = a + int(np.argmax(length[a:b]))
            best = [int(start[i] - begins[t]), int(length[i]), int(period[i]), int(1000 * length[i] // period[i])]
        rows.append((int(counts[t]), int(b - a), *best, digest(lines.encode()), collapsed))
    return rows


def no_loop(doc_id: int | None, n: int) -> None:
    return None


def planted_loop(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """The loop that the contract's query plants into a tenth of the texts, by crc32 of the id."""
    code = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if code % 10 or not n:
        return None
    g = code // 10
    start = g % n
    return start, 1 + (n - start) // (3 + g % 8)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loop=no_loop) -> DataFrame:
    """One row per input row: `doc_id`, `n_words`, `n_runs`, the longest run (`start`, `length`,
    `period`, `exponent_milli`), `runs_sha256` and `collapsed_sha256`.

    A run is a stretch of words of smallest period q and at least max(6, 4q) words that no
    neighbouring word extends. All runs of a text are found, exactly: grams are compared by numbers,
    not by hashes. `runs_sha256` covers `start,length,period` lines by start and period,
    `collapsed_sha256` the words joined by a blank without those behind the first period of a run.
    `loop` may name for (id, number of words) a loop to plant first.

    The work is row by row, without a shuffle: a text takes time of words times the logarithm of
    words whatever repeats in it, since each place is paired with the next occurrence only. Memory
    is bounded by a slice of a batch or by the longest text. Null, empty and blank texts have no
    words and no run: four nulls and the digests of the empty string. Repeated rows give repeated
    results; null ids are kept (and get no planted loop); of runs of equal length the first, then the
    one of the smaller period is the longest; other columns are ignored, whatever their names.
    """

    @F.arrow_udf(SCHEMA)
    def measured(ids: pa.Array, texts: pa.Array) -> pa.Array:
        names, rows, at = ids.to_pylist(), [], 0
        for data, offsets in tx.pieces(texts):
            here = at
            rows += measure(data, offsets, lambda t, n: loop(names[here + t], n))
            at += len(offsets) - 1
        columns = list(zip(*rows)) or [[]] * len(SCHEMA)
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], SCHEMA.names)

    found = measured(F.col(id_col), F.col(text_col).cast("binary"))
    return docs.select(F.col(id_col).alias("doc_id"), found.alias("found")).select("doc_id", "found.*")
