"""Token counts attributed to fields or sections by the offsets of tokens.

A document is encoded once and whole. Each token has a span of characters; it is joined to the section
spans of its document, and a token that crosses a boundary is allocated by an explicit rule:

- `start`: to the section that holds its first character;
- `most`: to the section that holds most of its characters, the earlier one on ties;
- `split`: to all sections it touches, by their share of its characters.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import text as tx

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The published split pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("start", "most", "split")
CHUNK = 1 << 16

RESULT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_sections", "n_crossing", "n_outside")]
    + [T.StructField("section_tokens", T.ArrayType(T.DoubleType()))]
)


@cache
def encoder(vocabulary: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding, and the number of bytes of each token."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def token_ends(encoding: tiktoken.Encoding, sizes: np.ndarray, data: bytes) -> np.ndarray:
    """Byte offsets at which the tokens of a text end.

    Texts longer than `CHUNK` are encoded in parts that begin at a blank after a character that is
    none, where a token begins in any case.
    """
    parts, start = [], 0
    while start < len(data):
        stop = len(data)
        if stop - start > CHUNK:
            at = start + CHUNK
            while at < stop and not (data[at] in b" \n\t\r" and 0x20 < data[at - 1] < 0x7F):
                at += 1
            stop = at
        parts.append(encoding.encode_to_numpy(data[start:stop].decode("utf-8", "replace"), disallowed_special=()))
        start = stop
    return np.cumsum(sizes[np.concatenate(parts)]) if parts else np.zeros(0, dtype=np.int64)


def attribute(begins: np.ndarray, ends: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str) -> tuple[np.ndarray, int, int]:
    """Tokens per section, and how many cross a boundary or lie outside all sections.

    `begins`, `ends`: character spans of the tokens; `starts`, `stops`: those of the sections, in order
    and without overlaps. The interval join is a search of the sorted bounds.
    """
    first = np.searchsorted(stops, begins, "right")
    last = np.searchsorted(starts, ends, "left") - 1
    touched = first <= last
    inside = touched & (first == last)
    whole = inside.copy()
    whole[inside] = (starts[first[inside]] <= begins[inside]) & (ends[inside] <= stops[first[inside]])
    counts = np.bincount(first[whole], minlength=len(starts)).astype(np.float64)
    for t in np.flatnonzero(touched & ~whole):
        span = np.arange(first[t], last[t] + 1)
        held = np.minimum(stops[span], ends[t]) - np.maximum(starts[span], begins[t])
        if rule == "split":
            counts[span] += held / (ends[t] - begins[t])
        elif rule == "most":
            counts[span[held.argmax()]] += 1
        elif starts[span[0]] <= begins[t]:
            counts[span[0]] += 1
    return counts, int((touched & ~whole).sum()), int((~touched).sum())


def counter(vocabulary: Broadcast, pattern: str, rule: str, by_line: bool):
    def rows(texts: pa.Array, sections: pa.Array | None) -> pa.Array:
        encoding, sizes = encoder(vocabulary.value, pattern)
        out, at = [], 0
        for data, offsets in tx.pieces(texts):
            for a, b in zip(offsets[:-1], offsets[1:]):
                own = data[a:b]
                points = tx.code_points(own)
                ends = token_ends(encoding, sizes, own.tobytes())
                begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                # A token may hold a part of a character only; it then counts as holding that character.
                chars = points[begins + 1] - 1 if len(ends) else ends
                if by_line:
                    breaks = points[np.flatnonzero(own == 0x0A) + 1]
                    bounds = np.unique(np.concatenate([[0], breaks, [points[-1]]]))
                    starts, stops = bounds[:-1], bounds[1:]
                else:
                    starts, stops = spans_of(sections[at])
                counts, crossing, outside = attribute(chars, points[ends], starts, stops, rule)
                out.append((len(ends), len(starts), crossing, outside, counts))
                at += 1
        columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(4)]
        return pa.StructArray.from_arrays([*columns, pa.array([r[4] for r in out], pa.list_(pa.float64()))], RESULT.names)

    def lines(texts: pa.Array) -> pa.Array:
        return rows(texts, None)

    def given(texts: pa.Array, sections: pa.Array) -> pa.Array:
        return rows(texts, sections)

    return F.arrow_udf(lines if by_line else given, RESULT)


def spans_of(sections: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    """Sections in order; where they overlap, the later one begins where the earlier ends."""
    pairs = sorted((s["start"], s["end"]) for s in sections.as_py() or [] if s and s["start"] is not None and s["end"] is not None)
    starts, stops, reached = [], [], 0
    for start, stop in pairs:
        start = max(start, reached)
        reached = max(stop, start)
        starts.append(start)
        stops.append(reached)
    return np.array(starts, dtype=np.int64), np.array(stops, dtype=np.int64)


def read_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file, a few MB whatever the data, for all executors."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def join_fields(fields: Sequence[str], separator: str = "\n\n") -> tuple[Column, Column]:
    """One text of several columns, and their sections in it. Null fields are empty."""
    values = [F.coalesce(F.col(c), F.lit("")) for c in fields]
    sections, at = [], F.lit(0).cast("long")
    for value in values:
        end = at + F.char_length(value)
        sections.append(F.struct(at.alias("start"), end.alias("end")))
        at = end + len(separator)
    return F.concat_ws(separator, *values), F.array(*sections)


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str | Column = "text",
    sections: str | Column | None = None,
    rule: str = "start",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """One row per input row: `doc_id`, `n_tokens`, `n_sections`, `n_crossing`, `n_outside`, `section_tokens`.

    `sections` is a column of arrays of (`start`, `end`) in code points; without it the sections are
    the lines, each with its line feed. Tokens outside all sections are counted as such; under `start`
    so are those whose first character is in none, but they are in `n_crossing` if they reach into one.
    Null and empty texts have no tokens and no lines; null sections are none; of overlapping sections
    the earlier keeps the overlap; empty sections get nothing. Null ids and repeated rows are rows like
    others; an empty table gives no rows; other columns are ignored. There is no shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    known = read_vocabulary(docs.sparkSession, vocabulary)
    body = (F.col(text) if isinstance(text, str) else text).cast("binary")
    inputs = [body] if sections is None else [body, F.col(sections) if isinstance(sections, str) else sections]
    counted = counter(known, pattern, rule, sections is None)(*inputs)
    return docs.select(F.col(id_col).alias("doc_id"), counted.alias("t")).select("doc_id", "t.*")
