"""Quality rules from repetition: how many characters lie inside repeated n-grams and lines."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import text as tx

# Highest share of word characters inside the most frequent n-gram, and inside repeated n-grams.
# Falling with n, and wide enough for a short text that says one sentence twice.
TOP_LIMITS = {2: 0.30, 3: 0.28, 4: 0.26}
REPEAT_LIMITS = {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20}
LINE_LIMIT = 0.30
LINE_CHARS_LIMIT = 0.20
MIN_WORDS = 10
REPEAT_WORDS_PERCENT = 20
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def shares_of() -> list[str]:
    return [f"top_{n}" for n in TOP_LIMITS] + [f"repeat_{n}" for n in REPEAT_LIMITS] + ["dup_line_chars"]


SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(c, T.DoubleType()) for c in shares_of()]
)


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of the texts of one slice."""
    n_texts = len(offsets) - 1
    starts, ends, owner = tx.words(data, offsets)
    points = tx.code_points(data)
    chars = points[ends] - points[starts]
    total = np.bincount(owner, chars, n_texts)
    per_text = lambda values: np.bincount(owner, values, n_texts)
    hashes = tx.span_hashes(data, starts, ends)
    marks = np.concatenate([[0], np.cumsum(SYMBOL[data])])
    out = {
        "n_words": np.bincount(owner, minlength=n_texts),
        "word_chars": total.astype(np.int64),
        "n_symbols": marks[offsets[1:]] - marks[offsets[:-1]],
        "n_repeat_words": np.zeros(n_texts, dtype=np.int64),
    }
    share = np.maximum(total, 1)
    salt = tx.mix(owner.astype(np.uint64) + np.uint64(1))
    prefix = np.concatenate([[0], np.cumsum(chars)])
    for n in [*TOP_LIMITS, *REPEAT_LIMITS]:
        whole = np.flatnonzero(tx.complete(owner, n))
        keys = tx.windows(hashes, n)[whole] ^ salt[whole]
        again, times = tx.repeated(keys)
        places = whole[again]
        if n in TOP_LIMITS:
            top = np.zeros(n_texts)
            np.maximum.at(top, owner[places], (prefix[places + n] - prefix[places]) * times[again])
            out[f"top_{n}"] = np.minimum(top / share, 1.0)
            continue
        edges = np.zeros(len(owner) + 1, dtype=np.int64)
        np.add.at(edges, places, 1)
        np.add.at(edges, places + n, -1)
        inside = np.cumsum(edges)[:-1] > 0
        out[f"repeat_{n}"] = per_text(chars * inside) / share
        if n == 5:
            out["n_repeat_words"] = per_text(inside).astype(np.int64)
    return out | line_measures(data, offsets, starts, prefix, n_texts, share)


def line_measures(data, offsets, starts, prefix, n_texts, share) -> dict[str, np.ndarray]:
    """Lines end at line feeds and at the end of the text; only lines with a word count."""
    begins, stops, owner = tx.runs(data != 0x0A, offsets)
    first, last = np.searchsorted(starts, begins), np.searchsorted(starts, stops)
    spoken = last > first
    begins, stops, owner, first, last = (x[spoken] for x in (begins, stops, owner, first, last))
    keys = tx.span_hashes(data, begins, stops) ^ tx.mix(owner.astype(np.uint64) + np.uint64(1))
    _, index = np.unique(keys, return_index=True)
    earlier = np.ones(len(keys), dtype=bool)
    earlier[index] = False
    chars = prefix[last] - prefix[first]
    return {
        "n_lines": np.bincount(owner, minlength=n_texts),
        "n_dup_lines": np.bincount(owner, earlier, n_texts).astype(np.int64),
        "dup_line_chars": np.bincount(owner, chars * earlier, n_texts) / share,
    }


@F.arrow_udf(SCHEMA)
def measures(texts: pa.Array) -> pa.Array:
    parts = [measure(data, offsets) for data, offsets in tx.pieces(texts)]
    names = COUNTS + shares_of()
    kinds = [np.int64] * len(COUNTS) + [np.float64] * len(shares_of())
    arrays = [np.concatenate([p[n] for p in parts] or [np.zeros(0)]).astype(k) for n, k in zip(names, kinds)]
    return pa.StructArray.from_arrays([pa.array(a) for a in arrays], names)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_WORDS_PERCENT * F.col("n_words"))


def verdict(limits: Mapping[str, float] | None = None) -> Column:
    """True when no share is above its limit."""
    held = {f"top_{n}": v for n, v in TOP_LIMITS.items()} | {f"repeat_{n}": v for n, v in REPEAT_LIMITS.items()}
    held |= {"dup_line_chars": LINE_CHARS_LIMIT} | dict(limits or {})
    fine = F.col("n_dup_lines") <= LINE_LIMIT * F.col("n_lines")
    for name, limit in held.items():
        fine &= F.col(name) <= limit
    return fine


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, counts, shares, `base_failed` and `kept`.

    Rolling word hashes of 2 to 10 words mark repeated windows within each text; shares are word
    characters inside them over all word characters. The work is row by row: no shuffle, so a hot
    source or a group of copies makes no difference, and memory is bounded by a slice of a batch or
    by the longest text. Null and empty texts have zero counts and fail the base rule; null ids and
    repeated rows are passed on as they are; other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col).cast("binary")).alias("m"))
    counted = rows.select("doc_id", "m.*").withColumn("base_failed", base_failed())
    return counted.withColumn("kept", ~F.col("base_failed") & verdict())
