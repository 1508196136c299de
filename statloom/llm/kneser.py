"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over n-grams of `ORDER` symbols from an alphabet of 32: blank, letters, digit, and
classes of punctuation and of bytes beyond ASCII. So its tables have at most 32 ** ORDER rows, however
much text is counted. Counts of all trusted documents are grouped by n-gram; joins of counts, context
totals and continuation counts, order by order, give the probability of every n-gram; a join of each
document's n-gram counts with that table gives its perplexity. Cuts are quantiles over the trusted
documents of each language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import text as tx
from statloom.session import materialise

BITS = 5
ORDER = 4
GRAMS = 1 << (BITS * ORDER)
UNIT = 1e-6  # surprisals are whole numbers of this many nats, so sums do not depend on their order
GRID = 1000  # and documents are cut on means rounded to this many units
QUANTILE = 0.99
SLACK = 1.25
BROADCAST_IDS = 2_000_000

SYMBOL = np.full(256, 28, dtype=np.uint32)  # 28: punctuation
SYMBOL[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
SYMBOL[0x61:0x7B] = np.arange(1, 27)
SYMBOL[0x41:0x5B] = np.arange(1, 27)
SYMBOL[0x30:0x3A] = 27
SYMBOL[list(b"#*$%&|<>")] = 29
SYMBOL[0xC0:] = 30
SYMBOL[0x80:0xC0] = 31


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte, with blanks before the text, and the text it is in."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    symbols = SYMBOL[data]
    code = symbols.copy()
    for back in range(1, ORDER):
        code[back:] |= symbols[:-back] << np.uint32(BITS * back)
    for place in range(ORDER - 1):
        at = offsets[:-1] + place
        at = at[at < offsets[1:]]
        code[at] &= np.uint32((1 << (BITS * (place + 1))) - 1)
    return code, owner


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all n-grams of a task's texts, in one table of fixed size."""
    total = np.zeros(GRAMS, dtype=np.int64)
    for batch in batches:
        for data, offsets in tx.pieces(batch.column(0)):
            total += np.bincount(grams(data, offsets)[0], minlength=GRAMS)
    seen = np.flatnonzero(total)
    yield pa.record_batch([pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["g", "c"])


PAIR = T.ArrayType(T.StructType([T.StructField("g", T.IntegerType()), T.StructField("n", T.IntegerType())]))


@F.arrow_udf(PAIR)
def gram_counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The distinct n-grams of each text with their counts, in a batch per slice of texts."""
    for texts in batches:
        for data, offsets in tx.pieces(texts):
            code, owner = grams(data, offsets)
            keys, counts = np.unique((owner.astype(np.int64) << (BITS * ORDER)) | code, return_counts=True)
            bounds = np.searchsorted(keys, np.arange(len(offsets), dtype=np.int64) << (BITS * ORDER))
            parts = [pa.array((keys & (GRAMS - 1)).astype(np.int32)), pa.array(counts.astype(np.int32))]
            yield pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays(parts, ["g", "n"]))


def discounts(counts: DataFrame) -> list[float]:
    """The three discounts of a level, from how many n-grams were seen once to four times."""
    row = counts.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in range(1, 5)]).first()
    return discounts_of([row[f"n{k}"] for k in range(1, 5)])


def discounts_of(n: list[int]) -> list[float]:
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw)]


def level(counts: DataFrame, lower: DataFrame | None, order: int) -> DataFrame:
    """Probability `p` of every n-gram `g` of an order, from its counts and the order below."""
    spark = counts.sparkSession
    d1, d2, d3 = discounts(counts)
    contexts = counts.groupBy(F.shiftright("g", BITS).alias("h")).agg(
        F.sum("c").alias("total"),
        (d1 * F.count(F.when(F.col("c") == 1, 1)) + d2 * F.count(F.when(F.col("c") == 2, 1)) + d3 * F.count(F.when(F.col("c") > 2, 1))).alias("held"),
    )
    every = spark.range(1 << (BITS * order)).select(F.col("id").alias("g"), F.shiftright("id", BITS).alias("h"), F.col("id").bitwiseAND((1 << (BITS * (order - 1))) - 1).alias("low"))
    joined = every.join(counts, "g", "left").join(contexts, "h", "left")
    below = F.lit(2.0**-BITS)
    if lower is not None:
        joined = joined.join(lower.select(F.col("g").alias("low"), F.col("p").alias("p_low")), "low")
        below = F.col("p_low")
    discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    own = F.coalesce((F.col("c") - discount) / F.col("total"), F.lit(0.0))
    return joined.select("g", (own + F.coalesce(F.col("held") / F.col("total"), F.lit(1.0)) * below).alias("p"))


def model(trusted: DataFrame) -> DataFrame:
    """`g` and `cost`, the surprisal in units, for each of the 32 ** ORDER n-grams.

    `trusted` has the texts in its only column. Below the highest order, the count of an n-gram is the
    number of different symbols that come before it.
    """
    partial = trusted.mapInArrow(count_grams, "g long, c long")
    counts = [materialise(partial.groupBy("g").agg(F.sum("c").alias("c")), "gram-counts")]
    for order in range(ORDER - 1, 0, -1):
        shorter = counts[-1].groupBy(F.col("g").bitwiseAND((1 << (BITS * order)) - 1).alias("g"))
        counts.append(materialise(shorter.agg(F.count("*").alias("c")), "gram-counts"))
    lower = None
    for order, own in enumerate(reversed(counts), 1):
        lower = level(own, lower, order)
    return materialise(lower.select("g", F.round(-F.log("p") / UNIT).cast("long").alias("cost")), "gram-costs")


def flag_trusted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Mark rows of `docs` whose `doc_id` is among `ids`: by broadcast while those are few."""
    marked = ids.distinct().select(F.col("doc_id").alias("of_doc"), F.lit(True).alias("trusted"))
    few = ids.count() <= BROADCAST_IDS
    if few:
        marked = F.broadcast(marked)
    flagged = docs.join(marked, F.col("doc_id") == F.col("of_doc"), "left").withColumn("trusted", F.coalesce("trusted", F.lit(False))).drop("of_doc")
    # Shuffled rows come in any order: they are written, so that reading them again gives the same.
    return flagged if few else materialise(flagged, "flagged")


def cuts(scored: DataFrame, by_language: bool, quantile: float) -> DataFrame:
    """The `quantile` of `mean_cost` over trusted rows, per language or over all. Exact on its grid."""
    keys = ["lang"] if by_language else []
    counts = scored.where("trusted and mean_cost is not null").groupBy(*keys, "mean_cost").count()
    ordered = W.partitionBy(*keys).orderBy("mean_cost")
    running = counts.withColumn("upto", F.sum("count").over(ordered)).withColumn("all", F.sum("count").over(W.partitionBy(*keys)))
    return running.where(F.col("upto") >= F.col("all") * F.lit(quantile)).groupBy(*keys).agg(F.min("mean_cost").alias("cut"))


def perplexity(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    quantile: float = QUANTILE,
) -> DataFrame:
    """One row per input row: `doc_id`, `lang`, `trusted`, `n_grams`, `perplexity`, `cut`, `kept`.

    `trusted_ids` has the ids of trusted documents in `doc_id`. A row is kept if its perplexity is at
    most `SLACK` times the cut of its language; a language, or null, without trusted text takes the cut
    over all trusted text, and without any all texts pass. Null and empty texts have no perplexity and
    are not kept. Null ids are never trusted; repeated rows get the same result; an empty table gives
    no rows; other columns are ignored. Documents are not shuffled unless trusted ids are many; hot
    languages are combined before the shuffle and each task sends a bounded number of counts.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("body"))
    rows = flag_trusted(rows, trusted_ids.where(F.col("doc_id").isNotNull()))
    costs = model(rows.where("trusted").select("body"))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    single = numbered.select("row", "doc_id", "lang", "trusted", F.explode_outer(gram_counts("body")).alias("x"))
    single = single.select("row", "doc_id", "lang", "trusted", F.col("x.g").cast("long").alias("g"), F.col("x.n").cast("long").alias("n"))
    # The table of costs has 32 ** ORDER rows by construction.
    priced = single.join(F.broadcast(costs), "g", "left")
    # The row number stands for the other keys; sums of numbers by hash need no sort.
    sums = priced.groupBy("row", "doc_id", "lang", "trusted").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_grams"), F.sum(F.col("n") * F.col("cost")).alias("cost"))
    mean = F.floor(F.col("cost") / F.nullif(F.col("n_grams"), F.lit(0)) / GRID)
    scored = materialise(sums.select("doc_id", "lang", "trusted", "n_grams", mean.alias("mean_cost")), "perplexities")
    own = cuts(scored, True, quantile).select(F.col("lang").alias("of_lang"), F.col("cut").alias("own_cut"))
    pooled = cuts(scored, False, quantile).select(F.col("cut").alias("all_cut"))
    languages = scored.select("lang").distinct().join(own, F.col("lang").eqNullSafe(F.col("of_lang")), "left").drop("of_lang")
    bounds = materialise(languages.join(pooled, F.lit(True), "left").select(F.col("lang").alias("of_lang"), F.coalesce("own_cut", "all_cut").alias("cut")), "cuts")
    joined = scored.join(bounds, F.col("lang").eqNullSafe(F.col("of_lang"))).drop("of_lang")
    return joined.select("doc_id", "lang", "trusted", "n_grams", as_perplexity("mean_cost").alias("perplexity"), as_perplexity("cut").alias("cut"), verdict().alias("kept"))


def as_perplexity(column: str) -> Column:
    return F.exp(F.col(column) * (GRID * UNIT))


def verdict() -> Column:
    fine = F.col("mean_cost") <= F.coalesce(F.col("cut"), F.col("mean_cost")) + F.lit(np.log(SLACK) / UNIT / GRID)
    return F.coalesce(fine, F.lit(False))
