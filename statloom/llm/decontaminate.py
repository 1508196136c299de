"""Benchmark decontamination by greedy string tiling.

Documents and test items are sequences of lower-cased runs of letters and digits. Windows of `SEED`
tokens that both have are the seeds. Each pair that shares enough of them is tiled: the longest
matches by running Karp-Rabin hashes are marked, again and again, until none of `SEED` tokens is left.
Tiles may lie anywhere in either text, so passages with their sentences in another order count too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm import text as tx
from statloom.session import materialise

SEED = 5
COVERAGE = 0.5
FILTER_BITS = 25
SALTS = 16
TOKEN = np.zeros(256, dtype=bool)
TOKEN[np.r_[0x30:0x3A, 0x41:0x5B, 0x61:0x7B, 0x80:0x100]] = True

LONGS = T.ArrayType(T.LongType())
ITEM = T.StructType([T.StructField("tokens", LONGS), T.StructField("seeds", LONGS)])
HITS = T.StructType([T.StructField("runs", T.ArrayType(LONGS)), T.StructField("seeds", LONGS)])
TILING = T.StructType([T.StructField(c, T.LongType()) for c in ("covered", "tiles", "longest")])


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice, and the text that each belongs to."""
    starts, ends, owner = tx.runs(TOKEN[data], offsets)
    return tx.span_hashes(data, starts, ends), owner


def longs(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


@F.arrow_udf(ITEM)
def item_tokens(texts: pa.Array) -> pa.Array:
    out = []
    for data, offsets in tx.pieces(pc.utf8_lower(texts)):
        hashes, owner = tokens(data, offsets)
        whole = np.flatnonzero(tx.complete(owner, SEED))
        seeds = tx.windows(hashes, SEED)[whole]
        every = np.arange(len(offsets))
        parts = [longs(hashes, np.searchsorted(owner, every)), longs(seeds, np.searchsorted(owner[whole], every))]
        out.append(pa.StructArray.from_arrays(parts, ITEM.names))
    return pa.concat_arrays(out) if out else pa.array([], pa.struct([(f, pa.list_(pa.int64())) for f in ITEM.names]))


def filter_slots(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return seeds & mask, (seeds >> np.uint64(32)) & mask


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """A Bloom filter of `2 ** FILTER_BITS` bits of all seeds of the benchmark, whatever their number."""
    mask = F.lit((1 << FILTER_BITS) - 1)
    slots = F.array(F.col("seed").bitwiseAND(mask), F.shiftrightunsigned("seed", 32).bitwiseAND(mask))
    bits = seeds.select(F.explode(slots).alias("slot"))
    words = bits.groupBy(F.shiftright("slot", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 as int))")).alias("bits"))
    table = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    for word, value in words.collect():
        table[word] = value
    return table


def seeded_runs(table: Broadcast):
    @F.arrow_udf(HITS)
    def find(texts: pa.Array) -> pa.Array:
        """Stretches of tokens that are covered by windows which pass the filter, and those windows."""
        bits, runs, found = table.value, [], []
        for data, offsets in tx.pieces(pc.utf8_lower(texts)):
            hashes, owner = tokens(data, offsets)
            seeds = tx.windows(hashes, SEED)
            passed = tx.complete(owner, SEED)
            for slot in filter_slots(seeds):
                passed &= (bits[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32)) & 1 == 1
            places = np.flatnonzero(passed)
            bounds = np.searchsorted(owner[places], np.arange(len(offsets)))
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = places[a:b]
                cuts = np.flatnonzero(np.diff(own) > SEED) + 1
                runs.append([hashes[p[0] : p[-1] + SEED].view(np.int64) for p in np.split(own, cuts) if len(p)])
                found.append(np.unique(seeds[own]).view(np.int64))
        parts = [pa.array(runs, pa.list_(pa.list_(pa.int64()))), pa.array(found, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(parts, HITS.names)

    return find


def best_matches(item: np.ndarray, text: np.ndarray, free: tuple[np.ndarray, np.ndarray], size: int) -> list[tuple[int, int, int]]:
    """For each place of the item its longest match of `size` or more unmarked tokens: (length, item, text)."""
    item_hashes, text_hashes = tx.windows(item, size), tx.windows(text, size)
    clear = [np.convolve(f, np.ones(size, dtype=int), "valid") == size if len(f) >= size else np.zeros(0, bool) for f in free]
    places = np.flatnonzero(clear[1])
    order = places[np.argsort(text_hashes[places], kind="stable")]
    ordered = text_hashes[order]
    out = []
    for i in np.flatnonzero(clear[0]):
        lo, hi = np.searchsorted(ordered, item_hashes[i], "left"), np.searchsorted(ordered, item_hashes[i], "right")
        at, length = order[lo:hi], size
        while len(at):
            held = at
            if i + length >= len(item) or not free[0][i + length]:
                break
            at = at[at + length < len(text)]
            at = at[(text[at + length] == item[i + length]) & free[1][at + length]]
            length += 1 if len(at) else 0
        if hi > lo:
            out.append((length, int(i), int(held.min())))
    return out


def greedy_tiles(item: np.ndarray, text: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (length, place in item, place in text); each token of either side is in one at most."""
    free = np.ones(len(item), dtype=bool), np.ones(len(text), dtype=bool)
    tiles = []
    size = max(min(len(item), len(text)) // 2, least)
    while True:
        found = best_matches(item, text, free, size)
        longest = max((f[0] for f in found), default=0)
        if longest > 2 * size:
            size = longest
            continue
        for length, i, t in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if length == longest and free[0][i : i + length].all() and free[1][t : t + length].all():
                free[0][i : i + length] = free[1][t : t + length] = False
                tiles.append((length, i, t))
        if not found:
            if size == least:
                return tiles
            size = max(size // 2, least)


@F.arrow_udf(TILING)
def tile(items: pa.Array, runs: pa.Array) -> pa.Array:
    rows = []
    for k in range(len(items)):
        item = np.array(items[k].values, dtype=np.int64).view(np.uint64)
        parts = [np.array(r.values, dtype=np.int64).view(np.uint64) for r in runs[k].values]
        gap = np.zeros(1, dtype=np.uint64)  # between runs; no token has this hash but by a chance of 2 ** -64
        tiles = greedy_tiles(item, np.concatenate([x for p in parts for x in (p, gap)]))
        lengths = [t[0] for t in tiles]
        rows.append({"covered": sum(lengths), "tiles": len(lengths), "longest": max(lengths, default=0)})
    return pa.array(rows, pa.struct([(f, pa.int64()) for f in TILING.names]))


def indexed_seeds(items: DataFrame, coverage: float) -> DataFrame:
    """Seeds to look items up by: (`seed`, `item`).

    Tiles that cover a share `coverage` of an item hold at least a `SEED`-th of that many of its seed
    places, so the most common seeds of each item, one fewer than that, need no index entry. This
    keeps phrases that many items share from pairing them all with every document.
    """
    places = items.select("item", F.size("tokens").alias("length"), F.posexplode("seeds").alias("place", "seed"))
    times = materialise(places.groupBy("seed").agg(F.count("*").alias("times")), "seed-counts")
    ranked = places.join(times, "seed").withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(F.desc("times"), "seed", "place")))
    needed = F.ceil(F.col("length") * F.lit(coverage) / SEED)
    return ranked.where(F.col("rank") >= needed).select("seed", "item").distinct()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per contaminated document row and benchmark row that it covers to `coverage` or more:
    `doc_id`, `text_hash`, `item_id`, `item_tokens`, `covered`, `tiles`, `longest`, `coverage`.

    Null and empty texts, and items of fewer than `SEED` tokens, match nothing. Null ids and repeated
    rows on either side are rows like others. An empty table on either side gives no rows. Documents
    are read once and only their seeded stretches go on; seeds are salted, so a passage in a third of
    all documents spreads over the tasks.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item_id"), item_tokens(F.col(item_text_col)).alias("t"))
    items = materialise(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "t.*").where(F.size("seeds") > 0), "items")
    seeds = materialise(indexed_seeds(items, coverage), "item-seeds")
    table = spark.sparkContext.broadcast(seed_filter(items.select(F.explode("seeds").alias("seed"))))
    hits = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), seeded_runs(table)(F.col(text_col)).alias("h"))
    hits = hits.where(F.size("h.seeds") > 0).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash", "h.*")
    hits = materialise(hits, "seeded")
    salted = seeds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = hits.select("row", F.explode("seeds").alias("seed")).withColumn("salt", F.pmod(F.hash("row"), F.lit(SALTS)))
    pairs = materialise(own.join(salted, ["seed", "salt"]).select("row", "item").distinct(), "seed-pairs")
    both = pairs.join(hits.drop("seeds"), "row").join(items.drop("seeds"), "item")
    tiled = both.select("doc_id", "text_hash", "item_id", F.size("tokens").cast("long").alias("item_tokens"), tile("tokens", "runs").alias("t"))
    share: Column = F.col("covered") / F.col("item_tokens")
    return tiled.select("doc_id", "text_hash", "item_id", "item_tokens", "t.*").withColumn("coverage", share).where(F.col("coverage") >= coverage)
