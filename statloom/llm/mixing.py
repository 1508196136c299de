"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same real number of copies, target over source size. Its whole
part is taken as it is; the fractions are rounded by exchanges of words between two partners, at
random until one is whole, so a source's total stays at its target. Blocks of a source leave one
open document each; a tree of further rounds, `FAN` blocks to one, closes those.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.llm.text import mix as spread
from statloom.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3.0
BLOCK_ROWS = 128
FAN = 64
BROADCAST_SOURCES = 10_000
SALTS = 64
OWN = ["mix_source", "size", "source_size", "target", "block", "draw", "copies", "share", "open"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """One row per source: rows, size and target. `rows` has `mix_source` and `size`.

    Targets are weight times a common level, cut at `MOST_COPIES` times the size; the level is such
    that they sum to the total. One row per source is left after the grouping, and the windows run
    over those only.
    """
    sources = rows.groupBy("mix_source").agg(F.count("*").alias("source_rows"), F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("mix_source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn(
        "weight", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ).withColumn("most", F.lit(MOST_COPIES) * F.col("source_size"))
    whole, by_level = W.partitionBy(), W.orderBy(F.col("most") / F.col("weight"), F.col("mix_source").asc_nulls_last())
    here = by_level.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(here), F.lit(0.0))
    heavy = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(here), F.lit(0.0))
    levelled = weighed.withColumn("level_here", left / heavy)
    reached = F.when(F.col("level_here") <= F.col("most") / F.col("weight"), F.col("level_here"))
    level = F.coalesce(F.first(reached, ignorenulls=True).over(by_level.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), F.lit(0.0))
    return levelled.withColumn("target", F.least("most", level * F.col("weight"))).select(
        "mix_source", "source_rows", "source_size", "target"
    )


def with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join the few sources to all rows: broadcast up to `BROADCAST_SOURCES` rows, salted beyond."""
    if sources.count() <= BROADCAST_SOURCES:
        small = F.broadcast(sources.withColumnRenamed("mix_source", "of_source"))
        return rows.join(small, F.col("mix_source").eqNullSafe(F.col("of_source"))).drop("of_source")
    salted = sources.withColumnRenamed("mix_source", "of_source").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = F.col("mix_source").eqNullSafe(F.col("of_source")) & (F.pmod("draw", F.lit(SALTS)).cast("int") == F.col("salt"))
    return rows.join(salted, same).drop("of_source", "salt")


def uniform(a: int, b: int) -> float:
    """A number in [0, 1) fixed by two hashes."""
    x = spread(np.array([a & 0xFFFFFFFFFFFFFFFF], np.uint64) ^ spread(np.array([b & 0xFFFFFFFFFFFFFFFF], np.uint64)))
    return int(x[0] >> np.uint64(11)) / (1 << 53)


def pivot(shares: np.ndarray, sizes: np.ndarray, draws: list[int], last: bool) -> tuple[np.ndarray, int]:
    """Round shares, given in falling order of size; the sum of share times size stays.

    The largest open document is paired with the other open ones, whose shares rise or fall alike.
    Words go one way or the other at random, expected shares staying as they are, until a document
    is whole. So what stays open at the end is small. Returns the shares and the place of the one
    still open, or -1; `last` rounds that one by a draw.
    """
    for j in np.flatnonzero(sizes == 0):
        shares[j] = float(uniform(draws[j], 1) < shares[j])
    while True:
        opened = np.flatnonzero((shares > 0) & (shares < 1))
        if len(opened) < 2:
            break
        i, rest = opened[0], opened[1:]
        pool = sizes[rest].sum()
        highest, lowest = shares[rest].max(), shares[rest].min()
        lose = min(shares[i] * sizes[i], pool * (1 - highest))
        gain = min((1 - shares[i]) * sizes[i], pool * lowest)
        if uniform(draws[i], draws[rest[0]] + len(rest)) * (lose + gain) < gain:
            whole = shares[i] * sizes[i] <= lose
            shares[rest] = shares[rest] + lose / pool if whole else np.where(shares[rest] == highest, 1.0, shares[rest] + lose / pool)
            shares[i] = 0.0 if whole else shares[i] - lose / sizes[i]
        else:
            whole = (1 - shares[i]) * sizes[i] <= gain
            shares[rest] = shares[rest] - gain / pool if whole else np.where(shares[rest] == lowest, 0.0, shares[rest] - gain / pool)
            shares[i] = 1.0 if whole else shares[i] + gain / sizes[i]
        np.clip(shares, 0.0, 1.0, out=shares)
    held = int(opened[0]) if len(opened) else -1
    if held >= 0 and last:
        shares[held] = float(uniform(draws[held], 2) < shares[held])
        held = -1
    return shares, held


def round_block(last: bool):
    def one(block: pa.Table) -> pa.Table:
        size, draw = (block[c].to_numpy(zero_copy_only=False) for c in ("size", "draw"))
        order = np.lexsort([draw, -size])
        block = block.take(order)
        shares = block["share"].to_numpy(zero_copy_only=False).copy()
        shares, held = pivot(shares, size[order].astype(float), draw[order].tolist(), last)
        opened = [k == held for k in range(len(shares))]
        for name, values in (("share", pa.array(shares, pa.float64())), ("open", pa.array(opened, pa.bool_()))):
            block = block.set_column(block.schema.get_field_index(name), name, values)
        return block

    return one


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    carry: Sequence[str] = (),
    seed: int = 0,
) -> DataFrame:
    """One row per input row: `doc_id`, `source`, `size`, `source_size`, `target`, `copies` and `taken`.

    Columns named in `carry` come along as fields of a struct `carried`, so no name can clash. Null and
    empty texts have size 0 and take no words; a null source is a source, last in order; null ids and
    repeated rows are rows like others. An empty table gives an empty result. Draws come from hashes of
    id, source, size and `seed`, so reruns agree. Hot sources are cut into blocks of about
    `BLOCK_ROWS` rows before they are grouped.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("mix_source"),
        word_count(F.col(text_col)).alias("size"),
        F.struct(*[F.col(c) for c in carry] or [F.lit(0).alias("none")]).alias("carried"),
    ).withColumn("draw", F.xxhash64("doc_id", "mix_source", "size", F.lit(seed)))
    if not carry:
        rows = materialise(rows.drop("carried"), "mix-sizes")
    sources = materialise(source_targets(rows, weights), "mix-sources")
    copies = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0).cast("long")), F.lit(0.0))
    blocks = F.ceil(F.col("source_rows") / BLOCK_ROWS)
    started = (
        with_sources(rows, sources)
        .withColumn("block", F.pmod(F.xxhash64("draw", F.lit(seed + 1)), blocks))
        .withColumn("copies", F.floor(copies))
        .withColumn("share", copies - F.floor(copies))
        .withColumn("open", F.lit(False))
        .drop("source_rows")
    )
    most = (sources.agg(F.max("source_rows")).first()[0] or 0) / BLOCK_ROWS
    level = rounds(started, "block", most <= 1)
    level = materialise(level, "mix-0")
    closed, opened = level.where(~F.col("open")), level.where("open")
    if most > 1:
        closed = closed.unionByName(settle(opened, most))
    return closed.select(
        "doc_id",
        F.col("mix_source").alias("source"),
        "size",
        "source_size",
        "target",
        (F.col("copies") + F.col("share").cast("long")).alias("copies"),
        ((F.col("copies") + F.col("share").cast("long")) * F.col("size")).alias("taken"),
        *(["carried"] if carry else []),
    )


def rounds(rows: DataFrame, key: str, last: bool) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    return rows.groupBy("mix_source", key).applyInArrow(round_block(last), schema)


def settle(opened: DataFrame, most: float) -> DataFrame:
    """Close the open row of each block in a tree of rounds; the rows return with whole shares."""
    layer = opened.select("mix_source", "block", "size", "draw", "share", "open").withColumn("parent", F.col("block"))
    done = None
    while True:
        most = most / FAN
        layer = layer.withColumn("parent", F.floor(F.col("parent") / FAN))
        layer = materialise(rounds(layer, "parent", most <= 1), "mix-tree")
        shut = layer.where(~F.col("open"))
        done = shut if done is None else done.unionByName(shut)
        if most <= 1:
            break
        layer = layer.where("open")
    decided = done.select(F.col("mix_source").alias("of_source"), F.col("block").alias("of_block"), F.col("share").alias("settled"))
    same = F.col("mix_source").eqNullSafe(F.col("of_source")) & (F.col("block") == F.col("of_block"))
    return opened.join(decided, same).withColumn("share", F.col("settled")).drop("of_source", "of_block", "settled")
