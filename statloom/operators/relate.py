"""Joins, unions and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.operators.ranks import col


def left_join(left: DataFrame, right: DataFrame, key: str, nullable: bool = False) -> DataFrame:
    """Left equi-join with the key once in the output. With `nullable`, null keys match null keys.

    The strategy is left to the adaptive optimizer, which broadcasts a side of a measured small
    size and splits skewed partitions of a sort-merge join.
    """
    if not nullable:
        return left.join(right, key, "left")
    other = right.withColumnRenamed(key, "__key")
    return left.join(other, col(key).eqNullSafe(F.col("__key")), "left").drop("__key")


def keyed_update(left: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Overwrite cells of `left` with the non-null cells of `other` that have the same key. Keys
    found only in `other` are ignored, and so are its columns that `left` lacks."""
    shared = [c for c in other.columns if c != key and c in left.columns]
    renamed = other.select(col(key), *[col(c).alias(f"__new_{c}") for c in shared])
    return left.join(renamed, key, "left").select(
        *[F.coalesce(col(f"__new_{c}"), col(c)).alias(c) if c in shared else col(c) for c in left.columns]
    )


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both tables, columns matched by name, missing ones null."""
    return a.unionByName(b, allowMissingColumns=True)


MOST_NAMES = 1000


def column_names(df: DataFrame, columns: str, most: int = MOST_NAMES) -> list[str]:
    """The names that a pivot makes columns of, in the order of the values; more than `most` raise."""
    found = df.select(col(columns)).where(col(columns).isNotNull()).distinct().orderBy(col(columns)).take(most + 1)
    if len(found) > most:
        raise ValueError(f"more than {most} values in {columns} to make columns of")
    return [r[0] for r in found]


def pivot(
    df: DataFrame, index: str, columns: str, values: str, names: Sequence | None = None, fill=None, most: int = MOST_NAMES
) -> DataFrame:
    """Long to wide. Without `names` the columns are the values that `columns` holds, found first and
    `most` at most, so that no value gets lost. Given names spare that job and choose columns.

    Cells meet in a map per index, in one aggregation whatever the number of columns; cells that
    meet in one place give their largest value, and null names have no column."""
    chosen = column_names(df, columns, most) if names is None else list(names)
    cells = df.groupBy(col(index), col(columns).alias("__name")).agg(F.max(col(values)).alias("__value"))
    if names is not None:
        cells = cells.withColumn("__name", F.when(F.col("__name").isin(*chosen), F.col("__name")))
    entry = F.when(F.col("__name").isNotNull(), F.struct("__name", "__value"))
    wide = cells.groupBy(col(index)).agg(F.map_from_entries(F.collect_list(entry)).alias("__cells"))
    cell = lambda n: F.element_at("__cells", F.lit(n))
    return wide.select(col(index), *[(cell(n) if fill is None else F.coalesce(cell(n), F.lit(fill))).alias(str(n)) for n in chosen])


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Wide to long: (ids..., column, value)."""
    return df.unpivot([col(c) for c in ids], [col(c) for c in cols], "column", "value")
