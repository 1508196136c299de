"""Projections and conditional edits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.operators import ranks
from statloom.operators.ranks import col


def select(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in cols])


def drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names the table does not have are ignored."""
    return df.drop(*cols)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def cast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient casts: a value that does not fit becomes null."""
    return df.withColumns({c: col(c).try_cast(t) for c, t in types.items()})


def keep_members(df: DataFrame, name: str, members: Sequence) -> DataFrame:
    """Membership filter; null is no member."""
    return df.where(col(name).isin(list(members)))


def overwrite_where(df: DataFrame, condition: Column, name: str, value) -> DataFrame:
    """Replace the value where the condition holds; null conditions leave it."""
    return df.withColumn(name, F.when(condition, F.lit(value)).otherwise(col(name)))


def negatives_to_median(df: DataFrame, cols: Sequence[str], now: bool = False) -> DataFrame:
    """Replace negatives by the column median, which is taken with the negatives included."""
    med, row = F.col("__med"), ranks.quantile_row(df, cols, {"median": 0.5})
    return (
        ranks.attach(df, ranks.fixed(row) if now else row, "__med")
        .withColumns({c: F.when(col(c) < 0, med[c]["median"]).otherwise(col(c)) for c in cols})
        .drop("__med")
    )


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(cols) if cols else None)
