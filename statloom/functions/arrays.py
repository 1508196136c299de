"""Array and map expressions with list, set and dictionary semantics (positions count from 0)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def append(a: Column, x: Column) -> Column:
    return F.array_append(a, x)


def extend(a: Column, b: Column) -> Column:
    return F.concat(a, b)


def insert(a: Column, position: int, x: Column) -> Column:
    """Insert before `position`; a position past the end appends."""
    return F.concat(
        F.slice(a, 1, F.lit(position)), F.array(x), F.slice(a, F.lit(position + 1), F.size(a))
    )


def count_of(a: Column, x: Column) -> Column:
    return F.size(F.filter(a, lambda e: e == x)).cast("bigint")


def sort_as_text(a: Column) -> Column:
    return F.array_sort(F.transform(a, lambda e: e.cast("string")))


def reverse(a: Column) -> Column:
    return F.reverse(a)


def index_of(a: Column, x: Column) -> Column:
    """Position of the first hit, null when there is none."""
    found = F.array_position(a, x)
    return F.when(found > 0, found - 1)


def remove_first(a: Column, x: Column) -> Column:
    first = F.array_position(a, x).cast("int") - 1
    return F.filter(a, lambda e, i: i != first)


def pop_last(a: Column) -> Column:
    return F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))


def last_element(a: Column) -> Column:
    return F.try_element_at(a, F.lit(-1))


def clear(a: Column) -> Column:
    return F.filter(a, lambda e: F.lit(False))


def unique_sorted(a: Column) -> Column:
    return F.array_sort(F.array_distinct(a))


def map_put(m: Column, key: str, value: Column) -> Column:
    """Set one key, replacing an earlier value."""
    return F.map_concat(F.map_filter(m, lambda k, v: k != key), F.create_map(F.lit(key), value))


def reshape(a: Column, n_rows: int, n_cols: int) -> Column:
    """Row-major reshape to an array of rows."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(n_rows - 1)), lambda i: F.slice(a, i * n_cols + 1, F.lit(n_cols))
    )


def element_columns(a: Column, names: list[str]) -> list[Column]:
    """One column per array position."""
    return [F.get(a, i).alias(name) for i, name in enumerate(names)]
