"""Spans of pattern matches in whole texts, with built-in functions only.

Offsets count code points, ends are exclusive, matches are leftmost and do not overlap within a
kind. Patterns must never match the empty string; they are run by Java, so loops over groups have to
be possessive to keep the stack flat on long texts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEFT, RIGHT = 48, 24
BLOCK = 64
NONE = "cast(array() as array<struct<start:bigint,end:bigint,hit:string,left:string,right:string>>)"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def numbers(count: Column) -> Column:
    """0, 1, ... count - 1."""
    return F.when(count > 0, F.sequence(F.lit(0), count.cast("int") - 1)).otherwise(F.expr("cast(array() as array<int>)"))


def blocks(items: Column) -> Column:
    return numbers(F.ceil(F.size(items) / BLOCK))


def part(items: Column, block: Column, ahead: int = 0) -> Column:
    return F.slice(items, block * BLOCK + 1 + ahead, F.lit(BLOCK))


def located(pieces: Column, hits: Column) -> Column:
    """Spans from the pieces between matches and the matches, by a running sum of their lengths.

    An array that grows by an entry is copied. So the sum runs over blocks of matches first, and then
    within each block: the work is matches times the size of a block, however many a text has.
    """
    before = F.char_length(F.element_at(pieces, 1)).cast("long")

    def length(block: Column) -> Column:
        sizes = F.zip_with(part(hits, block), part(pieces, block, 1), lambda h, after: F.char_length(h) + F.char_length(after))
        return F.aggregate(sizes, F.lit(0).cast("long"), lambda total, n: total + n)

    begins = F.aggregate(blocks(hits), F.array(before), lambda at, block: F.array_append(at, F.element_at(at, -1) + length(block)))

    def step(state: Column, x: Column) -> Column:
        end = state["at"] + F.char_length(x["h"])
        span = F.struct(
            state["at"].alias("start"),
            end.alias("end"),
            x["h"].alias("hit"),
            F.substring(state["before"], -LEFT, LEFT).alias("left"),
            F.substring(x["after"], 1, RIGHT).alias("right"),
        )
        return F.struct((end + F.char_length(x["after"])).alias("at"), x["after"].alias("before"), F.array_append(state["out"], span).alias("out"))

    def within(block: Column, begin: Column) -> Column:
        between = F.zip_with(part(hits, block), part(pieces, block, 1), lambda h, after: F.struct(h.alias("h"), after.alias("after")))
        start = F.struct(begin.alias("at"), F.element_at(pieces, block * BLOCK + 1).alias("before"), F.expr(NONE).alias("out"))
        return F.aggregate(between, start, step, lambda state: state["out"])

    return bound(begins, lambda at: F.flatten(F.transform(blocks(hits), lambda block: within(block, F.get(at, block)))))


def with_matches(rows: DataFrame, text: str, patterns: Mapping[str, str], wanted: Callable[[str], Column] | None = None) -> DataFrame:
    """Add a column of spans per pattern. `wanted` tells for a kind whether to look at a row at all."""
    for kind, pattern in patterns.items():
        pieces = F.split(F.col(text), pattern, -1)
        if wanted:
            pieces = F.when(wanted(kind), pieces).otherwise(F.array(F.lit("")))
        rows = rows.withColumn(f"{kind}_pieces", pieces)
        found = F.size(f"{kind}_pieces") > 1
        rows = rows.withColumn(f"{kind}_hits", F.when(found, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))))
        spans = located(F.col(f"{kind}_pieces"), F.col(f"{kind}_hits"))
        rows = rows.withColumn(kind, F.when(found, spans).otherwise(F.expr(NONE))).drop(f"{kind}_pieces", f"{kind}_hits")
    return rows


def tagged(kind: str, spans: Column) -> Column:
    """Spans without their texts, as (kind, start, end)."""
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def joined(spans: Column, kinds: Sequence[str], by_start: bool) -> Column:
    """`kind:start:end` joined by commas, sorted by start and kind or the other way round."""
    rank = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])

    def entry(s: Column) -> Column:
        order = [s["start"].alias("a"), rank[s["kind"]].cast("long").alias("b")]
        text = F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.struct(*(order if by_start else order[::-1]), s["end"].alias("c"), text.alias("text"))

    return F.array_join(F.transform(F.array_sort(F.transform(spans, entry)), lambda s: s["text"]), ",")
