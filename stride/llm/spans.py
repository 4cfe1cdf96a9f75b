"""Positions of regular-expression matches as DataFrame columns (no Python on the executors).

``split`` and ``regexp_extract_all`` walk a text with the same matcher, so the
gaps between the matches and the matches themselves add up to the text and
their lengths give every position, in code points.  A text without a match is
scanned once and never split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "array<struct<start:bigint,end:bigint,match:string,left:string>>"


BLOCK = 128


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once per row, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def regex_spans(text: Column, pattern: str, left_chars: int = 0) -> Column:
    """array<struct<start, end, match, left>>; left is the end of the gap before the match.

    Starts are prefix sums over blocks of lengths, so many matches cost little more than few.
    """

    def pieces(matches):
        gaps = F.slice(F.split(text, pattern), 1, F.size(matches))
        return F.zip_with(gaps, matches, lambda g, m: F.struct(
            F.length(g).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("size"), m.alias("match"),
            (F.right(g, F.lit(left_chars)) if left_chars else F.lit("")).alias("left")))

    def located(pairs):
        return let(F.transform(pairs, lambda p: p["gap"] + p["size"]), lambda sizes: let(before_blocks(sizes), lambda before: F.transform(
            pairs, lambda p, i: span(p, before, sizes, i))))

    def before_blocks(sizes):
        block = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int"))
        sums = F.transform(block, lambda k: _sum(F.slice(sizes, k * BLOCK + 1, BLOCK)))
        return F.aggregate(sums, F.array(F.lit(0).cast("bigint")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def span(p, before, sizes, i):
        k = F.floor(i / BLOCK).cast("int")
        at = F.get(before, k) + _sum(F.slice(sizes, k * BLOCK + 1, i - k * BLOCK)) + p["gap"]
        return let(at, lambda start: F.struct(
            start.alias("start"), (start + p["size"]).alias("end"), p["match"].alias("match"), p["left"].alias("left")))

    none = F.array().cast(EMPTY)
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda matches: F.when(F.size(matches) > 0, let(pieces(matches), located)).otherwise(none))


def labelled(spans: Column, kind: str, order: int) -> Column:
    """array<struct<order, start, end, kind>>"""
    return F.transform(spans, lambda s: F.struct(
        F.lit(order).alias("order"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


SPANS = "array<struct<order:int,start:bigint,end:bigint,kind:string>>"


def joined(spans: Column, by_start: bool) -> Column:
    """``kind:start:end`` comma-joined; ordered by start and kind, or by kind and start."""
    first, second = ("start", "order") if by_start else ("order", "start")
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(
        s[first].cast("bigint").alias("a"), s[second].cast("bigint").alias("b"), s["end"].alias("c"),
        s["start"].alias("start"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["c"].cast("string"))), ",")
