"""Spans of regular expressions as columns, with code point offsets, in Spark SQL functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,match:string>>"


def empty_spans() -> Column:
    return F.array().cast(SPAN)


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` in ``text``: array of (start, end, match), end exclusive.

    The pieces between matches come from ``split`` and the matches from
    ``regexp_extract_all``; their lengths, added up from the left, are the
    offsets. Patterns must not match the empty string. Null text gives null.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda gap, m: F.struct(
        F.length(gap).alias("gap"), F.length(m).alias("length"), m.alias("match")))
    zero = F.struct(F.lit(0).alias("at"), empty_spans().alias("found"))
    added = F.aggregate(
        lengths, zero,
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["length"]).alias("at"),
            F.concat(acc["found"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["length"]).alias("end"),
                x["match"].alias("match")))).alias("found")),
        lambda acc: acc["found"])
    return F.when(F.regexp_like(text, F.lit(pattern)), added).otherwise(empty_spans())


def kept(found: Column, keep: Callable[[Column], Column]) -> Column:
    """Spans whose match satisfies ``keep``."""
    return F.filter(found, lambda s: keep(s["match"]))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    figures = F.reverse(F.split(number, ""))
    doubled = F.transform(figures, lambda c, i: F.when(
        i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def labelled(kinds: Sequence[tuple[str, Column]], by_start: bool) -> Column:
    """All spans of ``kinds`` as ``kind:start:end``, by start then kind, or by kind then start, comma-joined."""
    def parts(no: int, kind: str, found: Column) -> Column:
        return F.transform(found, lambda s: F.struct(
            (s["start"] if by_start else F.lit(no)).alias("first"), (F.lit(no) if by_start else s["start"]).alias("second"),
            F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("label")))

    every = F.concat(*[parts(no, kind, found) for no, (kind, found) in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(every), lambda s: s["label"]), ",")
