"""Half-open code-point spans and sets of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlaps(start: Column, end: Column, ranges: Column) -> Column:
    """Whether [start, end) meets any of the ranges (structs of start and end); null ranges count as none."""
    return F.coalesce(F.exists(ranges, lambda r: (start < r["end"]) & (r["start"] < end)), F.lit(False))


def merged(ranges: Column) -> Column:
    """The union of ranges: sorted, those that touch or overlap joined."""
    kind = "array<struct<start:int,end:int>>"

    def add(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (r["start"] <= F.try_element_at(done, F.lit(-1))["end"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(F.array_sort(ranges), F.array().cast(kind), lambda done, r: F.when(F.size(done) == 0, F.array(r)).otherwise(add(done, r)).cast(kind))


def covered(ranges: Column) -> Column:
    """Code points within merged ranges."""
    return F.aggregate(ranges, F.lit(0), lambda n, r: n + r["end"] - r["start"])


def parsed(value: Column) -> Column:
    """Ranges from JSON ([{"char_start": 1, "char_end": 4}, ...]); none where it is missing, broken or lacks a bound."""
    read = F.from_json(value, "array<struct<char_start:int,char_end:int>>")
    ranges = F.transform(read, lambda r: F.struct(r["char_start"].alias("start"), r["char_end"].alias("end")))
    whole = F.forall(ranges, lambda r: r["start"].isNotNull() & r["end"].isNotNull())
    return F.when(F.coalesce(whole, F.lit(False)), ranges).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def quote_span(quote: Column, text: Column) -> Column:
    """Start and end of a quote that a text holds exactly once, else null."""
    first = F.call_function("locate", quote, text, F.lit(1))
    again = F.call_function("locate", quote, text, first + 1)
    once = (F.length(quote) > 0) & (first > 0) & (again == 0)
    return F.when(once, F.struct((first - 1).alias("start"), (first - 1 + F.length(quote)).alias("end")))
