"""Time mentions: patterns, overlap resolution and resolution against an anchor."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.ids import surface_hash
from factloom.functions.spans import overlaps
from factloom.functions.times import last_ms

_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_UNITS = "days?|weeks?|months?|years?"
# Pattern, precedence, confidence and regular expression.
PATTERNS = [
    ("ISO_DATETIME", 10, 0.95, re.compile(r"\b(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2})?(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?)\b")),
    ("ISO_DATE", 20, 0.90, re.compile(r"\b(\d{4}-\d{2}-\d{2})\b")),
    ("WRITTEN_DATE", 30, 0.90, re.compile(rf"\b(?:(?:{_MONTHS})\s+\d{{1,2}},?\s+\d{{4}}|\d{{1,2}}\s+(?:{_MONTHS})\s+\d{{4}})\b", re.IGNORECASE)),
    ("MONTH_YEAR", 40, 0.85, re.compile(rf"\b(?:{_MONTHS})\s+\d{{4}}\b", re.IGNORECASE)),
    ("YEAR_ONLY", 50, 0.60, re.compile(r"\b(?:19\d{2}|20[0-4]\d|2050)\b")),
    ("RELATIVE_DAY", 60, 0.85, re.compile(r"\b(?:yesterday|today|tomorrow)\b", re.IGNORECASE)),
    ("RELATIVE_PERIOD", 70, 0.80, re.compile(r"\b(?:last|next)\s+(?:week|month|year)\b", re.IGNORECASE)),
    ("RELATIVE_AGO", 80, 0.80, re.compile(rf"\b\d+\s+(?:{_UNITS})\s+ago\b", re.IGNORECASE)),
    ("RELATIVE_IN", 80, 0.75, re.compile(rf"\bin\s+\d+\s+(?:{_UNITS})\b", re.IGNORECASE)),
    ("DAY_OF_WEEK", 90, 0.60, re.compile(r"\b(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)\b", re.IGNORECASE)),
]
RELATIVE = ["RELATIVE_DAY", "RELATIVE_PERIOD", "RELATIVE_AGO", "RELATIVE_IN", "DAY_OF_WEEK"]
HINT = r"(?i)\d{4}|day|last\s|next\s|ago|\bin\s+\d|tomorrow"


def candidates(messages: DataFrame) -> DataFrame:
    """message_id, pattern, precedence, start, end, surface, confidence and the anchor columns of all matches outside ``excluded``."""

    @F.pandas_udf("array<struct<pattern:string,precedence:int,confidence:double,start:int,end:int,surface:string>>")
    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [dict(pattern=n, precedence=p, confidence=c, start=m.start(), end=m.end(), surface=m.group(0)) for n, p, c, x in PATTERNS for m in x.finditer(t)])

    rows = messages.where(F.col("text").isNotNull() & F.col("text").rlike(HINT))
    quality = F.col("timestamp_quality") if "timestamp_quality" in rows.columns else F.when(F.col("created_at").isNotNull(), "original").otherwise("imputed_prior")
    excluded = F.col("excluded") if "excluded" in rows.columns else F.lit(None).cast("array<struct<start:int,end:int>>")
    found = rows.select("message_id", F.col("created_at").alias("anchor"), quality.alias("quality"), excluded.alias("excluded"), F.explode(scan("text")).alias("c")).select("message_id", "anchor", "quality", "excluded", "c.*")
    return found.where(~overlaps(F.col("start"), F.col("end"), F.col("excluded"))).drop("excluded")


def resolved_overlaps(found: DataFrame) -> DataFrame:
    """Candidates that stay: greedy by length, precedence, start, end and surface hash in each message."""
    ranked = F.struct((F.col("start") - F.col("end")).alias("l"), F.col("precedence"), F.col("start"), (-F.col("end")).alias("e"), surface_hash(F.col("surface")).alias("h"), F.col("end"), F.col("pattern"), F.col("confidence"), F.col("surface"), F.col("anchor"), F.col("quality"))
    per = found.groupBy("message_id").agg(F.array_sort(F.collect_list(ranked)).alias("all"))
    kept = F.aggregate("all", F.slice("all", 1, 0), lambda done, c: F.when(F.exists(done, lambda w: (c["start"] < w["end"]) & (w["start"] < c["end"])), done).otherwise(F.concat(done, F.array(c))))
    return per.select("message_id", F.explode(kept).alias("c")).select("message_id", "c.pattern", "c.precedence", F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.col("c.surface").alias("surface"), F.col("c.confidence").alias("confidence"), F.col("c.anchor").alias("anchor"), F.col("c.quality").alias("quality"))


def resolve(kept: DataFrame) -> DataFrame:
    """Candidates with resolved_type (instant, interval or unresolved), valid_from, valid_to, granularity and confidence.

    Relative patterns need an anchor of original quality. Intervals end at their
    last millisecond; a bare year's at the last whole second.
    """
    low, anchor = F.lower(F.col("surface")), F.col("anchor")
    p = F.col("pattern")
    day = F.date_trunc("day", anchor)
    unit = F.regexp_extract(low, r"(day|week|month|year)", 1)
    n = F.regexp_extract(low, r"(\d+)", 1).try_cast("int")
    sign = F.when((p == "RELATIVE_AGO") | low.startswith("last"), -1).otherwise(1)

    def moved(base, count):
        return F.when(unit == "day", base + F.make_interval(days=count)).when(unit == "week", base + F.make_interval(weeks=count)).when(unit == "month", base + F.make_interval(months=count)).otherwise(base + F.make_interval(years=count))

    shift = moved(anchor, sign)
    period = F.when(unit == "week", F.date_trunc("week", shift)).when(unit == "month", F.date_trunc("month", shift)).otherwise(F.date_trunc("year", shift))
    names = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    weekday = F.array_position(F.array(*[F.lit(x) for x in names]), low) - 1
    back = F.pmod(F.weekday(anchor) - weekday, F.lit(7)).cast("int")
    back = F.when(back == 0, 7).otherwise(back)
    written = F.coalesce(*[F.try_to_timestamp(F.regexp_replace(F.initcap(F.replace(F.col("surface"), F.lit(","), F.lit(" "))), r"\s+", " "), F.lit(f)) for f in ("MMMM d yyyy", "d MMMM yyyy")])
    start = (
        F.when(p == "ISO_DATETIME", F.try_to_timestamp("surface"))
        .when(p == "ISO_DATE", F.try_to_timestamp("surface", F.lit("yyyy-MM-dd")))
        .when(p == "WRITTEN_DATE", written)
        .when(p == "MONTH_YEAR", F.try_to_timestamp(F.regexp_replace(F.initcap("surface"), r"\s+", " "), F.lit("MMMM yyyy")))
        .when(p == "YEAR_ONLY", F.try_to_timestamp("surface", F.lit("yyyy")))
        .when(p == "RELATIVE_DAY", day + F.make_interval(days=F.when(low == "yesterday", -1).when(low == "tomorrow", 1).otherwise(0)))
        .when(p == "RELATIVE_PERIOD", period)
        .when(p.isin("RELATIVE_AGO", "RELATIVE_IN"), F.date_trunc("day", moved(anchor, sign * n)))
        .when(p == "DAY_OF_WEEK", day - F.make_interval(days=back))
    )
    span = F.when(p == "MONTH_YEAR", "month").when(p == "YEAR_ONLY", "year").when((p == "RELATIVE_PERIOD") & (unit != "day"), unit).otherwise("day")
    end = F.when(span == "month", last_ms("month", F.col("from"))).when((span == "year") & (p == "YEAR_ONLY"), last_ms("year", F.col("from")) - F.expr("interval 999 millisecond")).when(span == "year", last_ms("year", F.col("from"))).when(span == "week", last_ms("week", F.col("from"))).otherwise(last_ms("day", F.col("from")))
    blocked = p.isin(*RELATIVE) & (anchor.isNull() | (F.col("quality") != "original"))
    rows = kept.withColumn("from", F.when(~blocked, start)).withColumn("span", span)
    kind = F.when(F.col("from").isNull(), "unresolved").when(p == "ISO_DATETIME", "instant").otherwise("interval")
    grain = F.when(p == "ISO_DATETIME", "second").when(p == "RELATIVE_PERIOD", F.when(unit == "week", "day").otherwise(unit)).when(p.isin("RELATIVE_AGO", "RELATIVE_IN"), F.when(unit == "week", "day").otherwise(unit)).otherwise(F.col("span"))
    return rows.select("message_id", "pattern", "precedence", "start", "end", "surface", kind.alias("resolved_type"), F.col("from").alias("valid_from"), F.when(kind == "interval", end).alias("valid_to"), F.when(kind != "unresolved", grain).alias("granularity"), F.when(kind == "unresolved", 0.0).otherwise(F.col("confidence")).alias("confidence"))


def time_mentions(messages: DataFrame) -> DataFrame:
    """Candidates, overlaps and resolution in one."""
    return resolve(resolved_overlaps(candidates(messages)))
