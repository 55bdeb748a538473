"""Code fences and block quotes of Markdown texts, and what they exclude."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.spans import covered, merged

# A fence line (ticks, language) and a quoted line.
FENCE = re.compile(r"^(`{3,})(\w*)\s*$", re.MULTILINE)
QUOTE = re.compile(r"^\s*>.*$", re.MULTILINE)


def fences_of(text: str) -> list[tuple[int, int, str | None]]:
    """Start, end and language: an opener is closed by the next line of as many ticks without a language, else by the text's end."""
    lines = [(m.start(), m.end(), len(m.group(1)), m.group(2) or None) for m in FENCE.finditer(text)]
    out, at = [], 0
    while at < len(lines):
        start, _, ticks, language = lines[at]
        closer = next((k for k in range(at + 1, len(lines)) if lines[k][2] >= ticks and lines[k][3] is None), None)
        if closer is None:
            return [*out, (start, len(text), language)]
        out.append((start, lines[closer][1], language))
        at = closer + 1
    return out


def with_exclusions(messages: DataFrame, quotes: bool = False) -> DataFrame:
    """messages with fences, blockquotes and excluded: the union of fences and, if asked for, quotes."""

    @F.pandas_udf("array<struct<start:int,end:int,language:string>>")
    def fences(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [dict(start=a, end=b, language=x) for a, b, x in fences_of(t or "")])

    @F.pandas_udf("array<struct<start:int,end:int>>")
    def quoted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [dict(start=m.start(), end=m.end()) for m in QUOTE.finditer(t or "")])

    none = F.array().cast("array<struct<start:int,end:int,language:string>>")
    rows = messages.withColumn("fences", F.when(F.col("text").contains("```"), fences("text")).otherwise(none))
    rows = rows.withColumn("blockquotes", F.when(F.col("text").contains(">"), quoted("text")).otherwise(F.array().cast("array<struct<start:int,end:int>>")))
    spans = F.transform("fences", lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end")))
    return rows.withColumn("excluded", merged(F.concat(spans, "blockquotes") if quotes else spans))


def long_enough(messages: DataFrame, min_chars: int = 10) -> DataFrame:
    """Messages with so many characters outside what is excluded."""
    return messages.where(F.length("text") - covered(F.col("excluded")) >= min_chars)
