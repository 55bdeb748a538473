"""Entity mentions: detectors, suppression and overlap resolution.

One Arrow function finds all matches with their code-point offsets (Spark has no
function for that); suppression and the greedy choice among overlapping
candidates are Spark expressions.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.config import DetectConfig
from factloom.functions.ids import surface_hash
from factloom.functions.spans import overlaps

_NOT_URL = r"[^\s<>\[\]{}|\\^`\"']+"
# Detector, entity type, confidence and pattern, in the order of precedence.
PATTERNS = [
    ("EMAIL", "EMAIL", 0.95, re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b")),
    ("URL", "URL", 0.95, re.compile(r"\bhttps?://" + _NOT_URL, re.IGNORECASE)),
    ("DOI", "DOI", 0.90, re.compile(r"\b(?:doi:?\s*)?10\.\d{4,}/" + _NOT_URL, re.IGNORECASE)),
    ("UUID", "UUID", 0.95, re.compile(r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}\b")),
    ("HASH_HEX", "HASH_HEX", 0.70, re.compile(r"\b(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64}|[0-9a-fA-F]{128})\b")),
    ("IP_ADDRESS", "IP_ADDRESS", 0.90, re.compile(r"\b(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\b")),
    ("IP_ADDRESS", "IP_ADDRESS", 0.85, re.compile(r"\b(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}\b|\b(?:[0-9a-fA-F]{1,4}:){1,7}:\b|\b::(?:[0-9a-fA-F]{1,4}:){0,6}[0-9a-fA-F]{1,4}\b")),
    ("PHONE", "PHONE", 0.80, re.compile(r"\+\d{1,3}[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}")),
    ("PHONE", "PHONE", 0.80, re.compile(r"\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}")),
    ("FILEPATH", "FILEPATH", 0.75, re.compile(r"(?:^|[\s\"'`])(/(?:[^/\s\"'`\x00-\x1f]+/)*[^/\s\"'`\x00-\x1f]+)", re.MULTILINE)),
    ("FILEPATH", "FILEPATH", 0.80, re.compile(r"\b[A-Za-z]:\\(?:[^\\/:*?\"<>|\s]+\\)*[^\\/:*?\"<>|\s]+")),
    ("BARE_DOMAIN", "BARE_DOMAIN", 0.70, re.compile(r"\b(?:[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?\.)+[a-zA-Z]{2,}\b")),
    ("ARXIV", "ARXIV", 0.90, re.compile(r"\barXiv:\s*(?:\d{4}\.\d{4,5}(?:v\d+)?|[a-z-]+/\d{7}(?:v\d+)?)\b|\b\d{4}\.\d{4,5}(?:v\d+)?\b", re.IGNORECASE)),
    ("CVE", "CVE", 0.95, re.compile(r"\bCVE-\d{4}-\d{4,}\b", re.IGNORECASE)),
    ("ORCID", "ORCID", 0.95, re.compile(r"\b(?:https?://orcid\.org/)?(\d{4}-\d{4}-\d{4}-\d{3}[\dX])\b", re.IGNORECASE)),
    ("HANDLE", "HANDLE", 0.75, re.compile(r"(?<![a-zA-Z0-9_])@[a-zA-Z_][a-zA-Z0-9_]{2,}\b")),
    ("HASHTAG", "HASHTAG", 0.80, re.compile(r"(?<![a-zA-Z0-9_])#[a-zA-Z][a-zA-Z0-9_]{2,}\b")),
]
# Order of detectors among candidates of equal confidence and length.
ORDER = ["EMAIL", "URL", "DOI", "UUID", "HASH_HEX", "IP_ADDRESS", "PHONE", "FILEPATH", "BARE_DOMAIN", "ARXIV", "CVE", "ORCID", "HANDLE", "HASHTAG"]
# Words of programming languages that are no names.
CODE_WORDS = (
    "null true false undefined none nil int str bool float dict list tuple void const var let function class def return if else for while "
    "try except import from as with lambda yield async await"
).split()
CANDIDATE = "array<struct<detector:string,kind:string,start:int,end:int,surface:string,confidence:double>>"
#: No text without one of these can hold a candidate: checked before Python is called.
HINT = r"[@/\\#]|\d|\.[a-zA-Z]{2}|:[0-9a-fA-F]{0,4}:"


def orcid_valid(digits: str) -> bool:
    """ISO 7064 mod 11-2 over the first fifteen digits."""
    total = 0
    for c in digits[:-1]:
        total = (total + int(c)) * 2
    check = (12 - total % 11) % 11
    return digits[-1].upper() == ("X" if check == 10 else str(check))


def candidates_of(text: str, config: DetectConfig) -> list[tuple[str, str, int, int, str, float]]:
    """All candidates of one text in detector order."""
    out, spans, arxiv = [], set(), set()
    off = {n for n, on in (("ARXIV", config.arxiv), ("CVE", config.cve), ("ORCID", config.orcid), ("HANDLE", config.handle), ("HASHTAG", config.hashtag)) if not on}
    for name, kind, confidence, pattern in PATTERNS:
        if name in off:
            continue
        for m in pattern.finditer(text):
            group = 1 if name == "FILEPATH" and pattern.groups else 0
            start, end, surface = m.start(group), m.end(group), m.group(group)
            if name in ("URL", "DOI"):
                surface = surface.rstrip(".,;:!?)>]")
                end = start + len(surface)
                if name == "URL" and len(surface) <= 10:
                    continue
            elif name == "HASH_HEX":
                confidence = 0.85 if len(surface) >= 64 else 0.70
            elif name == "PHONE":
                if (start, end) in spans or sum(c.isdigit() for c in surface) < 10:
                    continue
                spans.add((start, end))
            elif name == "FILEPATH" and group and not (surface.startswith(("/usr/", "/home/", "/var/", "/etc/")) or "." in surface.split("/")[-1]):
                continue
            elif name == "BARE_DOMAIN":
                if (start and text[start - 1] == "@") or (config.tld_allowlist and surface.rsplit(".", 1)[1].lower() not in config.tld_allowlist):
                    continue
            elif name == "ARXIV":
                number = re.sub(r"(?i)^arxiv:\s*", "", surface)
                if number in arxiv:
                    continue
                arxiv.add(number)
            elif name == "CVE":
                surface = surface.upper()
            elif name == "ORCID" and not orcid_valid(m.group(1).replace("-", "")):
                continue
            out.append((name, kind, start, end, surface, confidence))
    return out


def candidates(messages: DataFrame, config: DetectConfig = DetectConfig()) -> DataFrame:
    """messages (message_id, text) exploded into candidates, each with its place in the text checked.

    ``excluded`` (array of start and end), if messages have it, suppresses what it
    meets; so do surfaces that are not the text at their span, and code words.
    """

    @F.pandas_udf(CANDIDATE)
    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else [dict(zip(("detector", "kind", "start", "end", "surface", "confidence"), c, strict=True)) for c in candidates_of(t, config)])

    rows = messages.where(F.col("text").isNotNull() & F.col("text").rlike(HINT))
    if "excluded" not in rows.columns:
        rows = rows.withColumn("excluded", F.array().cast("array<struct<start:int,end:int>>"))
    found = rows.select("message_id", "text", "excluded", F.explode(scan("text")).alias("c")).select("message_id", "text", "excluded", "c.*")
    wrong = F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")) != F.col("surface")
    reason = F.when(F.col("start").isNull(), "NO_OFFSETS_UNRELIABLE").when(wrong, "OFFSET_MISMATCH").when(overlaps(F.col("start"), F.col("end"), F.col("excluded")), "INTERSECTS_CODE_FENCE").when(F.lower(F.trim("surface")).isin(*CODE_WORDS), "CODE_LIKE_TOKEN")
    return found.select("message_id", "detector", "kind", "start", "end", "surface", "confidence", reason.alias("reason"))


def _order(detector: Column) -> Column:
    cases = F.when(detector == ORDER[0], 1)
    for i, name in enumerate(ORDER[1:], 2):
        cases = cases.when(detector == name, i)
    return cases.when(detector.startswith("LEXICON"), 50).when(detector.startswith("NER"), 100).otherwise(99)


def resolved(found: DataFrame) -> DataFrame:
    """Candidates without a reason to suppress them, each marked kept or with the winner (winner_start, winner_end) it lies across.

    Greedy in the order of confidence, length, detector, start, end and surface
    hash, folded over each message's candidates.
    """
    ranked = F.struct((-F.col("confidence")).alias("c"), (F.col("start") - F.col("end")).alias("l"), _order(F.col("detector")).alias("d"), F.col("start"), (-F.col("end")).alias("e"), surface_hash(F.col("surface")).alias("h"), F.col("end"), F.col("detector"), F.col("kind"), F.col("surface"), F.col("confidence"))
    per = found.where("reason is null").groupBy("message_id").agg(F.array_sort(F.collect_list(ranked)).alias("all"))
    kind = "array<struct<start:int,end:int>>"
    winners = F.aggregate("all", F.array().cast(kind), lambda done, c: F.when(F.exists(done, lambda w: (c["start"] < w["end"]) & (w["start"] < c["end"])), done).otherwise(F.concat(done, F.array(F.struct(c["start"].alias("start"), c["end"].alias("end"))))).cast(kind))
    rows = per.select("message_id", winners.alias("winners"), F.posexplode("all").alias("rank", "c"))
    across = F.filter("winners", lambda w: (F.col("c.start") < w["end"]) & (w["start"] < F.col("c.end")))
    first = F.element_at(across, 1)
    # a winner meets itself first; of equal spans only the one ranked first is kept
    same = F.min(F.when((first["start"] == F.col("c.start")) & (first["end"] == F.col("c.end")), F.col("rank")))
    from pyspark.sql import Window

    least = same.over(Window.partitionBy("message_id", "c.start", "c.end"))
    kept = (first["start"] == F.col("c.start")) & (first["end"] == F.col("c.end")) & (F.col("rank") == least)
    return rows.select("message_id", "c.detector", "c.kind", F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.col("c.surface").alias("surface"), F.col("c.confidence").alias("confidence"), kept.alias("kept"), first["start"].alias("winner_start"), first["end"].alias("winner_end"))
