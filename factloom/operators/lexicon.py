"""Terms that recur: generation, statistics, selection and matching in texts."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.config import LexiconConfig
from factloom.functions.scores import lexicon_score
from factloom.functions.spans import overlaps
from factloom.functions.text import collapsed, inferred_type

# The generators' patterns (first group is the surface; a quoted term's span holds its quotes).
GENERATORS = [
    ("TITLE_CASE", r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)\b"),
    ("ALLCAPS", r"\b([A-Z]{2,6})\b"),
    ("CAMEL_CASE", r"\b([a-z]+[A-Z][a-zA-Z]*|[A-Z][a-z]+[A-Z][a-zA-Z]*)\b"),
    ("HASHTAG", r"(#[a-zA-Z][a-zA-Z0-9_]{2,})\b"),
    ("HANDLE", r"(@[a-zA-Z][a-zA-Z0-9_]{2,})\b"),
    ("QUOTED", r'"([A-Z][^"]{3,50})"'),
]
# Terms never selected.
DENYLIST = (
    "usa uk eu un us am pm bc ad ce bce monday tuesday wednesday thursday friday saturday sunday mon tue wed thu fri sat sun "
    "january february march april may june july august september october november december jan feb mar apr jun jul aug sep oct nov dec "
    "the and for are but not you all can had her was one our out has his how its let new now old see two way who did get "
    "come made find here just know take want also back been call down even from good have into make much only over such than them then they "
    "very what when your more some time will with api url html css sql xml json http https fyi asap etc aka todo tbd wip eof eol "
    "google apple amazon microsoft facebook twitter"
).split()

FEW_FORMS = 1 << 17  # terms' spellings that may be broadcast,
FEW_BYTES = 1 << 24  # and the bytes they may hold together


def role_weight(role: Column, config: LexiconConfig) -> Column:
    """Weight of a speaker's words."""
    out = F.lit(config.other_weight)
    for name, weight in config.role_weights.items():
        out = F.when(role == name, weight).otherwise(out)
    return out


def occurrences(messages: DataFrame) -> DataFrame:
    """generator, term_key, surface, message_id, conversation_id, role, start, end and context (two words before and after) of every match that meets no excluded range (``excluded``, if messages have it)."""
    compiled = [(n, re.compile(p)) for n, p in GENERATORS]

    @F.pandas_udf("array<struct<generator:string,surface:string,start:int,end:int,context:string>>")
    def scan(texts: pd.Series) -> pd.Series:
        def of(text):
            out = []
            for name, pattern in compiled:
                for m in pattern.finditer(text):
                    if name == "QUOTED" and not 2 <= len(m.group(1).split()) <= 5:
                        continue
                    before, after = text[max(0, m.start() - 30) : m.start()].split(), text[m.end() : m.end() + 30].split()
                    out.append(dict(generator=name, surface=m.group(1), start=m.start(), end=m.end(), context=" ".join([*before[-2:], "|", *after[:2]])))
            return out

        return texts.map(of)

    rows = messages.where(F.col("text").isNotNull() & F.col("text").rlike('[A-Z]|[#@][a-zA-Z]'))
    if "excluded" not in rows.columns:
        rows = rows.withColumn("excluded", F.lit(None).cast("array<struct<start:int,end:int>>"))
    found = rows.select("message_id", "conversation_id", "role", "excluded", F.explode(scan("text")).alias("o")).where(~overlaps(F.col("o.start"), F.col("o.end"), F.col("excluded")))
    return found.select("message_id", "conversation_id", "role", "o.*", collapsed(F.col("o.surface")).alias("term_key"))


def candidate_stats(found: DataFrame, config: LexiconConfig = LexiconConfig()) -> DataFrame:
    """generator, term_key, total, weighted, conversations, diversity, code, canonical, aliases: one row a candidate."""
    keys = ["generator", "term_key"]
    by_surface = found.groupBy(*keys, "surface").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("role") == "user").alias("by_user"))
    names = by_surface.groupBy(*keys).agg(F.min_by("surface", F.struct(-F.col("n"), -F.col("by_user"), F.col("surface"))).alias("canonical"), F.array_sort(F.collect_set("surface")).alias("aliases"))
    stats = found.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(role_weight(F.col("role"), config)).alias("weighted"),
        F.count_distinct("conversation_id").alias("conversations"),
        (F.count_distinct("context") / F.count(F.lit(1))).alias("diversity"),
    )
    return stats.join(names, keys).withColumn("code", F.lit(0.0))


def selected(stats: DataFrame, config: LexiconConfig = LexiconConfig(), denylist: list[str] | None = None) -> DataFrame:
    """stats with score, reason (why not selected) and type: thresholds in order, one row a term, the best up to the cap."""
    denied = DENYLIST if denylist is None else denylist
    reason = F.when(F.col("term_key").isin(*denied), "DENYLIST").when(F.col("weighted") < config.min_weighted, "BELOW_MIN_COUNT").when(F.col("conversations") < config.min_conversations, "BELOW_MIN_CONV").when(F.col("code") > config.max_code, "CODE_HEAVY").when(F.col("diversity") < config.min_diversity, "LOW_DIVERSITY")
    scored = stats.withColumn("score", lexicon_score(F.col("weighted"), F.col("conversations"), F.col("diversity"), F.col("code"))).withColumn("reason", reason)
    open_ = F.col("reason").isNull()
    best = F.row_number().over(Window.partitionBy("term_key", open_).orderBy(F.desc("score"), "generator"))
    deduped = scored.withColumn("reason", F.when(open_ & (best > 1), "DUPLICATE_TERM").otherwise(F.col("reason")))
    # the cap needs one order over what is left; limit keeps it to the cap's rows in each task
    top = deduped.where("reason is null").orderBy(F.desc("score"), "term_key").limit(config.cap).select("term_key", "generator", F.lit(True).alias("in_cap"))
    joined = deduped.join(top, ["term_key", "generator"], "left")
    return joined.withColumn("reason", F.when(F.col("reason").isNull() & F.col("in_cap").isNull(), "CAP_EXCEEDED").otherwise(F.col("reason"))).drop("in_cap").withColumn("type", inferred_type(F.col("canonical")))


def matches(messages: DataFrame, terms: DataFrame) -> DataFrame:
    """message_id, term_key, start, end, surface of terms (term_key, canonical, aliases) in texts.

    Texts and terms meet by the term's first word, so that only terms that can
    occur are looked for; longer terms win, matches do not overlap, both ends are
    word ends, case does not matter. Terms are broadcast if they have been counted
    and found few and short; words of texts never are, however little a plan takes
    them for.
    """
    words = messages.where(F.col("text").isNotNull()).select("message_id", "text", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("word")).where("word <> ''")
    forms = terms.select("term_key", F.explode(F.array_union(F.array("canonical"), "aliases")).alias("form")).select("term_key", F.lower("form").alias("form")).distinct()
    forms = forms.withColumn("word", F.regexp_extract("form", r"([\p{L}\p{N}]+)", 1)).where("word <> ''").persist()
    held = forms.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("form") + F.octet_length("word") + F.coalesce(F.octet_length(F.col("term_key").cast("string")), F.lit(0))).alias("bytes")).first()
    near = words.join(F.broadcast(forms), "word") if held.n <= FEW_FORMS and (held.bytes or 0) <= FEW_BYTES else words.hint("merge").join(forms, "word")
    met = near.groupBy("message_id").agg(F.first("text").alias("text"), F.collect_set(F.struct("form", "term_key")).alias("forms"))

    @F.pandas_udf("array<struct<term_key:string,start:int,end:int,surface:string>>")
    def scan(texts: pd.Series, forms_: pd.Series) -> pd.Series:
        def of(text, some):
            taken, out = [], []
            for form, key in sorted({(f["form"], f["term_key"]) for f in some}, key=lambda x: (-len(x[0]), x)):
                for m in re.finditer(re.escape(form), text, re.IGNORECASE):
                    a, b = m.span()
                    if (a and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum()) or any(a < y and x < b for x, y in taken):
                        continue
                    taken.append((a, b))
                    out.append(dict(term_key=key, start=a, end=b, surface=text[a:b]))
            return out

        return pd.Series([of(t, f) for t, f in zip(texts, forms_, strict=True)])

    return met.select("message_id", F.explode(scan("text", "forms")).alias("m")).select("message_id", "m.*")


def without_overlaps(found: DataFrame, mentions: DataFrame) -> DataFrame:
    """Matches that meet no mention (message_id, detector, start, end) of their message but those of recognisers."""
    spans = mentions.where(~F.col("detector").startswith("NER:")).groupBy("message_id").agg(F.collect_list(F.struct("start", "end")).alias("_taken")).hint("merge")
    return found.join(spans, "message_id", "left").where(~overlaps(F.col("start"), F.col("end"), F.col("_taken"))).select(*found.columns)
