"""Valid time and lifecycle of assertions: eligibility, retraction, negation, functional supersession, conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.config import TemporalConfig
from factloom.functions.ids import entity_id
from factloom.functions.scores import alignment

# A status may only give way to one of higher precedence.
PRECEDENCE = {"active": 0, "ineligible": 1, "conflicted": 2, "superseded": 3, "negated": 4, "retracted": 5}


def precedence(status: Column) -> Column:
    """Rank of a status."""
    out = F.lit(None).cast("int")
    for name, rank in PRECEDENCE.items():
        out = F.when(status == name, rank).otherwise(out)
    return out


def raised(status: Column, proposed: Column) -> Column:
    """proposed where its precedence is strictly higher."""
    return F.when(precedence(proposed) > precedence(status), proposed).otherwise(status)


def with_valid_time(assertions: DataFrame, times: DataFrame, config: TemporalConfig = TemporalConfig()) -> DataFrame:
    """assertions with valid_from, valid_to and valid_source.

    The time mention of the same message that scores best (alignment times
    confidence, then start and surface) counts if its alignment is enough; else the moment of
    the statement, if its quality is original; else unknown. Intervals that do
    not run forward are unknown.
    """
    known = times.where("resolved_type <> 'unresolved'").select("message_id", F.col("start").alias("t_start"), F.col("end").alias("t_end"), "valid_from", "valid_to", F.col("confidence").alias("t_conf"))
    met = assertions.select("assertion_id", "message_id", "start", "end").join(known, "message_id").withColumn("near", alignment(F.col("start"), F.col("end"), F.col("t_start"), F.col("t_end"), config.proximity_chars))
    met = met.where(F.col("near") >= config.min_alignment)
    best = met.groupBy("assertion_id").agg(F.max_by(F.struct("valid_from", "valid_to"), F.struct((F.col("near") * F.col("t_conf")).alias("s"), (-F.col("t_start")).alias("b"))).alias("t"))
    joined = assertions.join(best, "assertion_id", "left")
    quality = F.col("timestamp_quality") if "timestamp_quality" in assertions.columns else F.when(F.col("created_at").isNotNull(), "original")
    fallback = (quality == "original") & F.lit(config.fallback_to_asserted)
    source = F.when(F.col("t").isNotNull(), "explicit").when(fallback, "asserted_at").otherwise("unknown")
    start = F.when(F.col("t").isNotNull(), F.col("t.valid_from")).when(fallback, F.col("created_at"))
    end = F.col("t.valid_to")
    bad = end.isNotNull() & (end <= start)
    return joined.select(*assertions.columns, F.when(~F.coalesce(bad, F.lit(False)), start).alias("valid_from"), F.when(~F.coalesce(bad, F.lit(False)), end).alias("valid_to"), F.when(F.coalesce(bad, F.lit(False)), "unknown").otherwise(source).alias("valid_source"))


def eligibility(facts: DataFrame, config: TemporalConfig = TemporalConfig()) -> DataFrame:
    """facts with reasons (why not eligible) and status: active, or ineligible with any reason.

    Facts have confidence, polarity, modality, valid_from, explicit (their own time was said) and role.
    """
    tests = [
        (F.col("confidence") >= config.threshold, "LOW_CONFIDENCE"),
        (F.col("polarity") == "positive", "NEGATIVE_POLARITY"),
        (~F.col("modality").isin("question", "intention"), "MODALITY"),
        (F.col("valid_from").isNotNull(), "NO_VALID_FROM"),
        (F.col("explicit"), "NO_EXPLICIT_TIME"),
        ((F.col("role") == "user") | F.col("corroborated"), "NOT_USER_GROUNDED"),
    ]
    reasons = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in tests]), lambda x: x.isNotNull())
    return facts.withColumn("reasons", reasons).withColumn("status", F.when(F.size("reasons") == 0, "active").otherwise("ineligible"))


def rules_for(facts: DataFrame, rules: DataFrame) -> DataFrame:
    """facts (predicate, subject_type) with functional and policy of the rule that fits best.

    Rules (predicate or null, subject_type or *): both named, predicate only,
    type only, neither. The table is small: a few rules a predicate.
    """
    wanted = facts.select("predicate", "subject_type").distinct()
    met = wanted.join(rules.select(F.col("predicate").alias("rp"), F.col("subject_type").alias("rt"), "functional", "policy", "rule_id"), (F.col("rp").isNull() | (F.col("rp") == F.col("predicate"))) & ((F.col("rt") == "*") | (F.col("rt") == F.col("subject_type"))))
    level = F.when(F.col("rp").isNotNull() & (F.col("rt") != "*"), 0).when(F.col("rp").isNotNull(), 1).when(F.col("rt") != "*", 2).otherwise(3)
    best = Window.partitionBy("predicate", "subject_type").orderBy(level, "rule_id")
    chosen = met.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("predicate", "subject_type", "functional", "policy", "rule_id")
    return facts.join(chosen, ["predicate", "subject_type"], "left")


def apply_retractions(facts: DataFrame, retractions: DataFrame, config: TemporalConfig = TemporalConfig()) -> DataFrame:
    """facts with status retracted where the first user retraction (by message, start, id) of enough confidence names exactly one fact.

    valid_to is never touched.
    """
    strong = retractions.where((F.col("confidence") >= config.threshold) & (F.col("role") == "user"))
    met = strong.join(facts.where("status <> 'retracted'").select("assertion_id", "fact_key"), F.col("target_fact") == F.col("fact_key"))
    single = met.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("retraction_id"))).where("n = 1")
    first = Window.partitionBy("assertion_id").orderBy("message_id", F.col("start").asc_nulls_first(), "retraction_id")
    chosen = single.withColumn("rank", F.row_number().over(first)).where("rank = 1").select("assertion_id", F.col("retraction_id").alias("retracted_by"))
    joined = facts.join(chosen, "assertion_id", "left")
    return joined.withColumn("status", F.when(F.col("retracted_by").isNotNull(), raised(F.col("status"), F.lit("retracted"))).otherwise(F.col("status")))


def ambiguous_retractions(facts: DataFrame, retractions: DataFrame, config: TemporalConfig = TemporalConfig()) -> DataFrame:
    """retraction_id and the assertion_ids it may mean, where there are several."""
    strong = retractions.where((F.col("confidence") >= config.threshold) & (F.col("role") == "user"))
    met = strong.join(facts.where("status <> 'retracted'").select("assertion_id", "fact_key"), F.col("target_fact") == F.col("fact_key"))
    return met.groupBy("retraction_id").agg(F.array_sort(F.collect_list("assertion_id")).alias("members")).where(F.size("members") > 1)


def apply_negations(facts: DataFrame, config: TemporalConfig = TemporalConfig()) -> DataFrame:
    """facts with negated_by and ambiguous, by (subject, predicate, object_signature): the first negative statement that may closes a lone active target; several targets make every such statement ambiguous."""
    may = (F.col("polarity") == "negative") & (F.col("role") == "user") & (F.col("confidence") >= config.threshold) & F.col("valid_from").isNotNull()
    group = Window.partitionBy("subject_id", "predicate", "object_signature")
    marked = facts.withColumns({"_may": F.coalesce(may, F.lit(False)), "_target": F.coalesce((F.col("polarity") == "positive") & (F.col("status") == "active"), F.lit(False))})
    first = F.min(F.when(F.col("_may"), F.struct("asserted_at", "assertion_id", "valid_from"))).over(group)
    marked = marked.withColumns({"_targets": F.count_if("_target").over(group), "_first": first})
    hit = F.col("_target") & (F.col("_targets") == 1) & F.col("_first").isNotNull()
    new = {"status": F.when(hit, "negated").otherwise(F.col("status")), "valid_to": F.when(hit, F.least("valid_to", "_first.valid_from")).otherwise(F.col("valid_to"))}
    return marked.select(*[new[c].alias(c) if c in new else c for c in facts.columns], F.when(hit, F.col("_first.assertion_id").cast("string")).alias("negated_by"), (F.col("_may") & (F.col("_targets") > 1)).alias("ambiguous"))


def _moments(ready: DataFrame, config: TemporalConfig) -> DataFrame:
    """One row a moment of a functional (subject_id, predicate), in the order of time: its facts, the one that stands for it (rep) and what its coming does.

    torn says that its facts disagree, differs that rep's object is another than
    that of the moment before, wins that rep is stronger or of a better tier. A rep
    counts as conflicted if its moment is torn or it came too close to one that was
    not; that goes from moment to moment as a chain of negations, so that it follows
    from the last moment without one and the parity of the distance to it.
    """
    keys = ["subject_id", "predicate"]
    rep = F.struct((-F.col("confidence")).alias("less"), "tier", "assertion_id", "object_signature", "confidence")
    moments = ready.groupBy(*keys, "valid_from").agg(F.min(rep).alias("rep"), (F.min("object_signature") != F.max("object_signature")).alias("torn"), F.sort_array(F.collect_list("assertion_id")).alias("ids"))
    order = Window.partitionBy(*keys).orderBy("valid_from")
    met = moments.withColumns({"at": F.row_number().over(order), "before": F.lag("rep").over(order)})
    gain = F.col("rep.confidence") - F.col("before.confidence")
    tier = F.lit(config.tier_tiebreak) & (F.abs(gain) < config.margin) & (F.col("rep.tier") < F.col("before.tier"))
    met = met.withColumns({"differs": F.coalesce(F.col("before.object_signature") != F.col("rep.object_signature"), F.lit(False)), "by_tier": F.coalesce(tier, F.lit(False))})
    met = met.withColumn("wins", F.coalesce(gain >= config.margin, F.lit(False)) | F.col("by_tier"))
    plain = ~(F.col("differs") & ~F.col("torn") & ~F.col("wins"))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(plain, F.struct("at", "torn"))).over(so_far)
    met = met.withColumn("last", last).withColumn("caught", F.col("last.torn") != ((F.col("at") - F.col("last.at")) % 2 == 1))
    met = met.withColumn("held", F.coalesce(F.lag("caught").over(order), F.lit(False)) | F.col("torn"))
    step = F.when(F.col("differs") & F.col("held"), "blocked").when(F.col("differs") & F.col("wins"), "won").when(F.col("differs"), "close")
    met = met.withColumn("step", step)
    return met.withColumns({"next_step": F.lead("step").over(order), "next_id": F.lead("rep.assertion_id").over(order), "next_from": F.lead("valid_from").over(order)})


def apply_functional(facts: DataFrame, config: TemporalConfig = TemporalConfig()) -> DataFrame:
    """facts with functional predicates walked: later, stronger facts supersede and close earlier ones.

    Facts have subject_id, predicate, object_signature, valid_from, valid_to,
    confidence, tier, status, functional and explicit. Only active, dated rows
    take part; the rest pass by. Ties in time are settled by confidence, tier and id.
    """
    keys = ["subject_id", "predicate"]
    ready = F.coalesce(F.col("functional") & F.col("explicit") & (F.col("status") == "active") & F.col("valid_from").isNotNull(), F.lit(False))
    marked = facts.withColumn("_ready", ready)
    moments = _moments(marked.where("_ready"), config).select(*keys, "valid_from", "torn", "step", "next_step", "next_id", "next_from", F.col("rep.assertion_id").alias("_rep"), F.lit(True).alias("_met"))
    joined = marked.join(moments, [*keys, "valid_from"], "left")
    own = F.coalesce(F.col("_ready") & F.col("_met"), F.lit(False))
    rep = own & (F.col("_rep") == F.col("assertion_id"))
    beaten = rep & (F.col("next_step") == "won")
    status = F.when(own & F.col("torn"), "conflicted").when(rep & ((F.col("step") == "close") | (F.col("next_step") == "close")), "conflicted").when(beaten, "superseded").otherwise(F.col("status"))
    new = {"status": status, "valid_to": F.when(beaten, F.least("valid_to", "next_from")).otherwise(F.col("valid_to"))}
    return joined.select(*[new[c].alias(c) if c in new else c for c in facts.columns], F.when(beaten, F.col("next_id").cast("string")).alias("superseded_by"))


def functional_conflicts(facts: DataFrame, config: TemporalConfig = TemporalConfig()) -> DataFrame:
    """conflict_id, kind, key and members of the conflicts that the walk meets."""
    met = _moments(facts.where("functional and explicit and status = 'active' and valid_from is not null"), config)
    names = F.transform("ids", lambda x: x.cast("string"))
    pair = F.array(F.col("before.assertion_id").cast("string"), F.col("rep.assertion_id").cast("string"))
    here = F.when(F.col("torn"), F.struct(F.lit("OBJECT_DISAGREEMENT").alias("kind"), names.alias("members"))).when(F.size("ids") > 1, F.struct(F.lit("SAME_TIME_DUPLICATES").alias("kind"), names.alias("members")))
    kind = F.when(F.col("step") == "blocked", "OBJ_TRANSITION_CONFLICT").when(F.col("step") == "close", "OBJ_CONFIDENCE_TOO_CLOSE").when((F.col("step") == "won") & F.col("by_tier"), "DETECTOR_TIER_TIEBREAK")
    over = F.when(kind.isNotNull(), F.struct(kind.alias("kind"), pair.alias("members")))
    found = met.select("subject_id", "predicate", F.col("valid_from").cast("string").alias("at"), F.explode(F.filter(F.array(here, over), lambda x: x.isNotNull())).alias("c")).select("subject_id", "predicate", "at", "c.*")
    key = F.concat_ws("|", F.lower("kind"), F.col("subject_id").cast("string"), "predicate", "at")
    merged = found.groupBy(key.alias("key"), "kind").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("members")))).alias("members"))
    return merged.select(entity_id("conflict", F.col("key")).alias("conflict_id"), "kind", "key", "members")


def apply_corrections(facts: DataFrame, corrections: DataFrame) -> DataFrame:
    """facts with status superseded and corrected_by where a correction (assertion_id, replacement) names an assertion that exists.

    valid_to is never touched; a status of higher precedence stays. Of several
    replacements the least id counts.
    """
    there = corrections.join(facts.select(F.col("assertion_id").alias("replacement")), "replacement", "left_semi")
    chosen = there.groupBy("assertion_id").agg(F.min("replacement").alias("_by"))
    joined = facts.join(chosen, "assertion_id", "left")
    hit = F.col("_by").isNotNull() & (precedence(F.col("status")) < PRECEDENCE["superseded"])
    new = {"status": F.when(hit, "superseded").otherwise(F.col("status"))}
    return joined.select(*[new[c].alias(c) if c in new else c for c in facts.columns], F.when(hit, F.col("_by")).alias("corrected_by"))
