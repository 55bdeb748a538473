"""Confidence and salience formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.config import AssertionConfig


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """value within [low, high]."""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def lexicon_score(weighted: Column, conversations: Column, diversity: Column, code: Column) -> Column:
    """Score of a lexicon candidate."""
    return 1.0 * weighted + 2.0 * conversations + 0.5 * diversity - 1.0 * code


def salience(mentions: Column, conversations: Column, user_mentions: Column, last_seen: Column, as_of: Column, half_life: float = 90.0) -> Column:
    """Salience of an entity at a moment; unknown last sight counts as half recent."""
    ratio = F.when(mentions > 0, user_mentions / mentions).otherwise(0.0)
    days = F.timestamp_diff("SECOND", last_seen, as_of) / 86400.0
    recency = F.when(last_seen.isNull(), 0.5).otherwise(F.exp(-F.log(F.lit(2.0)) * days / half_life))
    return 0.3 * mentions + 0.4 * conversations + 0.2 * ratio + 0.1 * recency


def grounding(subject_conf: Column, subject_tier: Column, object_conf: Column, object_tier: Column, config: AssertionConfig = AssertionConfig()) -> Column:
    """Confidence of grounding; a literal object (null tier) weighs 1."""
    subject = subject_conf * (1 + (4 - subject_tier) * config.tier_bonus)
    obj = F.when(object_tier.isNull(), F.lit(1.0)).otherwise(object_conf * (1 + (4 - object_tier) * config.tier_bonus))
    return clamp((subject + obj) / 2)


def final_confidence(extraction: Column, grounded: Column, role: Column, corroborated: Column, config: AssertionConfig = AssertionConfig()) -> Column:
    """Extraction times grounding times trust in the speaker."""
    trust = F.when(role == "user", config.trust_user).when(corroborated, config.trust_corroborated).otherwise(config.trust_assistant)
    return clamp(extraction * grounded * trust)


def alignment(start: Column, end: Column, other_start: Column, other_end: Column, proximity: int = 200) -> Column:
    """1 / (1 + gap) between two spans, 0 beyond the proximity."""
    gap = F.greatest(F.lit(0), other_start - end, start - other_end)
    return F.when(gap <= proximity, 1.0 / (1.0 + gap)).otherwise(0.0)


def window_salience(mentions: Column, total: Column, recency: Column, confidence: Column) -> Column:
    """Salience of a member within a window: its share of the mentions, weighed before it is divided, and the others."""
    return 4 * mentions / 10 / total + 0.2 * recency + 0.4 * confidence


def evergreen(base: Column, windows: Column, member_windows: Column, strength: float = 0.3) -> Column:
    """Less for members of nearly every window."""
    factor = 1 - strength + strength * F.log((1.0 + windows) / (1.0 + member_windows)) / F.log(1.0 + windows)
    return F.when(windows > 1, base * factor).otherwise(base)


def salience_factor(salience: Column, most: Column, bonus: float = 0.1) -> Column:
    """1 plus the bonus times the share of the corpus's greatest salience (at least 1); 1 where it is unknown."""
    return F.coalesce(1.0 + salience / F.greatest(F.lit(1.0), most) * bonus, F.lit(1.0))
