"""Thresholds and weights of all operators, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

NAMESPACE = "550e8400-e29b-41d4-a716-446655440000"
GRAPH_NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"


@dataclass(frozen=True)
class DetectConfig:
    """Entity and time detection."""

    ignore_blockquotes: bool = False
    arxiv: bool = True
    cve: bool = True
    orcid: bool = True
    handle: bool = False
    hashtag: bool = False
    tld_allowlist: tuple[str, ...] | None = None


@dataclass(frozen=True)
class LexiconConfig:
    """Lexicon induction and entity consolidation."""

    min_weighted: float = 3.0
    min_conversations: int = 2
    max_code: float = 0.5
    min_diversity: float = 0.1
    cap: int = 1000
    role_weights: dict[str, float] = field(default_factory=lambda: {"user": 1.0, "assistant": 0.5})
    other_weight: float = 0.3
    half_life_days: float = 90.0


@dataclass(frozen=True)
class AssertionConfig:
    """Extraction, grounding and confidence."""

    context_messages: int = 5
    min_chars: int = 10
    fuzzy_threshold: float = 0.85
    predicate_similarity: float = 0.9
    corroboration_window: int = 10
    retraction_window: int = 20
    trust_user: float = 1.0
    trust_corroborated: float = 0.9
    trust_assistant: float = 0.5
    tier_bonus: float = 0.05
    keep_margin: float = 0.001


@dataclass(frozen=True)
class TemporalConfig:
    """Valid time, lifecycle and conflicts."""

    proximity_chars: int = 200
    min_alignment: float = 0.1
    threshold: float = 0.7
    margin: float = 0.01
    fallback_to_asserted: bool = True
    tier_tiebreak: bool = True


@dataclass(frozen=True)
class ProfileConfig:
    """Windows, salience and clusters of a focal entity."""

    granularity: str = "month"
    statuses: tuple[str, ...] = ("ineligible",)
    frequency_weight: float = 0.4
    recency_weight: float = 0.2
    confidence_weight: float = 0.4
    decay: float = 0.1
    evergreen: float = 0.3
    min_assertions: int = 1
    top_members: int = 10
    top_clusters: int = 6
    cluster_cap: int = 50
    evidence_cap: int = 50
    pairwise_limit: int = 10
