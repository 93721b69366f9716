"""Parameters of scoring, chunking and filtering, with their invariants. All are plain values."""

from __future__ import annotations

from dataclasses import dataclass, field

SCHEMA_VERSION = "2.0"
SIGNALS = (
    "author_credibility",
    "citation_count",
    "domain_authority",
    "recency",
    "medical_disclaimer_presence",
    "metadata_completeness",
    "content_depth",
    "engagement_authenticity",
    "adversarial_risk",
)

#: Signal weights by source type, in the order of SIGNALS.
WEIGHTS = {
    "blog": (0.18, 0.08, 0.27, 0.20, 0.08, 0.05, 0.08, 0.02, 0.04),
    "youtube": (0.20, 0.08, 0.15, 0.20, 0.08, 0.04, 0.06, 0.12, 0.07),
    "pubmed": (0.20, 0.30, 0.12, 0.12, 0.08, 0.06, 0.08, 0.00, 0.04),
}


@dataclass(frozen=True)
class Settings:
    """Fixed values that results depend on; override a field to tune it."""

    as_of: str = "2026-05-10 00:00:00"
    halflife: dict = field(default_factory=lambda: {"blog": 90.0, "youtube": 365.0, "pubmed": 900.0})
    recency_ceiling: float = 0.95
    recency_floor: float = 0.05
    prior_weight: float = 0.12
    prior_min_n: int = 3
    prior_init: float = 0.50
    abuse_floor: float = 0.05
    penalty_anon_health: float = 0.70
    penalty_seo: float = 0.75
    penalty_conspiracy: float = 0.65
    penalty_stuffing: float = 0.80
    penalty_outdated: float = 0.82
    penalty_low_authority: float = 0.75
    penalty_anomaly: float = 0.90
    seo_min_hits: int = 2
    outdated_days: int = 730
    stuffing_base: float = 0.08
    stuffing_max: float = 0.45
    stuffing_k: float = 0.60
    stuffing_min_words: int = 80
    entropy_min_words: int = 80
    entropy_low: float = 4.5
    entropy_skip: float = 99.0
    promo_hits: int = 3
    promo_divisor: int = 500
    link_density: float = 0.20
    link_density_youtube: float = 0.40
    caps_density: float = 0.08
    template_cv: float = 0.08
    template_min_paras: int = 5
    template_min_mean: int = 10
    corruption_floor: int = 5
    corruption_ratio: float = 0.02
    thin_chars: int = 50
    transcript_noise: float = 0.15
    transcript_repetition: float = 0.25
    transcript_min_sentences: int = 4
    transcript_window: int = 500
    transcript_windows: int = 4
    transcript_inconsistency: float = 0.20
    chunk_max_words: int = 180
    chunk_overlap: int = 25
    chunk_min_words: int = 22
    chunk_quality: float = 0.22
    chunk_fallback: dict = field(default_factory=lambda: {"blog": 0.30, "youtube": 0.35, "pubmed": 0.40})
    depth_saturation: int = 2000
    depth_min_words: int = 30
    depth_ladder: tuple = ((300, 0.88), (100, 0.65), (30, 0.40), (0, 0.10))
    engagement_mu: float = -3.2
    engagement_sigma: float = 0.8
    engagement_outlier: float = 3.0
    engagement_min_views: int = 1000
    ngram: int = 4
    repetition: float = 0.40
    bidi_saturation: int = 5
    injection_saturation: int = 2
    tag_weights: tuple = (3.0, 1.5, 1.0)
    max_tags: int = 5
    relevance_hits: int = 2
    relevance_density: float = 0.003
    semantic_similarity: float = 0.25
    reject_below: float = 0.20
    tiers: tuple = ((0.75, "AUTHORITATIVE"), (0.55, "CREDIBLE"), (0.35, "UNCERTAIN"))
    tier_rest: str = "UNRELIABLE"
    max_field: int = 50_000
    max_url: int = 2048
    blog_max_words: int = 8000
    blog_body_words: int = 80
    preview_words: int = 10
    blog_total: int = 3
    blog_per_domain: int = 2
    youtube_total: int = 2
    youtube_candidates: int = 20
    pubmed_total: int = 1
    pubmed_candidates: int = 20
    min_words: dict = field(default_factory=lambda: {"blog": 40, "youtube": 50, "pubmed": 30})
    video_min_seconds: int = 120
    transcript_languages: tuple = ("en", "en-US", "en-GB")
    backoff_base: float = 1.6
    backoff_jitter: float = 0.35
    backoff_floor: float = 0.10
    extractor_min_chars: int = 100

    def __post_init__(self) -> None:
        for kind, w in WEIGHTS.items():
            if abs(sum(w) - 1) > 1e-6:
                raise ValueError(f"weights of {kind} sum to {sum(w)}")
        if not self.abuse_floor > 0 or not 0 <= self.reject_below < 1 or not 0 <= self.prior_weight <= 1:
            raise ValueError("abuse_floor must be above 0, reject_below in [0, 1), prior_weight in [0, 1]")


DEFAULT = Settings()
