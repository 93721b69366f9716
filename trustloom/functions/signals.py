"""The nine trust signals: struct(score, confidence, evidence as JSON) expressions.

Evidence differs by branch, so it is a JSON string; its null fields are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions import lexicons as L
from trustloom.functions import stats
from trustloom.functions.text import age_days, domain_tier, netloc, parse_date, strip


def signal(score, confidence, **evidence) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    ev = F.to_json(F.struct(*[lit(v).alias(k) for k, v in evidence.items()]), {"ignoreNullFields": "false"}) if evidence else F.lit("{}")
    return F.struct(lit(score).cast("double").alias("score"), lit(confidence).cast("double").alias("confidence"), ev.alias("evidence"))


def no_author(author: Column) -> Column:
    return F.coalesce(F.lower(author), F.lit("")).isin(*L.MISSING_AUTHORS)


def is_spam_url(url: Column) -> Column:
    return F.coalesce(url, F.lit("")).rlike(L.LOW_AUTHORITY_URL)


def _one_author(name: Column, high: Column, spam: Column) -> Column:
    """(score, confidence) of a single name."""
    pair = lambda a, b: F.struct(F.lit(a).cast("double").alias("s") if not isinstance(a, Column) else a.alias("s"), F.lit(b).cast("double").alias("c") if not isinstance(b, Column) else b.alias("c"))
    return (
        F.when(no_author(name), pair(F.when(high, 0.35).otherwise(0.12), 0.40))
        .when(name.rlike(L.CREDIBLE_ORG), pair(1.0, F.when(spam, 0.70).otherwise(0.95)))
        .otherwise(pair(F.when(high, 0.72).otherwise(0.52), 0.65))
    )


def author(name: Column, url: Column, tier: Column | None = None, spam: Column | None = None) -> Column:
    high, spam = (domain_tier(url) if tier is None else tier) == 2, is_spam_url(url) if spam is None else spam
    one = _one_author(name, high, spam)
    parts = F.filter(F.transform(F.split(name, ","), strip), lambda p: p != "")
    subs = F.transform(parts, lambda p: _one_author(p, high, spam))
    mean = lambda field: F.round(F.aggregate(subs, F.lit(0.0), lambda a, x: a + x[field]) / F.size(subs), 4)
    several = ~no_author(name) & name.contains(",") & ~name.rlike(L.CREDIBLE_ORG) & (F.size(parts) > 1)
    return (
        F.when(several, signal(mean("s"), mean("c"), reason="multi_author_average", count=F.size(parts)))
        .when(no_author(name), signal(one["s"], one["c"], reason="no_author", domain_proxy=high))
        .when(name.rlike(L.CREDIBLE_ORG), signal(one["s"], one["c"], reason="credible_org_match", author=name))
        .otherwise(signal(one["s"], one["c"], reason="named_author", high_domain=high))
    )


def citation(source_type: Column, citations: Column, views: Column, text: Column) -> Column:
    hits = F.regexp_count(text, F.lit(L.EVIDENCE))
    return (
        F.when((source_type == "pubmed") & citations.isNull(), signal(0.40, 0.30, reason="citations_unknown"))
        .when(source_type == "pubmed", signal(F.round(F.least(citations / 200, F.lit(1.0)), 4), 0.90, citations=citations))
        .when(views > 0, signal(F.round(F.least(F.log10(views) / 6.0, F.lit(1.0)), 4), 0.65, views=views))
        .when(F.length(text) > 0, signal(F.round(F.least(hits / 8, F.lit(1.0)), 4), 0.55, reason="blog_evidence_proxy", evidence_phrases=hits))
        .otherwise(signal(0.35, 0.30, reason="no_engagement_data"))
    )


def domain(url: Column, host: Column | None = None, tier: Column | None = None, spam: Column | None = None) -> Column:
    host, tier = netloc(url) if host is None else host, domain_tier(url) if tier is None else tier
    spam = is_spam_url(url) if spam is None else spam
    return (
        F.when(host == "", signal(0.10, 0.90, reason="no_domain"))
        .when(tier == 2, signal(0.95, 0.92, tier="high", domain=host))
        .when(tier == 1, signal(0.62, 0.80, tier="medium", domain=host))
        .when(spam, signal(0.12, 0.85, tier="spam", pattern="low_auth_regex"))
        .otherwise(signal(0.38, 0.50, tier="unknown", domain=host))
    )


def halflife(source_type: Column, s: Settings = DEFAULT) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in s.halflife.items() for x in kv]), source_type), F.lit(s.halflife["blog"]))


def recency(published: Column, source_type: Column, s: Settings = DEFAULT, age: Column | None = None) -> Column:
    age = age_days(parse_date(published), s.as_of) if age is None else age
    hl = halflife(source_type, s)
    score = F.greatest(F.lit(s.recency_floor), F.round(s.recency_ceiling * F.pow(F.lit(2.0), -age / hl), 4))
    return (
        F.when(age.isNull(), signal(0.30, 0.30, reason="missing_date", raw=published))
        .when(age < 0, signal(0.30, 0.30, reason="future_date", raw=published, age_days=age))
        .otherwise(signal(score, 0.88, age_days=age, halflife=hl, published=published))
    )


def is_health(text: Column) -> Column:
    return text.rlike(L.HEALTH)


def disclaimer(text: Column, source_type: Column, url: Column, host: Column | None = None, tier: Column | None = None) -> Column:
    host, tier = netloc(url) if host is None else host, domain_tier(url) if tier is None else tier
    return (
        F.when(source_type == "pubmed", signal(0.50, 0.0, reason="pubmed_peer_reviewed"))
        .when(~is_health(text), signal(0.50, 0.60, reason="non_health_content"))
        .when(text.rlike(L.DISCLAIMER), signal(1.0, 0.90, health_content=True, disclaimer_found=True))
        .when(tier == 2, signal(0.70, 0.75, health_content=True, disclaimer_found=False, implicit_editorial_review=True, domain=host))
        .when(tier == 1, signal(0.35, 0.55, health_content=True, disclaimer_found=False, implicit_editorial_review="partial", domain=host))
        .otherwise(signal(0.0, 0.90, health_content=True, disclaimer_found=False))
    )


#: Fields that must be there, by source type.
REQUIRED = {
    "blog": ("author", "published_date", "source_url"),
    "youtube": ("author", "published_date", "source_url", "view_count", "duration_sec"),
    "pubmed": ("author", "published_date", "source_url", "pmid", "doi", "journal"),
}


def present(field: str) -> Column:
    """Whether a column of the row counts as filled in; numbers must not be zero, ids must be well formed."""
    c = F.col(field)
    if field in ("view_count", "duration_sec"):
        return F.coalesce(c != 0, F.lit(False))
    pattern = {"doi": L.DOI, "pmid": L.PMID}.get(field)
    text = strip(c)
    return F.coalesce(text.rlike(pattern) if pattern else text != "", F.lit(False))


def metadata(source_type: Column) -> Column:
    """From the row's own columns author, published_date, source_url, view_count, duration_sec, pmid, doi, journal."""
    out = None
    for kind in ("youtube", "pubmed", "blog"):
        fields = REQUIRED[kind]
        n = sum((F.when(present(f), 1).otherwise(0) for f in fields), F.lit(0))
        missing = F.array_compact(F.array(*[F.when(~present(f), F.lit(f)) for f in fields]))
        made = signal(F.round(n / len(fields), 4), 1.0, present=n, required=len(fields), missing_fields=missing)
        out = made if kind == "blog" and out is None else (F.when(source_type == kind, made) if out is None else out.when(source_type == kind, made) if kind != "blog" else out.otherwise(made))
    return out


def depth_confidence(n: Column, s: Settings = DEFAULT) -> Column:
    """Linear between the steps of the ladder."""
    out, above = F, None
    for floor, conf in s.depth_ladder:
        value = F.lit(conf) if above is None else F.round(conf + F.least(F.lit(1.0), (n - floor) / (above[0] - floor)) * (above[1] - conf), 4)
        out, above = out.when(n >= floor, value), (floor, conf)
    return out


def depth(s: Settings = DEFAULT) -> Column:
    """Over ``with_features`` columns."""
    n = F.col("_n")
    ttr = F.size("_counts") / n
    gini = F.when(F.size("_content_words") > 0, stats.gini(F.col("_ccounts")))
    even = F.coalesce(F.greatest(F.lit(0.0), 1 - gini), F.lit(0.5))
    wc = F.least(n / s.depth_saturation, F.lit(1.0))
    score = F.round(F.least(0.3 * wc + 0.4 * ttr + 0.3 * even, F.lit(1.0)), 4)
    conf = depth_confidence(n, s)
    return (
        F.when(n == 0, signal(0.0, 0.10, reason="empty_content", word_count=0))
        .when(n < s.depth_min_words, signal(0.0, conf, reason="thin_content", word_count=n))
        .otherwise(signal(score, conf, word_count=n, ttr=F.round(ttr, 3), gini=F.round(F.coalesce(gini, F.lit(0.0)), 3), wc_score=F.round(wc, 3)))
    )


def engagement(views: Column, likes: Column, source_type: Column, s: Settings = DEFAULT) -> Column:
    ratio = F.greatest(likes.cast("double"), F.lit(1e-9)) / views
    z = (F.ln(ratio) - s.engagement_mu) / s.engagement_sigma
    out = F.abs(z) > s.engagement_outlier
    marks = F.array_compact(
        F.array(F.when((likes == 0) & (views > s.engagement_min_views), F.lit("zero_likes_high_views")), F.when(out, F.format_string("engagement_outlier:z=%.2f", z)))
    )
    score = F.round(F.greatest(F.lit(0.0), 1 - F.abs(z) / s.engagement_outlier), 4)
    enough = F.coalesce((views >= s.engagement_min_views) & likes.isNotNull(), F.lit(False))
    return (
        F.when(source_type != "youtube", signal(0.5, 0.0, reason="not_youtube"))
        .when(~enough, signal(0.5, 0.10, reason="insufficient_engagement_data", views=views, likes=likes))
        .otherwise(signal(score, F.when(out, 0.80).otherwise(0.75), views=views, likes=likes, like_view_ratio=F.round(ratio, 5), z_score=F.round(z, 3), manipulation_flags=marks))
    )


def decoded(text: Column) -> Column:
    """Percent escapes resolved; a text with a broken escape stays as it is."""
    return F.when(F.contains(text, F.lit("%")), F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)).otherwise(text)


def adversarial(text: Column, s: Settings = DEFAULT) -> Column:
    """Over ``with_features`` columns: hidden characters, injected instructions, repetition."""
    facts = F.struct(
        F.regexp_count(text, F.lit(f"[{L.BIDI}{L.ZERO_WIDTH}]")).alias("hidden"),
        stats.let(decoded(text), lambda plain: sum((F.when(plain.rlike(p), 1).otherwise(0) for p in L.INJECTION), F.lit(0))).alias("hits"),
        stats.ngram_repetition(F.col("_words"), s.ngram).alias("rep"),
    )

    def judged(f: Column) -> Column:
        parts = (
            F.greatest(F.lit(0.0), 1 - f["hidden"] / s.bidi_saturation)
            + F.greatest(F.lit(0.0), 1 - f["hits"] / s.injection_saturation)
            + F.when(f["rep"] > s.repetition, F.greatest(F.lit(0.0), 1 - f["rep"])).otherwise(1.0)
        )
        return signal(F.round(parts / 3, 4), 0.85, bidi_chars_found=f["hidden"], injection_patterns_hit=f["hits"], repetition_ratio=F.round(f["rep"], 3), ngram_size=s.ngram)

    return (
        F.when(F.length(text) == 0, signal(1.0, 0.0, reason="empty_content"))
        .when(F.length(text) < s.thin_chars, signal(0.90, 0.30, reason="thin_content"))
        .otherwise(stats.let(facts, judged))
    )
