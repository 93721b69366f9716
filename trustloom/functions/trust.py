"""Fusion of the signals, abuse penalty, tier: everything that one record's own columns decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, SIGNALS, WEIGHTS, Settings
from trustloom.functions import anomaly, features, signals
from trustloom.functions import lexicons as L
from trustloom.functions.language import Detector, by_function_words, detect
from trustloom.functions.text import age_days, domain_tier, netloc, parse_date


def penalty(df: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Adds abuse_penalty and abuse_reasons. Needs author, source_url, content, published_date, source_type,
    anomaly_flags and the feature columns."""
    url, kind = F.coalesce(F.col("source_url"), F.lit("")), F.col("source_type")
    facts = {
        "health": signals.is_health(F.col("content")),
        "seo": F.regexp_count(url, F.lit(L.SPAM_URL)),
        "conspiracy": F.regexp_count(url, F.lit(L.CONSPIRACY_URL)),
        "stuffed": anomaly.stuffed(kind, s),
        "share": anomaly.top_share(),
        "limit": anomaly.stuffing_threshold(F.size("_ccounts"), s),
        "age": F.col("_u.age") if "_u" in df.columns else age_days(parse_date(F.col("published_date")), s.as_of),
        "low": signals.is_spam_url(url),
        "others": F.filter("anomaly_flags", lambda f: ~f.startswith("keyword_stuffing")),
    }
    df = features.once(df, _p=F.struct(*[v.alias(k) for k, v in facts.items()]))
    rules = [
        ((kind != "pubmed") & F.col("_p.health") & signals.no_author(F.col("author")), s.penalty_anon_health, F.lit("anonymous_health_content")),
        (F.col("_p.seo") >= s.seo_min_hits, s.penalty_seo, F.format_string("seo_spam_url:%d_patterns", "_p.seo")),
        (F.col("_p.conspiracy") >= 1, s.penalty_conspiracy, F.format_string("conspiracy_url_slug:%d_patterns", "_p.conspiracy")),
        (F.col("_p.stuffed"), s.penalty_stuffing, F.format_string("keyword_stuffing:%s:%.3f:threshold:%.3f", F.col("_top.w"), F.col("_p.share"), F.col("_p.limit"))),
        (kind.isin("blog", "youtube") & F.col("_p.health") & F.coalesce(F.col("_p.age") > s.outdated_days, F.lit(False)), s.penalty_outdated, F.lit("outdated_health_content")),
        (F.col("_p.health") & F.col("_p.low"), s.penalty_low_authority, F.lit("low_authority_health")),
    ]
    product = F.pow(F.lit(s.penalty_anomaly), F.size("_p.others"))
    for cond, factor, _ in rules:
        product = product * F.when(cond, factor).otherwise(1.0)
    reasons = F.concat(F.array_compact(F.array(*[F.when(c, r) for c, _, r in rules])), F.transform("_p.others", lambda f: F.concat(F.lit("anomaly:"), f)))
    df = df.withColumns({"abuse_penalty": F.round(F.greatest(product, F.lit(s.abuse_floor)), 4), "abuse_reasons": reasons})
    return df.drop("_p")


def weight_array(source_type: Column) -> Column:
    table = F.create_map(*[x for k, w in WEIGHTS.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in w]))])
    return F.coalesce(F.element_at(table, source_type), F.element_at(table, F.lit("blog")))


def fuse(scores: Column, confidence: Column, weights: Column) -> Column:
    """Confidence-weighted mean; 0.5 if nothing has weight."""
    eff = F.zip_with(weights, confidence, lambda w, c: w * c)
    top = F.aggregate(F.zip_with(eff, scores, lambda w, x: w * x), F.lit(0.0), lambda a, x: a + x)
    low = F.aggregate(eff, F.lit(0.0), lambda a, x: a + x)
    return F.when(low > 1e-9, top / low).otherwise(0.5)


def score(records: DataFrame, s: Settings = DEFAULT, language: Detector | None = by_function_words) -> DataFrame:
    """Adds anomaly_flags (unless there), sub_scores, confidence, weights, evidence, abuse_*, raw_score, penalized_score.

    Needs author, source_url, source_type, published_date, content, citations, view_count, like_count,
    duration_sec, pmid, doi, journal; no shuffle. Videos with a transcript (has_transcript, optional) get
    the flags of spoken texts too.
    """
    kind = F.col("source_type")
    df = records.withColumns({"source_type": F.when(kind.isin(*WEIGHTS), kind).otherwise("blog"), "content": F.coalesce("content", F.lit(""))})
    df = features.with_features(df)
    if "anomaly_flags" not in records.columns:
        found = anomaly.flags(F.col("content"), kind, s)
        if "has_transcript" in records.columns:
            spoken = F.coalesce(F.col("has_transcript"), F.lit(False)) & (kind == "youtube")
            found = F.concat(found, F.when(spoken, anomaly.transcript_flags(F.col("content"), lambda x: detect(x, language), s)).otherwise(F.array().cast("array<string>")))
        df = features.once(df, anomaly_flags=found)
    url, text = F.col("source_url"), F.col("content")
    df = features.once(
        df,
        _u=F.struct(
            netloc(url).alias("host"), domain_tier(url).alias("tier"), signals.is_spam_url(url).alias("spam"), age_days(parse_date(F.col("published_date")), s.as_of).alias("age")
        ),
    )
    host, tier, spam, age = (F.col(f"_u.{x}") for x in ("host", "tier", "spam", "age"))
    made = {
        "author_credibility": signals.author(F.col("author"), url, tier, spam),
        "citation_count": signals.citation(kind, F.col("citations"), F.col("view_count"), text),
        "domain_authority": signals.domain(url, host, tier, spam),
        "recency": signals.recency(F.col("published_date"), kind, s, age),
        "medical_disclaimer_presence": signals.disclaimer(text, kind, url, host, tier),
        "metadata_completeness": signals.metadata(kind),
        "content_depth": signals.depth(s),
        "engagement_authenticity": signals.engagement(F.col("view_count"), F.col("like_count"), kind, s),
        "adversarial_risk": signals.adversarial(text, s),
    }
    df = features.once(df, _s=F.struct(*[v.alias(k) for k, v in made.items()]))
    df = penalty(df, s)
    names = F.array(*[F.lit(n) for n in SIGNALS])
    part = lambda field: F.array(*[F.col(f"_s.{n}.{field}") for n in SIGNALS])
    df = features.once(df, _scores=part("score"), _conf=part("confidence"), _w=weight_array(kind))
    df = features.once(df, raw_score=fuse(F.col("_scores"), F.col("_conf"), F.col("_w")))
    df = df.withColumns(
        {
            "penalized_score": F.col("raw_score") * F.col("abuse_penalty"),
            "sub_scores": F.map_from_arrays(names, F.transform("_scores", lambda x: F.round(x, 3))),
            "confidence": F.map_from_arrays(names, F.transform("_conf", lambda x: F.round(x, 3))),
            "weights": F.map_from_arrays(names, "_w"),
            "evidence": F.map_from_arrays(names, part("evidence")),
        }
    )
    return df.drop("_scores", "_conf", "_w", "_s", "_u", *features.FEATURES)
