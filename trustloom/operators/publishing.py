"""From scored records to published ones: format, validate, reject, dedup, order, roll up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, SCHEMA_VERSION, Settings
from trustloom.functions.text import record_id, tier_name
from trustloom.operators import ranking

REQUIRED = (
    "record_id schema_version ingested_at source_url source_type author published_date language region topic_tags trust_score trust_tier "
    "content_chunks sub_scores confidence evidence weights abuse_penalty abuse_reasons anomaly_flags"
).split()


def canonical(df: DataFrame, ingested_at: str, s: Settings = DEFAULT, extra: tuple[str, ...] = ()) -> DataFrame:
    """The published columns with their defaults, source-specific ones (null for other sources), and those of ``extra``."""
    has = set(df.columns)
    take = lambda name, kind, default: F.coalesce(F.col(name), default) if name in has else default  # noqa: E731, ARG005
    kind, url = take("source_type", "string", F.lit("blog")), take("source_url", "string", F.lit(""))
    score = take("trust_score", "double", F.lit(0.0))
    strings = F.array().cast("array<string>")
    doubles = F.create_map().cast("map<string,double>")
    out = {
        "record_id": record_id(kind, url),
        "schema_version": F.lit(SCHEMA_VERSION),
        "ingested_at": F.lit(ingested_at),
        "source_url": url,
        "source_type": kind,
        "author": take("author", "string", F.lit("Unknown")),
        "published_date": take("published_date", "string", F.lit("Unknown")),
        "language": take("language", "string", F.lit("unknown")),
        "region": take("region", "string", F.lit("Unknown")),
        "topic_tags": take("topic_tags", "array", strings),
        "trust_score": score.cast("double"),
        "trust_tier": tier_name(score, s),
        "content_chunks": F.col("content_chunks"),
        "sub_scores": take("sub_scores", "map", doubles),
        "confidence": take("confidence", "map", doubles),
        "evidence": take("evidence", "map", F.create_map().cast("map<string,string>")),
        "weights": take("weights", "map", doubles),
        "abuse_penalty": take("abuse_penalty", "double", F.lit(1.0)),
        "abuse_reasons": take("abuse_reasons", "array", strings),
        "anomaly_flags": take("anomaly_flags", "array", strings),
        "prior_used": F.col("prior_used") if "prior_used" in has else F.lit(None).cast("double"),
    }
    only = {"pmid": ("pubmed", "string", ""), "doi": ("pubmed", "string", ""), "journal": ("pubmed", "string", ""), "view_count": ("youtube", "bigint", None), "like_count": ("youtube", "bigint", None), "duration_sec": ("youtube", "bigint", None), "has_transcript": ("youtube", "boolean", False)}
    for name, (source, t, default) in only.items():
        value = F.coalesce(F.col(name).cast(t), F.lit(default).cast(t)) if name in has else F.lit(default).cast(t)
        out[name] = F.when(kind == source, value)
    rest = [c for c in ("topic", "topic_idx", "seq", *extra) if c in has]
    return df.select(*rest, *[v.alias(k) for k, v in out.items()])


def error_of(df: DataFrame) -> Column:
    """The first check a record fails, as text; null for a valid one. Types are the schema's."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED if c in df.columns], *[F.lit(c) for c in REQUIRED if c not in df.columns]))
    col = lambda c: F.col(c) if c in df.columns else F.lit(None)
    out = F.when(F.size(missing) > 0, F.concat(F.lit("missing fields: "), F.array_join(F.array_sort(missing), ",")))
    if set(REQUIRED) - set(df.columns):
        return out
    in_unit = lambda c: c.between(0.0, 1.0)
    return (
        out.when(~in_unit(col("trust_score")), "trust_score out of range")
        .when(~in_unit(col("abuse_penalty")), "abuse_penalty out of range")
        .when(~col("source_type").isin("blog", "youtube", "pubmed"), "unknown source_type")
        .when(~col("trust_tier").isin("AUTHORITATIVE", "CREDIBLE", "UNCERTAIN", "UNRELIABLE"), "unknown trust_tier")
        .when(F.trim(col("source_url")) == "", "empty source_url")
        .when(F.size(col("content_chunks")) == 0, "no content_chunks")
        .when(F.exists(col("content_chunks"), lambda c: c["text"].isNull() | (F.trim(c["text"]) == "")), "chunk without text")
    )


def publish(records: DataFrame, s: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(published, invalid): low scores out, then invalid ones aside, then first of each id, first topic of each URL."""
    checked = records.where(F.col("trust_score") >= s.reject_below)
    checked = checked.withColumn("error", error_of(checked))
    valid = checked.where(F.col("error").isNull()).drop("error")
    valid = ranking.first_topic_only(ranking.dedup_records(valid, ["topic_idx", "seq"]))
    return valid.orderBy(F.desc("trust_score"), "source_url"), checked.where(F.col("error").isNotNull()).select("topic", "source_url", "error")


# --- rollups -----------------------------------------------------------------------------------------


def batch_stats(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("trust_score").alias("avg_trust"), F.min("trust_score").alias("min_trust"), F.max("trust_score").alias("max_trust"))


def tier_histogram(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys, "trust_tier").agg(F.count(F.lit(1)).alias("n"))


def positive_average(df: DataFrame, *keys: str) -> DataFrame:
    """Mean of the scores above 0."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("trust_score") > 0, F.col("trust_score"))).alias("avg_positive"))


def topic_rollup(df: DataFrame) -> DataFrame:
    """Counts by topic and source type, with a TOTAL row."""
    kinds = ("blog", "youtube", "pubmed")
    sums = df.rollup("topic").agg(F.grouping("topic").alias("g"), F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("source_type") == k).alias(k) for k in kinds], F.round(F.avg("trust_score"), 3).alias("avg_trust"))
    return sums.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("topic")).alias("topic"), "total", *kinds, "avg_trust")


def grand_totals(df: DataFrame) -> DataFrame:
    return df.cube("topic", "source_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("trust_score"), 3).alias("avg_trust"))


def audit(df: DataFrame) -> DataFrame:
    """By topic: records, sources, mean score, and how many schema versions are mixed."""
    return df.groupBy("topic").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("source_type").alias("source_types"), F.round(F.avg("trust_score"), 3).alias("avg_trust"), F.countDistinct("schema_version").alias("schema_versions")
    )


def total_words(chunks: Column) -> Column:
    return F.aggregate(chunks, F.lit(0), lambda a, c: a + c["word_count"])
