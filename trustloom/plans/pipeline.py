"""The whole batch as one plan: chunks, assembled content, tags, scores, priors, publication.

All topics are in one DataFrame with (topic, topic_idx, seq). Scored records are written once to the
shared folder. Priors, rejection, dedup and first-topic rules are decided on narrow rows (row number,
URL, score); their verdict joins the wide rows once, before the final order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions import chunking, trust
from trustloom.functions.features import once
from trustloom.functions.language import Detector, by_function_words, detect
from trustloom.functions.text import clean_text, netloc, region, tier_name, words
from trustloom.operators import priors, publishing, ranking, tagging
from trustloom.storage import checked, materialize

OPTIONAL = {"citations": "bigint", "view_count": "bigint", "like_count": "bigint", "duration_sec": "bigint", "has_transcript": "boolean", "pmid": "string", "doi": "string", "journal": "string", "language": "string", "title": "string"}


def enrich(records: DataFrame, taxonomy=tagging.TAXONOMY, s: Settings = DEFAULT, language: Detector | None = by_function_words) -> DataFrame:
    """Chunks (or the fallback chunk), content as scored, tags, language and region for (source_type, source_url, text) rows.

    Tags and language are read from title and text; a given language stays. Texts are cleaned whole.
    """
    df = records
    for name, kind in OPTIONAL.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    df = once(df.withColumnRenamed("text", "_raw_text"), text=clean_text(F.col("_raw_text"), None)).drop("_raw_text")
    floor = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in s.min_words.items() for x in kv]), F.col("source_type")), F.lit(s.min_words["blog"]))
    df = df.where(F.size(words(F.col("text"))) >= floor)
    df = chunking.chunk(df, "text", "_cc", s, "_body")
    some = F.size("_cc") > 0
    df = once(df, content_chunks=F.when(some, F.col("_cc")).otherwise(chunking.fallback_chunk(F.col("text"), F.col("source_type"), s)), content=F.when(some, F.col("_body")).otherwise(F.col("text")))
    df = df.drop("_cc", "_body")
    full = F.concat(F.coalesce(F.concat(F.col("title"), F.lit("\n\n")), F.lit("")), F.col("text"))
    df = once(df, _full=full)
    df = df.withColumns({"region": region(F.col("source_url")), "language": F.coalesce(F.col("language"), detect(F.col("_full"), language))})
    return tagging.with_tags(df, "_full", "topic_tags", taxonomy, s).drop("text", "_full", "title")


def run(
    records: DataFrame, ingested_at: str, state: DataFrame | None = None, taxonomy=tagging.TAXONOMY, s: Settings = DEFAULT, language: Detector | None = by_function_words
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(published, invalid, new prior state). Records: topic, topic_idx, seq, source_type, source_url, author, published_date, text, ...

    ``seq`` gives the order in which records move their domain's prior; rows with one ``seq`` are told
    apart by their place in the written table.
    """
    scored = trust.score(enrich(records, taxonomy, s, language), s, language)
    shape = publishing.canonical(scored.withColumn("trust_score", F.lit(0.0)), ingested_at, s, extra=("penalized_score",))
    shape = shape.withColumns({"domain": netloc(F.col("source_url")), "fault": publishing.error_of(shape), "row": F.monotonically_increasing_id()})
    wide, _ = materialize(shape, "scored")
    narrow = wide.select("row", "topic", "topic_idx", "seq", "source_url", "record_id", "domain", "fault", F.col("penalized_score").alias("penalized"))
    final, new_state = priors.apply_priors(narrow, state, s)
    judged = narrow.drop("domain", "penalized").join(final.select("row", "trust_score", "prior_used"), "row").where(F.col("trust_score") >= s.reject_below)
    judged, _ = materialize(judged, "judged")
    valid = ranking.first_topic_only(ranking.dedup_records(judged.where(F.col("fault").isNull()), ["topic_idx", "seq", "row"]))
    kept = materialize(valid.select("row", "trust_score", "prior_used"), "kept")
    published = wide.drop("trust_score", "trust_tier", "prior_used", "penalized_score", "domain", "fault").join(checked(kept), "row").drop("row")
    published = published.withColumn("trust_tier", tier_name(F.col("trust_score"), s)).orderBy(F.desc("trust_score"), "source_url")
    return published, judged.where(F.col("fault").isNotNull()).select("topic", "source_url", F.col("fault").alias("error")), new_state


def run_with_state(records: DataFrame, ingested_at: str, path: str, **options) -> tuple[DataFrame, DataFrame]:
    """``run`` from the priors saved at ``path``; the moved priors are saved before anything is published.

    (published, invalid). Scores are settled in tables by then, so a fault in publishing loses no prior.
    """
    published, invalid, state = run(records, ingested_at, priors.load_state(records.sparkSession, path), **options)
    priors.save_state(state, path)
    return published, invalid
