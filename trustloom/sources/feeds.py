"""Offline readers: RSS items, abstracts, video search results, saved manifests, topic expansions.

Live fetching is an adapter's work: anything that delivers the raw columns named here will do.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions import lexicons as L
from trustloom.functions.text import clean_text, clean_url, domain_tier, fallback_terms, safe_topic, strip, topic_slug, valid_url

RSS = "channel struct<item:array<struct<title:string,link:string,description:string,`content:encoded`:string,author:string,`dc:creator`:string,pubDate:string,`dc:date`:string,`atom:published`:string,`atom:updated`:string,published:string,updated:string>>>"


def plain(markup: Column) -> Column:
    """Markup of a feed's body as text with blank lines between elements."""
    text = F.regexp_replace(F.regexp_replace(markup, r"(?s)<(script|style)\b.*?</\1>", ""), r"\s*<[^>]+>\s*", "\n\n")
    for name, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(c))
    return strip(text)


def rss_items(feeds: DataFrame) -> DataFrame:
    """Items of (xml, source_name, tier_override, full_content, author_default) rows, one row each.

    Only <item> elements count. Unreadable feeds give no row.
    """
    parsed = feeds.withColumn("_f", F.from_xml("xml", RSS, {"mode": "PERMISSIVE"})).withColumn("_i", F.explode("_f.channel.item"))
    pick = lambda *names: F.coalesce(*[F.nullif(strip(F.col(f"_i.`{n}`")), F.lit("")) for n in names])
    url = clean_url(clean_text(F.col("_i.link")))
    body = F.coalesce(pick("content:encoded"), pick("description"), F.lit(""))
    items = parsed.select(
        "source_name",
        url.alias("url"),
        clean_text(F.col("_i.title")).alias("title"),
        F.coalesce(pick("dc:creator", "author"), F.col("author_default"), F.lit("Unknown")).alias("author"),
        F.coalesce(pick("pubDate", "dc:date", "atom:published", "atom:updated", "published", "updated"), F.lit("Unknown")).alias("date"),
        strip(F.regexp_replace(clean_text(plain(body)), L.READ_MORE, "")).alias("body"),
        F.coalesce(F.col("tier_override"), domain_tier(url)).alias("tier"),
        "full_content",
    )
    return items.where(valid_url(F.col("url")))


def route(feeds: DataFrame, category: str) -> DataFrame:
    """Feeds for every topic and those of a topic's category; each feed once."""
    return feeds.where(F.col("categories").isNull() | F.array_contains("categories", category)).dropDuplicates(["url"])


ABSTRACT = "PubmedArticle struct<MedlineCitation:struct<PMID:string,Article:struct<ArticleTitle:string,Abstract:struct<AbstractText:array<struct<_Label:string,_VALUE:string>>>>>>"


def abstracts(raw: DataFrame) -> DataFrame:
    """(pmid, abstract) of (pmid, xml) rows; labelled sections as "LABEL: text", a blank line between them."""
    parsed = raw.withColumn("_a", F.from_xml("xml", ABSTRACT))
    parts = F.transform("_a.PubmedArticle.MedlineCitation.Article.Abstract.AbstractText", lambda t: F.when(F.coalesce(t["_Label"], F.lit("")) != "", F.concat(t["_Label"], F.lit(": "), strip(t["_VALUE"]))).otherwise(strip(t["_VALUE"])))
    return parsed.select("pmid", F.coalesce(F.array_join(F.filter(parts, lambda p: p != ""), "\n\n"), F.lit("")).alias("abstract"))


def doi(article_ids: Column) -> Column:
    return F.coalesce(F.try_element_at(F.filter(article_ids, lambda a: a["idtype"] == "doi"), F.lit(1))["value"], F.lit(""))


def abstract_query(terms: Column, technical: Column, extra: Column) -> Column:
    """OR of the quoted terms, AND a filter for technical topics, abstracts only."""
    any_of = F.array_join(F.transform(F.array_distinct(terms), lambda t: F.concat(F.lit('"'), t, F.lit('"'))), " OR ")
    core = F.when(technical & (F.coalesce(extra, F.lit("")) != ""), F.concat(F.lit("(("), any_of, F.lit(") AND "), extra, F.lit(")"))).otherwise(F.concat(F.lit("("), any_of, F.lit(")")))
    return F.concat(core, F.lit(" AND hasabstract[Filter]"))


def video_queries(terms: Column) -> Column:
    """Search texts of a topic: five terms "explained", the first also "overview" and "guide"."""
    first = F.try_element_at(terms, F.lit(1))
    return F.array_compact(F.concat(F.transform(F.slice(terms, 1, 5), lambda t: F.concat(t, F.lit(" explained"))), F.array(F.concat(first, F.lit(" overview")), F.concat(first, F.lit(" guide")))))


def expand(topics: DataFrame, dimension: DataFrame | None = None, s: Settings = DEFAULT) -> DataFrame:
    """Terms and slugs of (topic) rows from a dimension table, else the topic's own words."""
    base = topics.withColumn("topic", safe_topic(F.col("topic"))).withColumn("key", F.lower(strip(F.col("topic"))))
    own = base.withColumns({"_terms": fallback_terms(F.col("topic")), "_slugs": F.array(F.replace(topic_slug(F.col("topic")), F.lit("_"), F.lit("-")))})
    if dimension is None:
        return own.select("topic", F.col("_terms").alias("terms"), F.col("_slugs").alias("slugs"), F.lit(False).alias("is_technical"), F.lit("").alias("pubmed_filter"))
    dim = dimension.withColumn("key", F.lower(strip(F.col("topic")))).drop("topic").where((F.size("terms") >= 3) & (F.size("slugs") >= 2))
    return own.join(dim, "key", "left").select(
        "topic", F.coalesce("terms", "_terms").alias("terms"), F.coalesce("slugs", "_slugs").alias("slugs"), F.coalesce("is_technical", F.lit(False)).alias("is_technical"), F.coalesce("pubmed_filter", F.lit("")).alias("pubmed_filter")
    )


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """Saved runs below ``root``/topics/*/scraped_data.json; unreadable ones are left out."""
    df = spark.read.option("multiLine", True).option("mode", "DROPMALFORMED").json(f"{root}/topics/*/scraped_data.json")
    return df.withColumn("topic_dir", F.regexp_extract(F.input_file_name(), r"/topics/([^/]+)/", 1))


def _states(threshold: int, open_seconds: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, fails, opened = None, 0, None
        for batch in batches:
            out = []
            for host, ts, ok in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if host != at:
                    at, fails, opened = host, 0, None
                state = "CLOSED" if opened is None else "OPEN" if ts - opened <= open_seconds else "HALF_OPEN"
                if state != "OPEN":
                    fails, opened = (0, None) if ok else (fails + 1, opened)
                    if fails >= threshold:
                        opened = ts
                out.append(state)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["host", "ts", "state"])

    return run


def breaker(attempts: DataFrame, threshold: int = 3, open_seconds: float = 30.0) -> DataFrame:
    """Circuit states over a log (host, ts, ok): per host, the state met by each attempt.

    CLOSED until ``threshold`` failures in a row, then OPEN for ``open_seconds``, then HALF_OPEN until an outcome.
    A host's attempts depend on each other, so a task reads its sorted hosts in batches and carries one state.
    """
    log = attempts.select("host", F.col("ts").cast("double").alias("ts"), F.coalesce(F.col("ok"), F.lit(False)).alias("ok"))
    ordered = log.repartition("host").sortWithinPartitions("host", "ts", "ok")
    return ordered.mapInArrow(_states(threshold, open_seconds), "host string, ts double, state string")


def backoff_bounds(attempt: Column, s: Settings = DEFAULT) -> Column:
    """(least, most) seconds to wait before a repeated request: base to the power of the attempt, give or take the jitter."""
    wait = F.pow(F.lit(s.backoff_base), attempt)
    bound = lambda sign: F.greatest(F.lit(s.backoff_floor), wait * (1 + sign * s.backoff_jitter))
    return F.struct(bound(-1).alias("least"), bound(1).alias("most"))
