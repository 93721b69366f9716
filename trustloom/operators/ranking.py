"""Keep-first dedup, diversity caps, composite ranks and top-k, as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions import lexicons as L
from trustloom.functions.stats import let
from trustloom.functions.text import diversity_key, domain_tier, listed, netloc, words


def keep_first(df: DataFrame, key: Column, order: list) -> DataFrame:
    """The first row of each key; rows with an empty key all stay.

    An aggregation of the smallest order and a join would cost a second pass; the window sorts inside
    a partition and Spark's group limit drops later rows of a key before the shuffle.
    """
    keyed = df.withColumn("_k", F.coalesce(key, F.lit("")))
    first = keyed.where(F.col("_k") != "").withColumn("_r", F.row_number().over(W.partitionBy("_k").orderBy(*order))).where("_r = 1").drop("_r")
    return first.unionByName(keyed.where(F.col("_k") == "")).drop("_k")


def dedup_records(df: DataFrame, order: list) -> DataFrame:
    return keep_first(df, F.col("record_id"), order)


def dedup_channels(df: DataFrame, order: list) -> DataFrame:
    """One video a channel; videos without a channel are told apart by their id."""
    return keep_first(df, F.coalesce(F.nullif(F.col("channel_id"), F.lit("")), F.col("video_id")), order)


def first_topic_only(df: DataFrame) -> DataFrame:
    """A URL belongs to the first topic that has it; repetitions inside that topic stay."""
    firsts = df.groupBy("source_url").agg(F.min("topic_idx").alias("_first"))
    return df.join(firsts, "source_url").where(F.col("topic_idx") == F.col("_first")).drop("_first")


def diverse(df: DataFrame, order: list, partition: list | None = None, s: Settings = DEFAULT) -> DataFrame:
    """One row a diversity key, at most ``blog_per_domain`` a domain and ``blog_total`` a topic, in ``order``."""
    part = partition or []
    rn = lambda keys: F.row_number().over(W.partitionBy(*part, *keys).orderBy(*order))
    out = df.withColumns({"_key": diversity_key(F.col("source_url")), "_domain": netloc(F.col("source_url"))})
    out = out.withColumn("_r", rn(["_key"])).where("_r = 1")
    out = out.withColumn("_r", rn(["_domain"])).where(F.col("_r") <= s.blog_per_domain)
    if part:
        out = out.withColumn("_r", rn([])).where(F.col("_r") <= s.blog_total)
    else:
        out = out.orderBy(*order).limit(s.blog_total)
    return out.drop("_r", "_key", "_domain")


def by_tier(url: Column, *ties) -> list:
    """Order by domain tier, best first, then the given ties."""
    return [domain_tier(url).desc(), *ties]


def video_rank(views: Column, text: Column, terms: Column, transcript: Column, duration: Column) -> Column:
    """log10(views)/6, times term density in [0.05, 1], times bonuses for a transcript and for length.

    ``text`` is title and description; terms of several words never equal one of its words.
    """

    def density(w: Column) -> Column:
        hits = F.aggregate(terms, F.lit(0), lambda a, t: a + F.size(F.filter(w, lambda x: x == F.lower(t))))
        return F.greatest(F.least(hits / F.greatest(F.size(w), F.lit(1)) * 100, F.lit(1.0)), F.lit(0.05))

    reach = F.log10(F.greatest(F.coalesce(views, F.lit(0)), F.lit(1)).cast("double")) / 6.0
    bonus = F.when(F.coalesce(transcript, F.lit("")) != "", 1.2).otherwise(1.0) * F.when(F.coalesce(duration, F.lit(0)) > 300, 1.1).otherwise(1.0)
    return reach * let(words(F.lower(text)), density) * bonus


def long_enough(duration: Column, least: int = DEFAULT.video_min_seconds) -> Column:
    """Not a short clip; an unknown length passes."""
    d = F.coalesce(duration, F.lit(least))
    return ~((d > 0) & (d < least))


def two_phase_top(candidates: DataFrame, transcripts: DataFrame, k: int = DEFAULT.youtube_total, factor: int = 3) -> DataFrame:
    """By topic: rank, take transcripts only for the best k * factor, rank again; adds transcript and rank.

    Candidates: topic, seq (their order, which settles ties), video_id, title, description, terms,
    view_count, duration_sec. Short clips go. All candidates come back; the final cut is the caller's,
    after its filters.
    """
    none = F.lit("")
    rank = lambda t: video_rank(F.col("view_count"), F.concat(F.coalesce("title", none), F.lit(" "), F.coalesce("description", none)), F.col("terms"), t, F.col("duration_sec"))
    first = candidates.where(long_enough(F.col("duration_sec"))).withColumn("_r", rank(none))
    first = first.withColumn("_n", F.row_number().over(W.partitionBy("topic").orderBy(F.desc("_r"), "seq")))
    second = first.join(transcripts.select("video_id", F.col("transcript").alias("_t")), "video_id", "left")
    second = second.withColumn("transcript", F.when(F.col("_n") <= k * factor, F.coalesce("_t", none)).otherwise(none))
    return second.withColumn("rank", rank(F.col("transcript"))).drop("_r", "_n", "_t")


def is_listed(journal: Column) -> Column:
    """Whether the name of a journal that ranks first is a part of the given one."""
    name = F.lower(F.coalesce(journal, F.lit("")))
    return F.exists(listed(L.JOURNALS), lambda j: F.contains(name, j))


def journal_score(journal: Column, pubdate: Column) -> Column:
    """2 for a listed journal, plus a quarter for each year after 2015."""
    year = F.substring(pubdate, 1, 4).try_cast("int")
    return F.when(is_listed(journal), 2.0).otherwise(0.0) + F.greatest(F.lit(0.0), F.coalesce((year - 2015) * 0.25, F.lit(0.0)))


def citation_proxy(journal: Column) -> Column:
    """Citations to assume, as summaries give none: 110 for a listed journal, else 5."""
    return F.when(is_listed(journal), 110).otherwise(5)


def top_k(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
