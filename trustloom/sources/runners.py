"""The three sources as plans: from candidate tables to scraped records, one topic table for all.

Fetching is an adapter's work. Each runner takes what an adapter delivers (feed items and pages; search
results, video statistics and transcripts; summaries and abstracts) with a ``topic`` column, joins it,
filters it and takes the best of each topic. ``seq`` is a candidate's place in its topic's list.

Greedy selection ("skip a source that is already in, stop at the target") equals a window over the rows
that pass the filters, as no filter looks at what was selected before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions import lexicons as L
from trustloom.functions.language import Detector, by_function_words, detect
from trustloom.functions.text import cap_words, clean_text, record_id, seconds_of, words
from trustloom.operators import ranking, relevance
from trustloom.sources.feeds import doi

#: Columns of a scraped record.
RECORD = {
    "topic": "string", "topic_idx": "int", "seq": "bigint", "source_type": "string", "source_url": "string", "author": "string", "published_date": "string",
    "language": "string", "title": "string", "text": "string", "citations": "bigint", "view_count": "bigint", "like_count": "bigint", "duration_sec": "bigint",
    "has_transcript": "boolean", "pmid": "string", "doi": "string", "journal": "string",
}
#: Order of the sources inside a topic.
KINDS = ("blog", "youtube", "pubmed")
_STRIDE = 1000


def feed_table(spark: SparkSession) -> DataFrame:
    """The feeds of the article source; ``categories`` is null for feeds of every topic."""
    cols = "name string, url string, slug_based boolean, full_content boolean, tier_override int, author_default string, categories array<string>"
    return spark.createDataFrame(L.FEEDS, cols)


def _records(df: DataFrame, kind: str, order: list, language: Detector | None) -> DataFrame:
    """Selected rows in the shape of ``RECORD``; ``seq`` orders topics, sources and places."""
    place = F.row_number().over(W.partitionBy("topic").orderBy(*order))
    out = df.withColumns({"_place": place, "source_type": F.lit(kind), "language": detect(F.concat(F.col("title"), F.lit("\n\n"), F.col("text")), language)})
    seq = (F.col("topic_idx").cast("bigint") * len(KINDS) + KINDS.index(kind)) * _STRIDE + F.col("_place")
    out = out.withColumn("seq", seq)
    return out.select(*[(F.col(c) if c in out.columns else F.lit(None)).cast(t).alias(c) for c, t in RECORD.items()])


def _relevant(title: Column, text: Column, s: Settings) -> Column:
    return relevance.relevant(F.concat(title, F.lit("\n\n"), text), F.col("topic"), F.col("terms"), s=s)


def good_item(s: Settings = DEFAULT) -> Column:
    """A feed item that would be selected by itself: a whole article, long enough and relevant."""
    body = F.col("body")
    return F.col("full_content") & (F.size(words(body)) >= s.blog_body_words) & relevance.relevant(F.concat(F.col("title"), F.lit(" "), body), F.col("topic"), F.col("terms"), s=s)


def preview_passes(s: Settings = DEFAULT) -> Column:
    """A preview of ten words or more must be relevant; a shorter one says nothing."""
    seen = F.size(words(F.col("body"))) >= s.preview_words
    return ~seen | relevance.relevant(F.concat(F.col("title"), F.lit(" "), F.col("body")), F.col("topic"), F.col("terms"), s=s)


def blog_records(items: DataFrame, topics: DataFrame, articles: DataFrame | None = None, s: Settings = DEFAULT, language: Detector | None = by_function_words) -> DataFrame:
    """Feed items (topic, seq, url, title, author, date, body, tier, full_content) to records.

    ``topics``: topic, topic_idx, terms. ``articles``: url, article, article_date of fetched pages, used
    where a preview is short or a date is missing.
    """
    df = ranking.keep_first(items, F.concat(F.col("topic"), F.lit("\n"), F.col("url")), ["seq"]).join(topics.select("topic", "topic_idx", "terms"), "topic")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    df = df.withColumns({c: text(c) for c in ("title", "body", "date")}).withColumn("full_content", F.coalesce("full_content", F.lit(False)))
    df = df.where(preview_passes(s) & relevance.has_anchor(F.col("title"), F.col("topic")))
    if articles is not None:
        df = df.join(ranking.keep_first(articles.select("url", "article", "article_date"), F.col("url"), ["article"]), "url", "left")
    else:
        df = df.withColumns({"article": F.lit(None).cast("string"), "article_date": F.lit(None).cast("string")})
    n = F.size(words(F.col("body")))
    thin = (n < s.blog_body_words) & ~F.col("full_content")
    dateless = F.lower(F.trim("date")).isin(*L.MISSING_DATES) & (F.coalesce("article_date", F.lit("")) != "") & (thin | F.col("full_content"))
    longer = thin & (F.size(words(text("article"))) > n)
    df = df.withColumns({"text": cap_words(F.when(longer, F.col("article")).otherwise(F.col("body")), s.blog_max_words), "published_date": F.when(dateless, F.col("article_date")).otherwise(F.col("date"))})
    df = df.where((F.size(words(F.col("text"))) >= s.min_words["blog"]) & _relevant(F.col("title"), F.col("text"), s))
    order = [F.desc("tier"), "seq"]
    df = ranking.diverse(df.withColumn("source_url", F.col("url")), order, ["topic"], s)
    return _records(df, "blog", order, language)


def video_stats(raw: DataFrame) -> DataFrame:
    """Statistics of (id, statistics map, duration, description, channel) rows; absent likes are hidden ones, so null."""
    return raw.where(F.coalesce("id", F.lit("")) != "").select(
        F.col("id").alias("video_id"),
        F.coalesce(F.try_element_at("statistics", F.lit("viewCount")).try_cast("bigint"), F.lit(0).cast("bigint")).alias("view_count"),
        F.try_element_at("statistics", F.lit("likeCount")).try_cast("bigint").alias("like_count"),
        seconds_of(F.coalesce("duration", F.lit(""))).cast("bigint").alias("duration_sec"),
        clean_text(F.col("description")).alias("full_description"),
        clean_text(F.col("channel")).alias("channel_title"),
    )


def pick_transcript(rows: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """(video_id, transcript) of (video_id, place, language, transcript): English if there is one, else the first."""
    best = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in s.transcript_languages]), F.col("language")), F.lit(0))
    order = F.struct(F.when(best > 0, best).otherwise(F.lit(1 << 30)), F.col("place"))
    return rows.where(F.coalesce("transcript", F.lit("")) != "").groupBy("video_id").agg(clean_text(F.min_by("transcript", order)).alias("transcript"))


def video_candidates(found: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """First result of each video and each channel of a topic, 20 a topic.

    Search results: topic, seq, video_id, channel_id, channel, title, description, published. A channel is
    closed by its first video that stays, so channels follow after videos.
    """
    named = found.where(F.coalesce("video_id", F.lit("")) != "")
    videos = ranking.keep_first(named, F.concat_ws("\n", "topic", "video_id"), ["seq"])
    channel = F.when(F.coalesce("channel_id", F.lit("")) != "", F.concat_ws("\n", "topic", "channel_id"))
    own = ranking.keep_first(videos, channel, ["seq"])
    return ranking.top_k(own, ["topic"], ["seq"], s.youtube_candidates).drop("rank").withColumns({c: clean_text(F.col(c)) for c in ("channel", "title", "description")}).withColumn(
        "published", F.substring(F.coalesce("published", F.lit("")), 1, 10)
    )


def video_records(
    found: DataFrame, stats: DataFrame, transcripts: DataFrame, topics: DataFrame, s: Settings = DEFAULT, language: Detector | None = by_function_words
) -> DataFrame:
    """Search results, ``video_stats`` and ``pick_transcript`` to records; a video without statistics stays."""
    df = video_candidates(found, s).join(topics.select("topic", "topic_idx", "terms"), "topic").join(stats.dropDuplicates(["video_id"]), "video_id", "left")
    df = ranking.two_phase_top(df, transcripts, s.youtube_total)
    about = F.coalesce(F.nullif(F.col("full_description"), F.lit("")), F.col("description"))
    spoken = F.col("transcript") != ""
    df = df.withColumns({"text": F.when(spoken, F.trim(F.concat(about, F.lit("\n\n"), F.col("transcript")))).otherwise(about), "has_transcript": spoken})
    df = df.where((F.size(words(F.concat(F.col("title"), F.lit("\n\n"), F.col("text")))) >= s.min_words["youtube"]) & _relevant(F.col("title"), F.col("text"), s))
    df = ranking.top_k(df.withColumnRenamed("rank", "_score"), ["topic"], [F.desc("_score"), "seq"], s.youtube_total)
    df = df.withColumns(
        {
            "source_url": F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("video_id")),
            "author": F.coalesce(F.nullif(F.col("channel_title"), F.lit("")), F.col("channel")),
            "published_date": F.col("published"),
        }
    )
    return _records(df, "youtube", ["rank"], language)


def abstract_records(found: DataFrame, summaries: DataFrame, abstracts: DataFrame, topics: DataFrame, s: Settings = DEFAULT, language: Detector | None = by_function_words) -> DataFrame:
    """Search results (topic, seq, pmid), summaries by pmid and abstracts to records, best journals first.

    Summaries: pmid, title, fulljournalname, source, pubdate, authors array<struct<name>>, articleids
    array<struct<idtype, value>>. An id without a summary goes; of one DOI the first that passes stays.
    """
    ids = ranking.top_k(ranking.keep_first(found.where(F.coalesce("pmid", F.lit("")) != ""), F.concat_ws("\n", "topic", "pmid"), ["seq"]), ["topic"], ["seq"], s.pubmed_candidates).drop("rank")
    df = ids.join(topics.select("topic", "topic_idx", "terms"), "topic").join(summaries.dropDuplicates(["pmid"]), "pmid").join(abstracts.select("pmid", "abstract").dropDuplicates(["pmid"]), "pmid", "left")
    names = F.array_join(F.filter(F.transform("authors", lambda a: a["name"]), lambda x: F.coalesce(x, F.lit("")) != ""), ", ")
    journal = F.coalesce(F.nullif(F.col("fulljournalname"), F.lit("")), F.col("source"))
    df = df.withColumns(
        {
            "text": F.coalesce("abstract", F.lit("")),
            "_journal": clean_text(journal),
            "_score": ranking.journal_score(journal, F.col("pubdate")),
            "title": clean_text(F.coalesce("title", F.lit("Unknown"))),
            "author": F.when(F.coalesce(F.size("authors"), F.lit(0)) > 0, clean_text(names)).otherwise("Unknown"),
            "published_date": clean_text(F.coalesce("pubdate", F.lit("Unknown"))),
            "_doi": clean_text(doi(F.col("articleids"))),
        }
    )
    df = df.where((F.size(words(F.col("text"))) >= s.min_words["pubmed"]) & _relevant(F.col("title"), F.col("text"), s))
    order = [F.desc("_score"), "seq"]
    df = ranking.keep_first(df, F.when(F.col("_doi") != "", F.concat_ws("\n", "topic", "_doi")), order)
    df = ranking.top_k(df, ["topic"], order, s.pubmed_total)
    df = df.withColumns({"journal": F.col("_journal"), "doi": F.col("_doi"), "citations": ranking.citation_proxy(F.col("_journal")), "source_url": F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), F.col("pmid"), F.lit("/"))})
    return _records(df, "pubmed", ["rank"], language)


def all_records(*sources: DataFrame) -> DataFrame:
    """The sources' records as one table. Their order is in ``seq``."""
    out = sources[0]
    for x in sources[1:]:
        out = out.unionByName(x)
    return out


def missing_from(records: DataFrame, published: DataFrame) -> DataFrame:
    """Records whose id is not published: what validation, rejection and dedup took out."""
    keyed = records.withColumn("record_id", record_id(F.col("source_type"), F.col("source_url")))
    return keyed.join(published.select("record_id"), "record_id", "left_anti")
