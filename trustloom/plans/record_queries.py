"""Queries over records: sources, chunks as scored, signals, penalties, validation, publication."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustloom.config import DEFAULT
from trustloom.functions import anomaly, chunking, features, language, signals, text, trust
from trustloom.functions import lexicons as L
from trustloom.operators import priors, publishing, ranking
from trustloom.plans import pipeline
from trustloom.plans.queries import record_view
from trustloom.plans.registry import WHITE, query, split_sql, strip_sql, t, texts, values
from trustloom.sources import feeds, html, runners, sinks

_stop = "[" + ", ".join(f"'{w}'" for w in L.CHUNK_STOP_WORDS) + "]"
_S = DEFAULT

#: Sentences, greedy packing, cuts of long sentences, overlap and quality, as one recursion over sentences.
_CHUNKS = f"""
RECURSIVE a AS (SELECT doc_id, {strip_sql("coalesce(text, '')")} AS t FROM documents),
m AS (SELECT doc_id, unnest(list_filter(string_split(regexp_replace(t, '([.!?])({WHITE}+)', '\\1' || chr(31) || chr(30), 'g'), chr(31) || chr(30)), lambda x: x <> '')) AS s FROM a),
s AS (SELECT doc_id, {strip_sql("s")} AS s, row_number() OVER () AS g FROM m), s2 AS (SELECT doc_id, s, {split_sql("s")} AS w, row_number() OVER (PARTITION BY doc_id ORDER BY g) AS i FROM s),
n AS (SELECT doc_id, i, s, w, len(w) AS n FROM s2),
r AS (SELECT doc_id, i, CASE WHEN n > {_S.chunk_max_words} THEN 0 ELSE n END AS open, 1 AS grp FROM n WHERE i = 1
 UNION ALL SELECT n.doc_id, n.i, CASE WHEN n.n > {_S.chunk_max_words} THEN 0 WHEN r.open > 0 AND r.open + n.n <= {_S.chunk_max_words} THEN r.open + n.n ELSE n.n END,
 r.grp + CASE WHEN n.n <= {_S.chunk_max_words} AND r.open > 0 AND r.open + n.n <= {_S.chunk_max_words} THEN 0 ELSE 1 END FROM r JOIN n ON n.doc_id = r.doc_id AND n.i = r.i + 1),
p AS (SELECT n.doc_id, grp, 1 AS part, string_agg(s, ' ' ORDER BY n.i) AS t FROM n JOIN r USING (doc_id, i) WHERE n.n <= {_S.chunk_max_words} GROUP BY n.doc_id, grp
 UNION ALL SELECT doc_id, grp, k AS part, array_to_string(w[k:k + {_S.chunk_max_words - 1}], ' ') AS t FROM (SELECT n.doc_id, grp, w, unnest(range(1, n.n + 1, {_S.chunk_max_words})) AS k FROM n JOIN r USING (doc_id, i) WHERE n.n > {_S.chunk_max_words})),
raw AS (SELECT doc_id, t, w, row_number() OVER (PARTITION BY doc_id ORDER BY grp, part) AS k FROM (SELECT *, {split_sql("t")} AS w FROM p) WHERE len(w) >= {_S.chunk_min_words}),
o AS (SELECT doc_id, k, k > 1 AS has_overlap, t, w, lag(w) OVER (PARTITION BY doc_id ORDER BY k) AS b FROM raw),
x AS (SELECT doc_id, k, has_overlap, CASE WHEN k = 1 THEN t ELSE array_to_string(b[-{_S.chunk_overlap}:], ' ') || ' ' || t END AS t, CASE WHEN k = 1 THEN w ELSE b[-{_S.chunk_overlap}:] || w END AS w FROM o),
l AS (SELECT doc_id, k, has_overlap, t, w, list_transform(w, lambda y: lower(y)) AS lw FROM x),
c AS (SELECT doc_id, k, unnest(list_filter(lw, lambda y: regexp_full_match(y, '\\p{{L}}+') AND NOT list_contains({_stop}, y))) AS y FROM l),
d AS (SELECT doc_id, k, max(m) AS top, sum(m) AS cw FROM (SELECT doc_id, k, y, count(*) AS m FROM c GROUP BY ALL) GROUP BY ALL),
q AS (SELECT l.doc_id, l.k, has_overlap, t, w, round(len(list_distinct(lw)) / len(lw)::DOUBLE * 0.5 + CASE WHEN regexp_matches(t, '([.!?]|\\.")$') THEN 1.0 ELSE 0.5 END * 0.3 + CASE WHEN top / cw::DOUBLE > 0.10 THEN 0.0 ELSE 1.0 END * 0.2, 3) AS quality_score
 FROM l LEFT JOIN d ON d.doc_id = l.doc_id AND d.k = l.k),
kept AS (SELECT doc_id, t AS text, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS chunk_index, count(*) OVER (PARTITION BY doc_id) AS total_chunks, quality_score, has_overlap, w FROM q WHERE quality_score >= {_S.chunk_quality})"""


@query(f"WITH {_CHUNKS} SELECT doc_id, text, chunk_index::INT AS chunk_index, total_chunks::INT AS total_chunks, round(quality_score, 3) AS quality_score, has_overlap, len(w)::INT AS word_count FROM kept")
def chunks(spark, sf):
    df = chunking.chunk(texts(spark, sf, "documents", "doc_id", "text"))
    return df.select("doc_id", F.explode("content_chunks").alias("c")).select("doc_id", "c.*")


@query(f"""
WITH {_CHUNKS}, j AS (SELECT doc_id, count(*) AS n, string_agg(CASE WHEN has_overlap AND len(w) > {_S.chunk_overlap} THEN array_to_string(w[{_S.chunk_overlap + 1}:], ' ') ELSE text END, chr(10) || chr(10) ORDER BY chunk_index) AS content, sum(len(w)) AS words FROM kept GROUP BY doc_id)
SELECT a.doc_id, coalesce(n, 1)::INT AS n_chunks, md5(coalesce(content, a.t)) AS content_md5, coalesce(words, len({split_sql("a.t")}))::INT AS total_words FROM a LEFT JOIN j USING (doc_id)""")
def scored_content(spark, sf):
    """Content as it is scored: chunks without their overlaps; the text where the chunker gave none."""
    df = texts(spark, sf, "documents", "doc_id", "text").withColumn("text", text.strip(F.coalesce("text", F.lit(""))))
    df = chunking.chunk(df)
    some = F.when(F.size("content_chunks") > 0, F.col("content_chunks")).otherwise(chunking.fallback_chunk(F.col("text"), F.lit("blog")))
    df = features.once(df, some=some)
    return df.select("doc_id", F.size("some").alias("n_chunks"), F.md5(chunking.assemble(F.col("some")).cast("binary")).alias("content_md5"), publishing.total_words(F.col("some")).alias("total_words"))


# --- signals of all documents ------------------------------------------------------------------------

_VIEW = """v AS (SELECT doc_id, text, lang, source, ['blog', 'youtube', 'pubmed'][doc_id % 3 + 1] AS kind, doc_id * 37 % 5000 AS views,
['www.nih.gov', 'medium.com', 'blog.example.org', 'news.bbc.co.uk', 'top10tricks.example.com', 'arxiv.org', 'www.youtube.com'][doc_id % 7 + 1] AS host FROM documents)"""
_EVIDENCE = L.EVIDENCE.replace("(?iU)", "(?i)")


@query(f"""
WITH {_VIEW}, e AS (SELECT *, len(regexp_extract_all(text, '{_EVIDENCE}')) AS hits FROM v)
SELECT doc_id, CASE WHEN kind = 'pubmed' THEN 0.4 WHEN views > 0 THEN round(least(log10(views) / 6.0, 1.0), 4) WHEN length(text) > 0 THEN round(least(hits / 8.0, 1.0), 4) ELSE 0.35 END::DOUBLE AS citation,
CASE WHEN kind = 'pubmed' THEN 0.3 WHEN views > 0 THEN 0.65 WHEN length(text) > 0 THEN 0.55 ELSE 0.3 END::DOUBLE AS citation_confidence,
CASE WHEN host IN ('www.nih.gov', 'arxiv.org') THEN 0.95 WHEN host IN ('medium.com', 'news.bbc.co.uk', 'www.youtube.com') THEN 0.62 WHEN host = 'top10tricks.example.com' THEN 0.12 ELSE 0.38 END::DOUBLE AS domain,
CASE WHEN host IN ('www.nih.gov', 'arxiv.org') THEN 0.92 WHEN host IN ('medium.com', 'news.bbc.co.uk', 'www.youtube.com') THEN 0.80 WHEN host = 'top10tricks.example.com' THEN 0.85 ELSE 0.50 END::DOUBLE AS domain_confidence,
CASE WHEN host IN ('www.nih.gov', 'arxiv.org') THEN 0.72 ELSE 0.52 END::DOUBLE AS author FROM e""")
def record_signals(spark, sf):
    r = record_view(spark, sf)
    url = F.col("source_url")
    c, d, a = signals.citation(F.col("source_type"), F.lit(None).cast("bigint"), F.col("view_count"), F.col("text")), signals.domain(url), signals.author(F.col("author"), url)
    return r.select(F.col("seq").alias("doc_id"), c["score"].alias("citation"), c["confidence"].alias("citation_confidence"), d["score"].alias("domain"), d["confidence"].alias("domain_confidence"), a["score"].alias("author"))


@query(f"""
WITH w AS (SELECT doc_id, length(text) AS n, {split_sql("lower(substr(coalesce(text, ''), 1, 2000))")} AS w FROM documents),
c AS (SELECT doc_id, n, list_transform([{", ".join("[" + ", ".join(f"'{x}'" for x in ws) + "]" for ws in language.FUNCTION_WORDS.values())}], lambda ws: len(list_filter(w, lambda x: list_contains(ws, x)))) AS c FROM w)
SELECT doc_id, CASE WHEN n >= 20 AND list_max(c) > 0 THEN [{", ".join(f"'{k}'" for k in language.FUNCTION_WORDS)}][list_position(c, list_max(c))] ELSE 'en' END AS code FROM c""")
def language_codes(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text").select("doc_id", language.detect(F.col("text")).alias("code"))


@query("""
WITH s AS (SELECT conv_id, turn, text, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS n, len(regexp_extract_all(text, '\\[[^\\]]{1,30}\\]')) AS noise,
list_filter(list_transform(string_split_regex(text, '[.!?]+'), lambda x: lower(regexp_replace(x, '^\\s+|\\s+$', '', 'g'))), lambda x: x <> '') AS s FROM conversations),
r AS (SELECT *, CASE WHEN len(s) >= 4 THEN len(list_filter(range(2, len(s) + 1), lambda i: s[i] = s[i - 1])) / (len(s) - 1)::DOUBLE ELSE 0 END AS rep FROM s)
SELECT conv_id, turn, CASE WHEN length(text) < 50 THEN '' ELSE concat_ws(';', CASE WHEN noise / greatest(n, 1)::DOUBLE > 0.15 THEN printf('transcript_high_noise:%.2f', noise / greatest(n, 1)::DOUBLE) END, CASE WHEN rep > 0.25 THEN printf('transcript_repetition:%.2f', rep) END) END AS flags FROM r""")
def transcript_quality(spark, sf):
    return t(spark, sf, "conversations").select("conv_id", "turn", F.array_join(anomaly.transcript_flags(F.col("text")), ";").alias("flags"))


_TALK = [
    (1, "the cat and the dog are in that house with this man " * 12 + "der hund und die katze ist das ein mit auf sich den von nicht " * 40),
    (2, "[Music] [Applause] hello there my friends and welcome to the show [Laughter] thanks"),
    (3, "Go on. Go on. Go on. Go on. And so the story of the river ends here today."),
    (4, "short"),
]


@query("SELECT * FROM (VALUES (1, 'transcript_language_inconsistency:0.25'), (2, 'transcript_high_noise:0.23'), (3, 'transcript_repetition:0.75'), (4, '')) AS v(id, flags)")
def transcript_flags(spark, sf):
    df, _ = values(spark, "id int, text string", _TALK)
    return df.select("id", F.array_join(anomaly.transcript_flags(F.col("text"), language.detect), ";").alias("flags"))


_RULES = [
    (1, "blog", "Unknown", "https://x.org/a", "A cure for cancer", "2026-01-01", None),
    (2, "blog", "Jo", "https://x.org/top10-best5", "Gardens", "2026-01-01", None),
    (3, "blog", "Jo", "https://x.org/big-pharma-hides-it", "Gardens", "2026-01-01", None),
    (4, "blog", "Jo", "https://x.org/a", "Cancer treatment", "2020-01-01", None),
    (5, "pubmed", "", "https://x.org/a", "Cancer treatment", "2020-01-01", None),
    (6, "blog", "Jo", "https://cheap.blogspot.com/a", "Cancer treatment", "2026-01-01", None),
    (7, "blog", "Jo", "https://x.org/a", "Gardens", "2026-01-01", "thin_content;excessive_caps;keyword_stuffing:a:0.9"),
    (8, "blog", "Jo", "https://x.org/a", "spam " * 100, "2026-01-01", None),
    (9, "blog", None, "https://x.blogspot.com/top1-best2-miracle", "cancer", "2019-01-01", ";".join(f"f{i}" for i in range(40))),
]
_MANY = ";".join(f"anomaly:f{i}" for i in range(40))


@query(f"""
SELECT id, penalty::DOUBLE AS penalty, reasons FROM (VALUES (1, 0.7, 'anonymous_health_content'), (2, 0.75, 'seo_spam_url:2_patterns'), (3, 0.65, 'conspiracy_url_slug:1_patterns'), (4, 0.82, 'outdated_health_content'), (5, 1.0, ''),
(6, 0.75, 'low_authority_health'), (7, 0.81, 'anomaly:thin_content;anomaly:excessive_caps'), (8, 0.8, 'keyword_stuffing:spam:1.000:threshold:0.450'),
(9, 0.05, 'anonymous_health_content;seo_spam_url:3_patterns;outdated_health_content;low_authority_health;{_MANY}')) AS v(id, penalty, reasons)""")
def penalty_rules(spark, sf):
    df, _ = values(spark, "id int, source_type string, author string, source_url string, content string, published_date string, flags string", _RULES)
    df = df.withColumn("anomaly_flags", F.when(F.col("flags").isNull(), F.array().cast("array<string>")).otherwise(F.split("flags", ";")))
    return trust.penalty(features.with_features(df)).select("id", F.col("abuse_penalty").alias("penalty"), F.array_join("abuse_reasons", ";").alias("reasons"))


# --- sources -----------------------------------------------------------------------------------------

_SUN = "Solar power from a roof is cheap and solar power is clean. "
_TOPICS = [("solar power", 0, ["solar power", "solar"]), ("mental health", 1, ["mental health"])]
_ITEMS = [
    ("solar power", 1, "https://a.org/1", "Solar power at home", "Ann", "2026-01-01", _SUN * 8, 1, True),
    ("solar power", 2, "https://a.org/1", "Solar power at home again", "Ann", "2026-01-01", _SUN * 8, 1, True),
    ("solar power", 3, "https://a.org/2", "Solar power at work", "Ann", "2026-01-01", _SUN * 8, 1, True),
    ("solar power", 4, "https://medium.com/pub/x", "Solar thoughts", "Bo", "Unknown", "A short look.", 1, False),
    ("solar power", 5, "https://medium.com/other/y", "Solar more", "Bo", "2026-02-02", _SUN * 9, 1, False),
    ("solar power", 6, "https://medium.com/third/z", "Solar most", "Bo", "2026-02-02", _SUN * 9, 1, False),
    ("solar power", 7, "https://b.org/1", "Cooking at home", "Cy", "2026-01-01", _SUN * 8, 2, True),
    ("solar power", 8, "https://c.org/1", "Solar news", "Cy", "", _SUN * 8, 2, True),
    ("solar power", 9, "https://d.org/1", "Solar cooking", "Cy", "2026-01-01", "The weather was fine and nothing much went on in town today. " * 8, 2, True),
    ("mental health", 1, "https://a.org/9", "Mental notes", "Di", "2026-01-01", "Mental health is health of the mind. Mental health matters to all. " * 6, 2, True),
]
_PAGES = [("https://medium.com/pub/x", _SUN * 10, "2026-03-03"), ("https://c.org/1", "x", "2026-04-04")]
_FOUND = [
    ("solar power", 1, "v1", "c1", "Chan", "Solar power explained", "About solar power.", "2026-01-01T00:00:00Z"),
    ("solar power", 2, "v1", "c9", "Chan", "again", "again", "2026"),
    ("solar power", 3, "v2", "c1", "Chan", "same channel", "solar", "2026-01-01"),
    ("solar power", 4, "v3", "c3", "Three", "Solar power talk", "solar power", "2026-01-02"),
    ("solar power", 5, "v4", "c4", "Four", "Solar clip", "solar power", "2026-01-03"),
    ("solar power", 6, "v5", "", "Five", "Solar power tour", "solar power", "2026-01-04"),
    ("solar power", 7, "v6", "", "Six", "Empty", "nothing", "2026-01-05"),
]
_STATS = [
    ("v1", 1_000_000, 5, "PT10M", _SUN * 6, "Channel one"), ("v3", 5_000_000, None, "PT4M", _SUN * 6, ""), ("v4", 9_000_000, 1, "PT30S", _SUN * 6, "x"), ("v5", 900_000, 7, "PT20M", "Solar power and solar.", "Fifth"),
]
_SAID = [("v5", 2, "de", "Sonne " * 60), ("v5", 3, "en", _SUN * 7), ("v3", 1, "fr", "")]
_IDS = [("mental health", 1, "11"), ("mental health", 2, "12"), ("mental health", 3, "13"), ("mental health", 4, "11"), ("solar power", 1, "21")]
_ABSTRACT = "Mental health of students was studied. Mental health got better with sleep and with time outdoors in all of the groups that took part in this long study of many years."
_SUMMARIES = [
    ("11", "Mental health of students.", "Some Journal", "SJ", "2020 Jan", "A B", "10.1/x"), ("12", "Mental health again.", "The Lancet", "L", "2024", "C D", "10.1/y"),
    ("13", "Mental health once more.", "Nature Medicine", "N", "2025", "", "10.1/y"), ("21", "Solar.", "Nature", "N", "2025", "E F", ""),
]


def _sources(spark):
    topics = spark.createDataFrame(_TOPICS, "topic string, topic_idx int, terms array<string>")
    items = spark.createDataFrame(_ITEMS, "topic string, seq int, url string, title string, author string, date string, body string, tier int, full_content boolean")
    pages = spark.createDataFrame(_PAGES, "url string, article string, article_date string")
    blog = runners.blog_records(items, topics, pages)
    found = spark.createDataFrame(_FOUND, "topic string, seq int, video_id string, channel_id string, channel string, title string, description string, published string")
    raw = [(i, {"viewCount": str(v), **({} if k is None else {"likeCount": str(k)})}, d, x, c) for i, v, k, d, x, c in _STATS]
    stats = runners.video_stats(spark.createDataFrame(raw, "id string, statistics map<string,string>, duration string, description string, channel string"))
    said = runners.pick_transcript(spark.createDataFrame(_SAID, "video_id string, place int, language string, transcript string"))
    video = runners.video_records(found, stats, said, topics)
    ids = spark.createDataFrame(_IDS, "topic string, seq int, pmid string")
    people = "array(named_struct('name', authors))"
    summaries = spark.createDataFrame(_SUMMARIES, "pmid string, title string, fulljournalname string, source string, pubdate string, authors string, doi string")
    summaries = summaries.selectExpr("pmid", "title", "fulljournalname", "source", "pubdate", f"{people} AS authors", "array(named_struct('idtype', 'doi', 'value', doi)) AS articleids")
    abstracts = spark.createDataFrame([(i, _ABSTRACT) for i in ("11", "12", "13")], "pmid string, abstract string")
    return runners.all_records(blog, video, runners.abstract_records(ids, summaries, abstracts, topics))


@query("""SELECT seq::BIGINT AS seq, source_type, source_url, author, published_date, n_words::INT AS n_words, has_transcript, citations::BIGINT AS citations, doi FROM (VALUES
(1, 'blog', 'https://c.org/1', 'Cy', '2026-04-04', 96, NULL, NULL, NULL), (2, 'blog', 'https://a.org/1', 'Ann', '2026-01-01', 96, NULL, NULL, NULL), (3, 'blog', 'https://medium.com/pub/x', 'Bo', '2026-03-03', 120, NULL, NULL, NULL),
(1001, 'youtube', 'https://www.youtube.com/watch?v=v5', 'Fifth', '2026-01-04', 88, true, NULL, NULL), (1002, 'youtube', 'https://www.youtube.com/watch?v=v3', 'Three', '2026-01-02', 72, false, NULL, NULL),
(3001, 'blog', 'https://a.org/9', 'Di', '2026-01-01', 72, NULL, NULL, NULL), (5001, 'pubmed', 'https://pubmed.ncbi.nlm.nih.gov/13/', '', '2025', 31, NULL, 110, '10.1/y')) AS v(seq, source_type, source_url, author, published_date, n_words, has_transcript, citations, doi)""")
def source_records(spark, sf):
    """The three sources' runners and their union."""
    return _sources(spark).select("seq", "source_type", "source_url", "author", "published_date", F.size(text.words(F.col("text"))).alias("n_words"), "has_transcript", "citations", "doi")


@query("SELECT * FROM (VALUES ('blog', 4), ('youtube', 2), ('pubmed', 1)) AS v(source_type, n)")
def published_sources(spark, sf):
    """Source records through the whole batch."""
    published, _, _ = pipeline.run(_sources(spark), "2026-05-10T00:00:00Z")
    return published.groupBy("source_type").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("SELECT * FROM (VALUES ('sciencedaily_tech', 2), ('the_conversation', 2), ('mit_tech_review', 2), ('towardsdatascience', 1), ('the_verge', 1), ('huggingface_blog', 2), ('langchain_blog', 2), ('medium', NULL)) AS v(name, tier)")
def feed_registry(spark, sf):
    return feeds.route(runners.feed_table(spark), "tech").select("name", F.col("tier_override").alias("tier"))


@query("SELECT n, round(greatest(0.1, pow(1.6, n) * 0.65), 6) AS least, round(greatest(0.1, pow(1.6, n) * 1.35), 6) AS most FROM (VALUES (0), (1), (2), (3), (-6)) AS v(n)")
def backoff(spark, sf):
    df, _ = values(spark, "n int", [(0,), (1,), (2,), (3,), (-6,)])
    b = feeds.backoff_bounds(F.col("n"))
    return df.select("n", F.round(b["least"], 6).alias("least"), F.round(b["most"], 6).alias("most"))


_EXPAND = [("AI safety", ["ai alignment", "safety", "llm risk"], ["ai-safety", "alignment"], True, "ai[mh]"), ("thin", ["one"], ["two"], True, "x")]


@query("""SELECT * FROM (VALUES
('AI Safety', 'ai alignment;safety;llm risk', 'ai-safety;alignment', true, '(("ai alignment" OR "safety" OR "llm risk") AND ai[mh]) AND hasabstract[Filter]', 'ai alignment explained;safety explained;llm risk explained;ai alignment overview;ai alignment guide'),
('thin', 'thin', 'thin', false, '("thin") AND hasabstract[Filter]', 'thin explained;thin overview;thin guide'),
('green tea', 'green tea;green;tea', 'green-tea', false, '("green tea" OR "green" OR "tea") AND hasabstract[Filter]', 'green tea explained;green explained;tea explained;green tea overview;green tea guide')) AS v(topic, terms, slugs, technical, search, videos)""")
def topic_expansion(spark, sf):
    dim = spark.createDataFrame(_EXPAND, "topic string, terms array<string>, slugs array<string>, is_technical boolean, pubmed_filter string")
    e = feeds.expand(spark.createDataFrame([("AI Safety",), ("thin",), ("green tea",)], "topic string"), dim)
    return e.select(
        "topic", F.array_join("terms", ";").alias("terms"), F.array_join("slugs", ";").alias("slugs"), F.col("is_technical").alias("technical"),
        feeds.abstract_query(F.col("terms"), F.col("is_technical"), F.col("pubmed_filter")).alias("search"), F.array_join(feeds.video_queries(F.col("terms")), ";").alias("videos"),
    )


@query("""SELECT * FROM (VALUES (1, 'First part.' || chr(10) || chr(10) || 'Second part.', 'First part.' || chr(10) || chr(10) || 'Second part.'),
(2, 'Story' || chr(10) || 'Cite This Page: x', 'Story'), (3, 'Story' || chr(10) || 'Related Stories' || chr(10) || 'more', 'Story')) AS v(id, story, cut)""")
def story_texts(spark, sf):
    rows = [
        (1, "<div id='story'><p>First part.</p><script>x</script><p>Second part.</p></div><p>tail</p>"),
        (2, "<div class='a story-text'>Story\nCite This Page: x</div>"),
        (3, "<div id=story-inner>Story\nRelated Stories\nmore</div>"),
    ]
    df = html.with_text(spark.createDataFrame(rows, "id int, html string"), html.science_news_text, out_col="story")
    return df.select("id", "story", html.cut_story(F.col("story")).alias("cut"))


@query("SELECT * FROM (VALUES (1, 'b'), (2, 'a'), (3, '')) AS v(id, picked)")
def extractor_chain(spark, sf):
    df, _ = values(spark, "id int, a string, b string", [(1, "short", "b" * 120), (2, "a" * 100, "b" * 120), (3, None, "x")])
    return df.select("id", F.substring(html.first_long(F.col("a"), F.col("b")), 1, 1).alias("picked"))


# --- state, validation, publication ------------------------------------------------------------------


@query("""
WITH RECURSIVE o AS (SELECT o_custkey AS d, o_orderkey AS seq, (o_totalprice % 1000) / 1000 AS p, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r, CASE WHEN o_custkey % 2 = 0 THEN 5 ELSE 0 END AS n0, CASE WHEN o_custkey % 2 = 0 THEN 0.7 ELSE 0.5 END AS m0 FROM orders),
f AS (SELECT d, seq, r, n0, CASE WHEN n0 >= 3 THEN 0.88 * p + 0.12 * m0 ELSE p END AS fin, (m0 * n0 + CASE WHEN n0 >= 3 THEN 0.88 * p + 0.12 * m0 ELSE p END) / (n0 + 1) AS mean FROM o WHERE r = 1
UNION ALL SELECT o.d, o.seq, o.r, o.n0, CASE WHEN f.r + o.n0 >= 3 THEN 0.88 * p + 0.12 * mean ELSE p END, (mean * (f.r + o.n0) + CASE WHEN f.r + o.n0 >= 3 THEN 0.88 * p + 0.12 * mean ELSE p END) / (f.r + o.n0 + 1) FROM f JOIN o ON o.d = f.d AND o.r = f.r + 1)
SELECT d::VARCHAR AS domain, (any_value(n0) + count(*))::BIGINT AS n, round(max_by(mean, r) + 1e-10, 6) AS mean_score FROM f GROUP BY d""")
def priors_from_state(spark, sf):
    """Scores of orders that move the priors of a state, in which every second domain has a history."""
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").cast("string").alias("domain"), ((F.col("o_totalprice") % 1000) / 1000).alias("penalized"))
    state = o.select("domain").distinct().where(F.col("domain").cast("long") % 2 == 0).select("domain", F.lit(5).cast("bigint").alias("n"), F.lit(0.7).alias("mean_score"))
    _, after = priors.apply_priors(o, state, digits=(12, 12))
    return after.select("domain", "n", F.round(F.col("mean_score") + 1e-10, 6).alias("mean_score"))


@query("""SELECT * FROM (VALUES (0, NULL), (1, 'missing fields: author,language'), (2, 'trust_score out of range'), (3, 'abuse_penalty out of range'), (4, 'unknown source_type'), (5, 'unknown trust_tier'), (6, 'empty source_url'),
(7, 'no content_chunks'), (8, 'chunk without text')) AS v(id, error)""")
def record_validation(spark, sf):
    c = "array(named_struct('text', 'x', 'chunk_index', 0, 'total_chunks', 1, 'quality_score', 0.5D, 'has_overlap', false, 'word_count', 1))"
    raw = spark.range(9).selectExpr("CAST(id AS INT) AS id", "'https://x.org' AS source_url", "'blog' AS source_type", f"{c} AS content_chunks", "0.5D AS trust_score", "'t' AS topic", "0 AS topic_idx", "id AS seq")
    df = publishing.canonical(raw, "now", extra=("id",))
    at = lambda k, name, bad: F.when(F.col("id") == k, bad).otherwise(F.col(name))
    none = F.lit(None).cast("string")
    df = df.withColumns({
        "author": at(1, "author", none), "language": at(1, "language", none), "trust_score": at(2, "trust_score", F.lit(1.5)), "abuse_penalty": at(3, "abuse_penalty", F.lit(-0.1)), "source_type": at(4, "source_type", F.lit("tv")),
        "trust_tier": at(5, "trust_tier", F.lit("GOOD")), "source_url": at(6, "source_url", F.lit(" ")), "content_chunks": F.when(F.col("id") == 7, F.slice("content_chunks", 1, 0)).when(F.col("id") == 8, F.transform("content_chunks", lambda x: x.withField("text", F.lit(" ")))).otherwise(F.col("content_chunks")),
    })
    return df.select("id", publishing.error_of(df).alias("error"))


_PUBLISHED = [
    (1, "a", 0, "https://x.org/1", 0.9), (2, "a", 0, "https://x.org/1", 0.8), (3, "a", 0, "https://x.org/2", 0.1), (4, "a", 0, "https://x.org/3", 0.2), (5, "b", 1, "https://x.org/3", 0.95), (6, "b", 1, "https://x.org/4", 0.5), (7, "b", 1, "", 0.5),
]


@query("SELECT * FROM (VALUES (1, 'https://x.org/1', 'a', 'AUTHORITATIVE'), (4, 'https://x.org/3', 'a', 'UNRELIABLE'), (6, 'https://x.org/4', 'b', 'UNCERTAIN')) AS v(seq, source_url, topic, trust_tier)")
def publication(spark, sf):
    """Hard reject, validation, first of an id, first topic of a URL."""
    df, _ = values(spark, "seq int, topic string, topic_idx int, source_url string, trust_score double", _PUBLISHED)
    df = df.withColumn("content_chunks", chunking.fallback_chunk(F.lit("some text"), F.lit("blog")))
    published, _ = publishing.publish(publishing.canonical(df, "now"))
    return published.select("seq", "source_url", "topic", "trust_tier")


@query("SELECT 3 AS topics, count(*)::BIGINT AS records FROM lineitem")
def index_rollup(spark, sf):
    """The index over run manifests."""
    items = t(spark, sf, "lineitem").select(F.col("l_returnflag").alias("topic"), F.lit("blog").alias("source_type"), F.col("l_discount").alias("trust_score"), F.lit("UNRELIABLE").alias("trust_tier"), F.lit("2.0").alias("schema_version"))
    made = sinks.index(sinks.manifest(items, "now"))
    return made.select(F.get_json_object("index", "$.topics_n").cast("int").alias("topics"), F.get_json_object("index", "$.total_records").cast("bigint").alias("records"))


@query("SELECT id, passes FROM (VALUES (1, true), (2, false), (3, true), (4, true)) AS v(id, passes)")
def video_lengths(spark, sf):
    df, _ = values(spark, "id int, d int", [(1, 120), (2, 119), (3, 0), (4, None)])
    return df.select("id", ranking.long_enough(F.col("d")).alias("passes"))
