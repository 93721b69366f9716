"""Core operators against plain Python on small rows."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, SIGNALS, WEIGHTS, Settings
from trustloom.functions import anomaly, chunking, features, stats, text, trust
from trustloom.functions import lexicons as L
from trustloom.operators import priors, publishing, ranking, relevance, tagging
from trustloom.plans import pipeline
from trustloom.sources import feeds, html, sinks

WORDS = "alpha beta gamma delta alpha the of and river stone cloud".split()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def texts(n=40, seed=3):
    r = random.Random(seed)
    out = ["", " ", "One.", "a\tb\nc"]
    for _ in range(n):
        out.append(" ".join(r.choice(WORDS) + r.choice(["", "", ".", "!", ","]) for _ in range(r.randint(1, 260))))
    return out


def test_clean_text(spark):
    got = lambda s: one(spark, text.clean_text(F.lit(s)))
    assert got("a\x00b\x07c") == "abc"
    assert got("a\t\tb    c") == "a b c"
    assert got("a\n\n\n\nb") == "a\n\nb"
    assert got("‮evil") == "evil"
    assert one(spark, text.clean_text(F.lit(None).cast("string"))) == ""
    assert one(spark, text.clean_text(F.lit("x" * 100), 10)) == "x" * 10
    assert one(spark, text.clean_text(F.lit(42))) == "42"


def test_valid_url(spark):
    ok = lambda s: one(spark, text.valid_url(F.lit(s).cast("string")))
    assert ok("https://x.org/a") and ok("http://x.org")
    for bad in ("javascript:alert(1)", "data:text/html,x", "file:///etc/passwd", "", None, "https://" + "a" * 2100):
        assert not ok(bad)


def test_chunks_match_greedy_packing(spark):
    def packed(t, limit):
        out, buf, n = [], [], 0
        for s in [x.strip() for x in re.split(r"(?<=[.!?])\s+", t.strip()) if x.strip()]:
            w = s.split()
            if len(w) > limit:
                if buf:
                    out.append(" ".join(buf))
                    buf, n = [], 0
                out += [" ".join(w[i : i + limit]) for i in range(0, len(w), limit)]
            elif n + len(w) <= limit:
                buf.append(s)
                n += len(w)
            else:
                if buf:
                    out.append(" ".join(buf))
                buf, n = [s], len(w)
        return out + ([" ".join(buf)] if buf else [])

    rows = texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id int, text string")
    for limit in (6, 40):
        got = {r["id"]: [c["t"] for c in r["c"]] for r in chunking.pack(df, "text", "c", limit).collect()}
        assert all([c["w"] for c in r["c"]] == [c["t"].split() for c in r["c"]] for r in chunking.pack(df, "text", "c", limit).collect())
        assert got == {i: packed(t, limit) for i, t in enumerate(rows)}


def test_chunk_overlap_comes_from_the_raw_chunk_before(spark):
    t = " ".join(" ".join(f"w{i}x{j}" for j in range(49)) + f" end{i}." for i in range(20))
    row = chunking.chunk(spark.createDataFrame([(t,)], "text string")).first()["content_chunks"]
    assert len(row) > 1 and [c["chunk_index"] for c in row] == list(range(len(row)))
    assert not row[0]["has_overlap"] and all(c["has_overlap"] for c in row[1:])
    assert row[1]["text"].split()[:25] == row[0]["text"].split()[-25:]
    assert all(c["word_count"] <= 205 and c["total_chunks"] == len(row) for c in row)
    assert one(spark, chunking.assemble(F.lit(None).cast("array<struct<text:string,has_overlap:boolean>>"))) is None


def test_short_text_has_no_chunk(spark):
    df = spark.createDataFrame([("",), ("too short",), (None,)], "text string")
    assert [r["content_chunks"] for r in chunking.chunk(df).collect()] == [[], [], []]


def test_statistics(spark):
    rows = texts()
    df = features.with_features(spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id int, content string"))
    got = df.select("id", "_n", "_top", stats.entropy(F.col("_counts"), F.col("_n")).alias("h"), stats.gini(F.col("_ccounts")).alias("g"), stats.ngram_repetition(F.col("_words"), 4).alias("r")).collect()
    for r in got:
        w = rows[r["id"]].lower().split()
        assert r["_n"] == len(w)
        c = Counter(w)
        assert math.isclose(r["h"] or 0.0, -sum(k / len(w) * math.log2(k / len(w)) for k in c.values()), abs_tol=1e-9)
        cw = [x for x in w if x.isalpha() and x not in L.STOP_WORDS]
        if cw:
            assert (r["_top"]["w"], r["_top"]["n"]) == Counter(cw).most_common(1)[0]
            v = sorted(Counter(cw).values())
            g = 1.0 if len(v) == 1 else 2 * sum((i + 1) * x for i, x in enumerate(v)) / (len(v) * sum(v)) - (len(v) + 1) / len(v)
            assert math.isclose(r["g"], g, abs_tol=1e-9)
        grams = [tuple(w[i : i + 4]) for i in range(len(w) - 3)]
        assert math.isclose(r["r"], 1 - len(set(grams)) / len(grams) if grams else 0.0, abs_tol=1e-12)


def fold(scores, digits=(3, 4)):
    n, mean, out = 0, 0.5, []
    for p in scores:
        v = 0.88 * p + 0.12 * mean if n >= 3 else p
        f = min(max(v, 0), 1)
        mean, n = (mean * n + f) / (n + 1), n + 1
        out.append(f)
    return out


def test_priors(spark):
    r = random.Random(1)
    rows = [(i, f"d{r.randint(0, 3)}", round(r.random(), 3)) for i in range(60)] + [(100, "", 0.4), (101, None, 0.6)]
    out, state = priors.apply_priors(spark.createDataFrame(rows, "seq bigint, domain string, penalized double"), digits=(12, 12))
    got = {x["seq"]: x["trust_score"] for x in out.collect()}
    for d in {x[1] for x in rows if x[1]}:
        own = [(s, p) for s, dd, p in rows if dd == d]
        for (s, _), f in zip(own, fold([p for _, p in own]), strict=True):
            assert math.isclose(got[s], f, abs_tol=1e-9)
    assert got[100] == 0.4 and got[101] == 0.6
    assert {x["domain"]: x["n"] for x in state.collect()} == Counter(x[1] for x in rows if x[1])
    more, _ = priors.apply_priors(spark.createDataFrame([(0, "d0", 0.9)], "seq bigint, domain string, penalized double"), state)
    assert more.first()["prior_used"] is not None


def test_prior_state_round_trip(spark, tmp_path):
    path = str(tmp_path / "state")
    assert priors.load_state(spark, path).count() == 0
    for n in (1, 2):
        priors.save_state(spark.createDataFrame([("x.org", n, 0.5)], "domain string, n bigint, mean_score double"), path)
        assert priors.load_state(spark, path).first()["n"] == n


def test_a_crash_while_saving_leaves_the_state_before(spark, tmp_path):
    path = tmp_path / "state"
    one_ = lambda n: spark.createDataFrame([("x.org", n, 0.5)], "domain string, n bigint, mean_score double")
    for n in (1, 2, 3):
        priors.save_state(one_(n), str(path))
    assert sorted(p.name for p in path.iterdir()) == ["v2", "v3"]  # the one before stays for its readers
    (path / "v4").mkdir()
    (path / "v4" / "part-0.parquet").write_bytes(b"torn")  # no mark of a finished job
    assert priors.load_state(spark, str(path)).first()["n"] == 3
    (path / "v4" / "_SUCCESS").touch()  # marked, but cannot be read
    assert priors.load_state(spark, str(path)).first()["n"] == 3
    priors.save_state(one_(5), str(path))
    assert priors.load_state(spark, str(path)).first()["n"] == 5


def test_journals(spark):
    rows = [(1, "Nature Medicine", "2025 Apr"), (2, "X", "2014"), (3, None, None), (4, "The BMJ", "Spring")]
    df = spark.createDataFrame(rows, "id int, j string, d string").select("id", ranking.journal_score(F.col("j"), F.col("d")).alias("s"), ranking.citation_proxy(F.col("j")).alias("p"))
    assert [(r["s"], r["p"]) for r in df.orderBy("id").collect()] == [(4.5, 110), (0.0, 5), (0.0, 5), (2.0, 110)]


def test_repeated_places_do_not_multiply_records(spark):
    same = records(spark, 6).withColumn("seq", F.lit(7).cast("bigint"))
    published, _, state = pipeline.run(same, "now")
    assert published.count() == 6 and sum(r["n"] for r in state.collect()) == 6


def test_state_is_loaded_and_saved_around_a_run(spark, tmp_path):
    path = str(tmp_path / "priors")
    first, _ = pipeline.run_with_state(records(spark), "now", path)
    n = {r["domain"]: r["n"] for r in priors.load_state(spark, path).collect()}
    pipeline.run_with_state(records(spark), "now", path)
    assert sum(n.values()) == 12 and {r["domain"]: r["n"] for r in priors.load_state(spark, path).collect()} == {d: 2 * k for d, k in n.items()}
    assert first.count() > 0


def test_spoken_records_get_transcript_flags(spark):
    talk = "Go on now. " * 60 + "[Music] " * 200
    base = records(spark, 2).where("seq = 1").withColumns({"text": F.lit(talk), "has_transcript": F.lit(True)})
    flags = [r["anomaly_flags"] for r in pipeline.run(base, "now", s=Settings(reject_below=0.0))[0].collect()][0]
    assert any(f.startswith("transcript_repetition") for f in flags)
    silent = pipeline.run(base.withColumn("has_transcript", F.lit(False)), "now", s=Settings(reject_below=0.0))[0].first()["anomaly_flags"]
    assert not any(f.startswith("transcript") for f in silent)


def test_diversity_caps_equal_the_greedy_loop(spark):
    r = random.Random(5)
    rows = [(i, f"https://{r.choice(['a.org', 'medium.com', 'b.net', 'www.c.com'])}/{r.choice(['x', 'y', 'z'])}/{i}") for i in range(60)]
    for k in range(3):
        part = rows[k * 20 : k * 20 + 20]
        keys, domains, kept = set(), Counter(), []
        for i, u in part:
            host = u.split("/")[2].replace("www.", "")
            key = f"{host}/{u.split('/')[3]}" if "medium.com" in host else host
            if key in keys or domains[host] >= 2 or len(kept) >= 3:
                continue
            keys.add(key)
            domains[host] += 1
            kept.append(i)
        got = ranking.diverse(spark.createDataFrame(part, "id int, source_url string"), ["id"]).collect()
        assert sorted(x["id"] for x in got) == kept


def test_relevance(spark):
    on = "AI safety and alignment matter. Safety of AI systems is about alignment of AI models with people."
    off = "The balcony solar kit passed a safety check and makes power in summer. " * 3
    rel = lambda t, topic: one(spark, relevance.relevant(F.lit(t), F.lit(topic), F.array(F.lit("ai alignment"))))
    assert rel(on, "AI safety") and not rel(off, "AI safety") and not rel("", "AI safety")
    inflamed = "Inflammatory markers rise. An inflammatory response follows."
    assert one(spark, relevance.relevant(F.lit(inflamed), F.lit("inflammation"), F.array().cast("array<string>")))


def test_tags_rank_by_zone(spark):
    mine = [("programming", ("code", "compiler"), 1.0), ("energy", ("solar", "battery", "power grid"), 0.9), ("arts", ("code",), 1.0)]
    docs = ["Solar power grid\nThe battery and the compiler.\n\nCode and code and code", "nothing here", None, "", "codes decode", "Code"]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    got = {r["id"]: r["topic_tags"] for r in tagging.with_tags(df, taxonomy=mine).collect()}
    assert got[0][0] == "energy" and got[5] == ["programming", "arts"] and all(got[i] == ["general"] for i in (1, 2, 3, 4))
    many = spark.createDataFrame([("Quantum computing and the qubit\n\nMachine learning on a quantum computer, by a neural network.",)], "text string")
    assert tagging.with_tags(many).first()["topic_tags"][0] == "quantum computing" and len(L.TAXONOMY) == 23


def test_transcript_flags(spark):
    t = "Go on. Go on. Go on. Go on. [Music] [Music] [Applause] and then some more words here"
    got = one(spark, anomaly.transcript_flags(F.lit(t)))
    assert any(f.startswith("transcript_high_noise") for f in got) and any(f.startswith("transcript_repetition") for f in got)
    assert one(spark, anomaly.transcript_flags(F.lit("short"))) == []


def records(spark, n=12):
    rows = []
    for i in range(n):
        kind = ("blog", "youtube", "pubmed")[i % 3]
        body = " ".join(f"{w}{i} study of river stone number {j}." for j, w in enumerate(WORDS * 4))
        rows.append((i, "t", 0, kind, f"https://site{i % 4}.org/p{i % 10}", "Jo Doe", "2026-01-05", body, 5000 + i, 100 + i, 300))
    return spark.createDataFrame(rows, "seq bigint, topic string, topic_idx int, source_type string, source_url string, author string, published_date string, text string, view_count bigint, like_count bigint, duration_sec bigint")


def test_pipeline_invariants(spark):
    published, invalid, state = pipeline.run(records(spark), "2026-05-10T00:00:00Z")
    rows = published.collect()
    assert rows and invalid.count() == 0 and state.count() == 4
    assert len({r["record_id"] for r in rows}) == len(rows)
    assert [(-r["trust_score"], r["source_url"]) for r in rows] == sorted((-r["trust_score"], r["source_url"]) for r in rows)
    for r in rows:
        assert 0 <= r["trust_score"] <= 1 and 0.05 <= r["abuse_penalty"] <= 1 and set(r["sub_scores"]) == set(SIGNALS)
        w, c, s = r["weights"], r["confidence"], r["sub_scores"]
        raw = sum(w[k] * c[k] * s[k] for k in SIGNALS) / sum(w[k] * c[k] for k in SIGNALS)
        base = raw * r["abuse_penalty"]
        if r["prior_used"] is not None:
            base = 0.88 * base + 0.12 * r["prior_used"]
        assert abs(base - r["trust_score"]) < 0.005
        band = next((n for least, n in DEFAULT.tiers if r["trust_score"] >= least), DEFAULT.tier_rest)
        assert r["trust_tier"] == band


def test_penalty_floor_and_unknown_type(spark):
    base = records(spark, 1).select("*", F.col("text").alias("content")).withColumns({"citations": F.lit(None).cast("bigint"), "pmid": F.lit(None).cast("string"), "doi": F.lit(None).cast("string"), "journal": F.lit(None).cast("string")})
    many = base.withColumns({"anomaly_flags": F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: F.concat(F.lit("f"), i.cast("string"))), "source_type": F.lit("bogus")})
    r = trust.score(many).first()
    assert r["abuse_penalty"] == 0.05 and r["source_type"] == "blog" and r["weights"]["recency"] == WEIGHTS["blog"][3]
    stuffed = base.withColumns({"anomaly_flags": F.array(F.lit("keyword_stuffing:spam:0.9")), "content": F.lit("spam " * 200)})
    assert trust.score(stuffed).first()["abuse_penalty"] == 0.8


def test_validation_names_the_first_fault(spark):
    published, _, _ = pipeline.run(records(spark, 3), "2026-05-10T00:00:00Z")
    bad = published.withColumn("trust_score", F.lit(1.5))
    assert {r["e"] for r in bad.select(publishing.error_of(bad).alias("e")).collect()} == {"trust_score out of range"}
    assert "author" in published.drop("author").select(publishing.error_of(published.drop("author")).alias("e")).first()["e"]


def test_article_cascade():
    assert html.article_text("<nav>menu</nav><article><p>Body</p><aside>x</aside></article><p>tail</p>") == "Body"
    assert html.article_text("<main><p>Main</p></main>") == "Main"
    assert html.article_text("<p>short</p><p>" + "long " * 12 + "</p>").startswith("long")
    assert html.article_text(None) == "" and html.article_text("<article></article><main>x</main>") == ""


def test_expansion_and_queries(spark):
    dim = spark.createDataFrame([("AI safety", ["a", "b", "c"], ["x", "y"], True, "f")], "topic string, terms array<string>, slugs array<string>, is_technical boolean, pubmed_filter string")
    got = {r["topic"]: r for r in feeds.expand(spark.createDataFrame([("AI Safety",), ("green tea",)], "topic string"), dim).collect()}
    assert got["AI Safety"]["terms"] == ["a", "b", "c"] and got["green tea"]["terms"] == ["green tea", "green", "tea"]
    q = one(spark, feeds.abstract_query(F.array(F.lit("a"), F.lit("b"), F.lit("a")), F.lit(True), F.lit("x[mh]")))
    assert q == '(("a" OR "b") AND x[mh]) AND hasabstract[Filter]'
    assert one(spark, feeds.video_queries(F.array(F.lit("a"), F.lit("b")))) == ["a explained", "b explained", "a overview", "a guide"]


def test_circuit_breaker(spark):
    log = [("h", float(t), ok) for t, ok in [(0, False), (1, False), (2, False), (3, True), (40, True), (41, True)]]
    got = [r["state"] for r in feeds.breaker(spark.createDataFrame(log, "host string, ts double, ok boolean")).orderBy("ts").collect()]
    assert got == ["CLOSED", "CLOSED", "CLOSED", "OPEN", "HALF_OPEN", "CLOSED"]


def test_sinks_round_trip(spark, tmp_path):
    published, _, _ = pipeline.run(records(spark, 6), "2026-05-10T00:00:00Z")
    published = published.cache()
    sinks.write_by_type(published, str(tmp_path / "types"))
    assert spark.read.json(str(tmp_path / "types")).count() == published.count()
    m = sinks.manifest(published, "now")
    assert m.first()["total_records"] == published.count()
    assert '"topics_n":1' in sinks.index(m).first()["index"]


def test_stream_equals_batch(spark, tmp_path):
    from trustloom.streaming import trust_stream

    rows = [(i, f"d{i % 3}", ((i * 37) % 100) / 100) for i in range(30)]
    df = spark.createDataFrame(rows, "seq bigint, domain string, penalized double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = trust_stream.with_priors(stream).writeStream.format("memory").queryName("priors_out").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = {r["seq"]: r["trust_score"] for r in spark.table("priors_out").collect()}
    batch = {r["seq"]: r["trust_score"] for r in priors.apply_priors(df)[0].collect()}
    assert got == batch


def run_stream(make, spark, tmp_path, df, name, mode="append"):
    df.coalesce(1).write.parquet(str(tmp_path / name))
    out = make(spark.readStream.schema(df.schema).parquet(str(tmp_path / name)))
    q = out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"{name}-ck")).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name).collect()


def test_streams_dedup_count_and_score(spark, tmp_path):
    from trustloom.streaming import trust_stream

    base = records(spark, 12).withColumn("event_time", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq") * 60))
    once_ = run_stream(trust_stream.deduplicated, spark, tmp_path, base.unionByName(base), "deduped")
    assert len(once_) == len({r["record_id"] for r in once_}) == base.select(text.record_id(F.col("source_type"), F.col("source_url"))).distinct().count()
    tiers = base.select("event_time", F.when(F.col("seq") % 2 == 0, "CREDIBLE").otherwise("UNCERTAIN").alias("trust_tier"))
    windows = run_stream(trust_stream.tier_windows, spark, tmp_path, tiers, "tiers", "complete")
    assert sum(r["n"] for r in windows) == 12
    full = base.select("*", F.col("text").alias("content")).withColumns({c: F.lit(None).cast(t) for c, t in {"citations": "bigint", "pmid": "string", "doi": "string", "journal": "string"}.items()})
    got = {r["seq"]: (r["trust_score"], r["trust_tier"]) for r in run_stream(trust_stream.trust_stream, spark, tmp_path, full, "scored")}
    scored = trust.score(full).select("seq", text.netloc(F.col("source_url")).alias("domain"), F.col("penalized_score").alias("penalized"))
    batch = {r["seq"]: r["trust_score"] for r in priors.apply_priors(scored)[0].collect()}
    assert {k: v for k, (v, _) in got.items()} == batch and all(t for _, t in got.values())


def test_written_runs_and_their_index(spark, tmp_path):
    published, _, _ = pipeline.run(records(spark, 9), "now")
    published = published.cache()
    sinks.write_manifests(published, str(tmp_path / "runs"), "now")
    back = spark.read.json(str(tmp_path / "runs" / "records"))
    assert back.count() == published.count() and spark.read.json(str(tmp_path / "runs" / "manifest")).first()["total_records"] == published.count()
    sinks.write_raw(records(spark, 3), str(tmp_path), "blog")
    assert spark.read.json(str(tmp_path / "raw" / "blog")).count() == 3
    shown = sinks.result_table(published, 4).orderBy("place").collect()
    assert [r["place"] for r in shown] == [1, 2, 3, 4] and [float(r["trust"]) for r in shown] == sorted((float(r["trust"]) for r in shown), reverse=True)
    broken = published.withColumn("trust_tier", F.when(F.col("source_type") == "blog", "GOOD").otherwise(F.col("trust_tier")))
    saved = broken.agg(F.collect_list(F.struct(*published.columns)).alias("records")).select(F.lit("t").alias("topic_dir"), F.struct(F.lit(0.7).alias("avg_trust"), F.lit("now").alias("generated_at")).alias("meta"), "records")
    n = {r["source_type"]: r["count"] for r in published.groupBy("source_type").count().collect()}
    entry = sinks.index_entries(saved).first()
    assert (entry["invalid"], entry["blog"], entry["youtube"], entry["total"], entry["avg_trust"]) == (n["blog"], 0, n["youtube"], n["youtube"] + n["pubmed"], 0.7)


@pytest.mark.parametrize("seed", range(3))
def test_keep_first(spark, seed):
    r = random.Random(seed)
    rows = [(i, r.choice(["a", "b", "c", "", None])) for i in range(40)]
    seen, want = set(), []
    for i, k in rows:
        if not k or k not in seen:
            want.append(i)
            seen.add(k)
    got = ranking.keep_first(spark.createDataFrame(rows, "i int, k string"), F.col("k"), ["i"])
    assert sorted(x["i"] for x in got.collect()) == want
