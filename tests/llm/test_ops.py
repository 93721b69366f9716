"""The ten operators against brute force, on rows with nulls, empty and long texts, ties and repetitions."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustloom.llm import chat, decontam, html_main, mixing, neardup, quality, sharding, substring_dedup, toxicity, warc
from trustloom.llm.words import chunks

SYL = "ta re mi so lu den kor vash pel un".split()
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, bucket int"


def prose(r, n):
    return " ".join("".join(r.choice(SYL) for _ in range(r.randint(1, 3))) for _ in range(n))


def corpus(seed=1, n=40):
    """Random prose with exact and near copies, shared passages, a hot source and odd rows."""
    r = random.Random(seed)
    texts = [prose(r, r.randint(3, 160)) for _ in range(n)]
    passage = prose(r, 70)
    for i in range(0, n, 5):
        texts[i] = prose(r, 20) + " " + passage + " " + prose(r, 15)
    texts += [texts[1], texts[1], texts[2].upper(), texts[6]]
    near = prose(r, 200).split()
    for _ in range(6):
        w = list(near)
        w[r.randrange(200)] = "zz"
        texts.append(" ".join(w))
    texts += ["", None, "   \n\t ", "one two", "a b c d e", "x " * 3000, prose(r, 4000), "line\nline\n| a | b | c |\n"]
    rows = [(i, t, "en" if i % 3 else None, "hot" if i % 2 else f"s{i % 7}", None if t is None else len(t), "clash", 9) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3]]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_hashes_do_not_depend_on_the_chunk():
    import pyarrow as pa

    texts = [prose(random.Random(i), 50) for i in range(20)] + [None, ""]
    a, b = list(chunks(pa.array(texts), limit=100)), list(chunks(pa.array(texts)))
    flat = lambda cs: [c.hash[c.bounds[i] : c.bounds[i + 1]].tolist() for c in cs for i in range(c.n_texts)]
    assert flat(a) == flat(b) and len(a) > len(b)


def test_toxicity(spark):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        grade = i % 4
        w = prose(r, 40).split()
        for _ in range(2 * grade):
            w.insert(r.randrange(len(w)), r.choice(["vile", "nasty", "grimly"]))
        rows.append((i, " ".join(w)))
        if i < 300:
            labels.append((i, grade))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id bigint, grade int"))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 3
    got = {x["doc_id"]: x for x in toxicity.score(docs, model).collect()}
    held = [i for i in range(300, 400)]
    assert np.mean([(got[i]["toxic"]) == (i % 4 > 0) for i in held]) >= 0.97
    means = [np.mean([got[i]["expected_severity"] for i in held if i % 4 == g]) for g in range(4)]
    assert means == sorted(means) and not got[900]["toxic"] and not got[901]["toxic"]
    flat = toxicity.train(docs, spark.createDataFrame([], "doc_id bigint, grade int"))
    assert not any(x["toxic"] for x in toxicity.score(docs, flat).collect())


DIMS = ["source", "lang", "n_chars"]


def check_shards(got, rows, n):
    """Ids, sizes, digests, gapless slots, and sizes that differ by less than two of the longest texts."""
    assert sorted(x["doc_id"] for x in got) == sorted(x[0] for x in rows)
    by, text = defaultdict(list), {x[0]: x[1] or "" for x in rows}
    for x in got:
        by[x["shard"]].append(x)
        assert x["size"] == len(text[x["doc_id"]].encode()) + 1 and x["text_crc32"] == zlib.crc32(text[x["doc_id"]].encode())
    assert all(sorted(x["slot"] for x in v) == list(range(len(v))) for v in by.values())
    sizes, largest = [sum(x["size"] for x in v) for v in by.values()], max(x["size"] for x in got)
    assert set(by) <= set(range(n)) and max(sizes) - min(sizes) <= 2 * largest


def test_kd_shards(docs, none, rows):
    check_shards(sharding.kd_shards(docs, DIMS, n_shards=4).collect(), rows, 4)
    assert sharding.kd_shards(none, DIMS, n_shards=4).count() == 0
    assert {x["shard"] for x in sharding.kd_shards(docs, DIMS, target_bytes=10**9).collect()} == {0}


def test_kd_shards_split_one_hot_value(spark):
    same = spark.createDataFrame([(i, "x" * 99, "one", "one", 99) for i in range(800)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = Counter(x["shard"] for x in sharding.kd_shards(same, ["source", "lang"], n_shards=8).collect())
    assert len(got) == 8 and max(got.values()) - min(got.values()) <= 8


def test_kd_shards_do_not_depend_on_the_layout(spark, docs, rows):
    """Another number and order of partitions gives every document the same shard and slot; a third of the rows are one row."""
    many = docs.unionByName(spark.createDataFrame([rows[4]] * (len(rows) // 2), docs.schema)).unionByName(spark.createDataFrame([(None, None, None, None, None, "c", 1)] * 2, docs.schema))
    keys = ("doc_id", "size", "text_crc32", "shard", "slot")
    one = sorted((tuple(x[k] for k in keys) for x in sharding.kd_shards(many.coalesce(1), DIMS, n_shards=4, carry=["text", "id", "bucket"]).collect()), key=str)
    other = sorted((tuple(x[k] for k in keys) for x in sharding.kd_shards(many.repartition(7, F.rand(5)), DIMS, n_shards=4, carry=["text", "id", "bucket"]).collect()), key=str)
    assert one == other and len(one) == len(rows) + len(rows) // 2 + 2
    assert len({x[3] for x in one if x[0] == rows[4][0]}) > 1  # the repeated row is in several shards


def test_kd_tree_splits_where_brute_force_does(spark):
    """Two dimensions, distinct sizes: each split is at the weighted median of the widest one."""
    r = random.Random(12)
    pts = [(i, "y" * r.randint(1, 50), r.random() * 3 - 1, f"https://example.org/common/prefix/{r.randint(0, 400):04d}") for i in range(300)]
    got = {x["doc_id"]: x["shard"] for x in sharding.kd_shards(spark.createDataFrame(pts, "doc_id bigint, text string, score double, site string"), ["score", "site"], n_shards=4).collect()}
    rank = {v: k for k, v in enumerate(sorted({p[3] for p in pts}))}
    lo, hi = min(p[2] for p in pts), max(p[2] for p in pts)
    at = {p[0]: (int((p[2] - lo) / (hi - lo) * sharding.FRACTION_STEPS), rank[p[3]]) for p in pts}
    size = {p[0]: len(p[1]) + 1 for p in pts}
    top = [max(v[d] for v in at.values()) - min(v[d] for v in at.values()) for d in (0, 1)]

    def split(ids, a, b):
        if b - a == 1:
            return {i: a for i in ids}
        width = [(max(at[i][d] for i in ids) - min(at[i][d] for i in ids)) / top[d] for d in (0, 1)]
        d = 0 if width[0] >= width[1] else 1
        order, total, need = sorted(ids, key=lambda i: at[i][d]), 0, sum(size[i] for i in ids) / 2
        for i in order:
            total += size[i]
            if total >= need:
                median = at[i][d]
                break
        left = [i for i in ids if at[i][d] < median]
        right = [i for i in ids if at[i][d] > median]
        tied = [i for i in ids if at[i][d] == median]
        mid = a + (b - a) // 2
        inside = [i for i in tied if got[i] < mid]  # the hash decides among these alone
        return split(left + inside, a, mid) | split(right + [i for i in tied if got[i] >= mid], mid, b)

    assert got == split(list(at), 0, 4)


def test_toxicity_of_odd_rows(spark):
    """Repeated ids do not widen the sample; long texts, nulls, clashing names and empty tables are scored."""
    r = random.Random(8)
    rows = [(i, prose(r, 30) + (" vile nasty" if i % 2 else ""), "a", 0.5) for i in range(60)] + [(1, "vile " + prose(r, 9), "a", 0.5)] * 50
    rows += [(70, prose(r, 30_000) + " vile nasty", "a", 0.5), (71, None, "a", 0.5), (None, "vile nasty", "a", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic string, p_toxic double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, grade int")
    model = toxicity.train(docs, labels, least_g2=5.0)
    out = toxicity.score(docs, model, keep_columns=True)
    assert out.columns == ["doc_id", "text", "expected_severity", "p_toxic", "toxic"]
    got = out.collect()
    assert len(got) == len(rows) and all(x["toxic"] for x in got if x["doc_id"] in (70, None)) and not any(x["toxic"] for x in got if x["doc_id"] == 71)
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.train(docs, labels, sample_rows=2).thresholds == toxicity.train(docs.where("doc_id <> 1"), labels, sample_rows=2).thresholds


def test_ordinal_fit_is_optimal():
    """The fit against plain gradient descent with gradients from differences of the likelihood itself."""
    r = np.random.default_rng(3)
    n, m, k = 150, 3, 3
    x = (r.random((n, m)) < 0.4).astype(float)
    y = np.clip(np.digitize(x @ np.array([2.0, 1.0, -1.0]) + r.logistic(size=n), [0.5, 2.0]), 0, k - 1)
    ridge = 0.02

    def loss(p):
        w, t = p[:m], np.array([p[m], p[m] + np.exp(p[m + 1])])
        f = np.column_stack([np.zeros(n), 1 / (1 + np.exp(-(t[None, :] - (x @ w)[:, None]))), np.ones(n)])
        return -np.log(f[np.arange(n), y + 1] - f[np.arange(n), y]).sum() + ridge / 2 * (w @ w)

    def slope(p):
        return np.array([(loss(p + h) - loss(p - h)) / 2e-5 for h in np.eye(m + 2) * 1e-5])

    p = np.zeros(m + 2)
    for _ in range(4000):
        p = p - 0.01 * slope(p)
    w, theta = toxicity.fit_ordinal([np.flatnonzero(row).tolist() for row in x], y, m, k, ridge=ridge)
    ours = np.concatenate([w, theta[:1], np.log(np.diff(theta))])
    assert loss(ours) <= loss(p) + 1e-3 and np.abs(ours - p).max() < 0.02


def test_grades_come_from_words_of_the_other_half(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 3
        w = prose(r, 60).split() + ["vile", "nasty", "grimly", "rotten"][: r.randint(1, 4)] * (4 * bad) if bad else prose(r, 60).split()
        r.shuffle(w)
        rows.append((i, " ".join(w)))
        if i < 450:
            labels.append((i, int(bad > 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, grade int"), grades_by_density=3)
    assert len(model.thresholds) == 3 and model.thresholds == sorted(model.thresholds)
    got = {x["doc_id"]: x for x in toxicity.score(docs, model).collect()}
    assert np.mean([got[i]["toxic"] == (i % 3 > 0) for i in range(450, 600)]) >= 0.98
    assert np.mean([got[i]["expected_severity"] for i in range(450, 600) if i % 3]) > 1.5


def test_quality_counts(docs, none, rows):
    got = {x["doc_id"]: x for x in quality.clean_lines(docs).collect()}
    for i, t, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        c = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        hit = {p for k in range(len(w) - 4) if c[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        x = got[i]
        assert (x["n_words"], x["word_chars"], x["n_dup_lines"], x["n_repeat_words"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit))
        assert x["n_symbols"] == sum(ch in quality.SYMBOLS for ch in t) and x["base_failed"] == (len(w) < 10 or 100 * len(hit) > 20 * len(w))
    assert quality.clean_lines(none).count() == 0


def test_quality_lines(spark):
    good = "This is a long enough sentence that ends well."
    t = f"{good}\nHome | About | News | Contact\nAll rights reserved.\nShort bit\n### $$$ %%% &&&\n{good} Again, and once more, it is fine."
    x = quality.clean_lines(spark.createDataFrame([(1, t), (2, good + " It has two parts.")], "doc_id int, text string")).orderBy("doc_id").collect()
    assert x[0]["clean_text"] == f"{good}\n{good} Again, and once more, it is fine." and x[0]["n_lines_removed"] == 4 and x[1]["kept"]


def brute_rake(cells, targets, budget, sweeps=12):
    """{(source, lang, topic): tokens} to expected tokens, sweep by sweep."""
    total = sum(cells.values())
    w = {c: n * budget for c, n in cells.items()}
    for _ in range(sweeps):
        for d in range(3):
            have = Counter()
            for c in cells:
                have[c[d]] += w[c]
            w = {c: min(n, w[c] * targets[d][c[d]] * total * budget / have[c[d]] if have[c[d]] else w[c]) for c, n in cells.items()}
    return w


def test_quality_rules_one_by_one(spark):
    long = "Ein langer Satz mit genug Wörtern steht hier und endet gut."
    bad = ["Startseite", "» Lire la suite «", "Inicio | Noticias | Contacto", "Kapitel eins", "one, two,", "Alle Rechte vorbehalten, und mehr steht hier auch noch.", "Nos conditions d'utilisation se trouvent sur cette page.", "### ab %%% cd $$$ ef &&& gh.", "A / B / C / D"]
    good = ["Was nun?", "He said: \"no.\"", "Ja!", "Sehr gut (wirklich.)", long, "This is 5 > 3 in a long line of words, as it should be.", "日本語です。"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(bad + good)], "doc_id int, text string")
    got = {x["doc_id"]: x["n_lines_removed"] for x in quality.clean_lines(df).collect()}
    assert [x for i, x in enumerate(bad + good) if got[i] != (i < len(bad))] == []
    texts = [f"{long}\n" * 1 + "\n".join(bad[:4]), "\n".join(bad * 4) + "\n" + long, long + " Der zweite Teil sagt etwas ganz anderes und hört dann auf.", None, "", "w " * 50_000]
    out = {x["doc_id"]: x for x in quality.clean_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert out[0]["clean_text"] == long and out[0]["kept"] and not out[1]["kept"] and out[2]["kept"] and not (out[3]["kept"] or out[4]["kept"] or out[5]["kept"])


def test_mixing(docs, none, rows):
    topic = mixing.topic_of(F.col("text"))
    got, report = mixing.mix(docs, topic, budget=0.5, report=True)
    got, report = got.collect(), report.collect()
    assert len(got) == len(rows)
    by_id = {x[0]: x for x in rows}
    cells = Counter()
    for x in got:
        assert x["_n_tokens"] == len(WORD.findall(by_id[x["doc_id"]][1] or ""))
        cells[x["source"], x["lang"], x["_topic"]] += x["_n_tokens"]
    total, targets = sum(cells.values()), []
    for d in range(3):
        sums = Counter()
        for c, n in cells.items():
            sums[c[d]] += n
        power = {v: n**0.7 for v, n in sums.items()}
        targets.append({v: p / sum(power.values()) for v, p in power.items()})
    want = brute_rake(dict(cells), targets, 0.5)
    for x in got:
        c = (x["source"], x["lang"], x["_topic"])
        assert abs(x["_probability"] - (want[c] / cells[c] if cells[c] else 1.0)) < 1e-6
    expected = {(d, v): sum(want[c] for c in cells if c[k] == v) / total / 0.5 for k, d in enumerate(("source", "lang", "topic")) for v in targets[k]}
    assert {(r["dimension"], r["value"]): round(r["expected"], 6) for r in report} == {k: round(v, 6) for k, v in expected.items()}
    again = mixing.mix(docs, topic, budget=0.5).collect()
    assert {x["doc_id"]: x["_sampled"] for x in got} == {x["doc_id"]: x["_sampled"] for x in again}
    assert mixing.mix(none, topic).count() == 0


def test_mixing_keeps_columns_of_any_name(docs):
    odd = docs.withColumns({"_probability": F.lit(9.0), "_source2": F.lit("a"), "_source": F.lit("b"), "_draw": F.lit(1), "_value": F.lit(2), "tokens": F.lit(3), "a.b": F.lit(4)})
    x = mixing.mix(odd, mixing.topic_of(F.col("text"))).first()
    assert (x["_source2"], x["_source"], x["_draw"], x["_value"], x["tokens"], x["a.b"], x["id"]) == ("a", "b", 1, 2, 3, 4, "clash") and 0 <= x["_probability"] <= 1


def test_raking_meets_marginals(spark):
    cells = spark.createDataFrame([(a, b, c, 1000 + 37 * i) for i, (a, b, c) in enumerate((a, b, c) for a in "xyz" for b in "pq" for c in "mn")], "_source string, _lang string, _topic string, tokens bigint")
    share = lambda d, v: spark.createDataFrame(v, f"{d} string, share double")
    dims = ["_source", "_lang", "_topic"]
    targets = {"_source": share("_source", [("x", 0.5), ("y", 0.3), ("z", 0.2)]), "_lang": share("_lang", [("p", 0.6), ("q", 0.4)]), "_topic": share("_topic", [("m", 0.5), ("n", 0.5)])}
    raked = mixing.rake(cells, dims, targets, 0.3, sweeps=40)
    assert all(x["weight"] <= x["tokens"] + 1e-9 for x in raked.collect())
    got = mixing.residuals(raked, dims, 0.3).collect()
    assert len(got) == 7 and all(abs(r["residual"]) < 1e-6 and not r["too_few"] for r in got)
    scarce = mixing.residuals(mixing.rake(cells, dims, targets | {"_source": share("_source", [("x", 0.98), ("y", 0.01), ("z", 0.01)])}, 0.9, sweeps=40), dims, 0.9).collect()
    assert [r["too_few"] for r in scarce if r["value"] == "x"] == [True] and [r["residual"] for r in scarce if r["value"] == "x"][0] < -0.5


def test_warc(spark, tmp_path):
    html = "<html><head><title>A &amp; B</title><script>x</script></head><body><a href='/c?d=1'>go</a><p>One&nbsp;two</p><p>three</p></body></html>"
    pages = spark.createDataFrame([(1, "https://x.org/a", html), (2, None, None), (1, "https://x.org/a", html)], "page_id bigint, url string, html string")
    responses = warc.responses_of_pages(pages)
    got = warc.derivatives(responses, key="page_id").collect()
    source = {x["page_id"]: x["record_id"] for x in responses.collect()}
    assert len(got) == 6 and all(x["refers_to"] == source[x["page_id"]] and x["digest_ok"] for x in got)
    meta, text = (next(x for x in got if x["page_id"] == 1 and x["record_type"] == k) for k in ("metadata", "conversion"))
    assert text["block"] == "go\nOne two\nthree" and meta["n_links"] == 1 and '"https://x.org/c?d=1"' in meta["block"] and meta["http_status"] == 200
    assert all(x["content_length"] == len(x["block"].encode()) and x["block_digest"] == warc.digest(x["block"].encode()) for x in got)
    raw = b"".join(gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:%d>\r\nWARC-Target-URI: https://y.org/%d\r\nContent-Length: %d\r\n\r\n" % (i, i, len(b)) + b + b"\r\n\r\n") for i, b in enumerate([b"HTTP/1.1 404 No\r\nX: y\r\n\r\n<p>gone</p>", b""]))
    (tmp_path / "a.warc.gz").write_bytes(raw)
    back = warc.derivatives(warc.read_warc(spark, str(tmp_path / "a.warc.gz"))).collect()
    assert {(x["refers_to"], x["http_status"]) for x in back} == {("<urn:uuid:0>", 404), ("<urn:uuid:1>", None)}
    assert warc.write_warc(warc.derivatives(responses), str(tmp_path / "out")) == 6
    files = list((tmp_path / "out").iterdir())
    assert files and all(f.name.endswith(".warc.gz") for f in files)
    found = [x for f in files for x in warc.parse_warc(open(f, "rb"))]
    assert Counter(h["WARC-Type"] for h, _ in found) == {"metadata": 3, "conversion": 3}
    assert all(warc.digest(b) == h["WARC-Block-Digest"] and ("WARC-Target-URI" in h) == (h["WARC-Refers-To"] == source[1]) for h, b in found)


def brute_repeats(rows, window):
    first = {}
    ws = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    for i, w in ws:
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in ws:
        cut = {p for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for p in range(k, k + window)}
        kept = [x for p, x in enumerate(w) if p not in cut]
        out.append((i, len(w), len(cut), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [50_000, 30])
def test_substrings(docs, none, rows, hot):
    got = sorted((x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in substring_dedup.remove_repeats(docs, hot=hot).collect())
    assert got == brute_repeats(rows, 50)
    if hot > 100:
        assert substring_dedup.remove_repeats(none).count() == 0


def brute_near(rows, percent=85):
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall(lower(t))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    comp = {i: i for i in sets}
    changed = True
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            m = min(comp[a], comp[b])
            changed |= comp[a] != m or comp[b] != m
            comp[a] = comp[b] = m
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


@pytest.mark.parametrize("block", [1000, 1, 2])
def test_near_duplicates(docs, none, rows, block):
    want = brute_near(rows)
    got = neardup.near_duplicates(docs, least_block=block, block=block).collect()
    assert len(got) == len(rows)
    assert all((x["n_shingles"], x["component_id"], x["kept"]) == want[x["doc_id"]] for x in got)
    if block > 100:
        assert neardup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("block", [1000, 3])
def test_near_duplicates_of_a_crowd(spark, block):
    """Many texts that share bands, in clusters whose edges are at the threshold: blocks lose no link."""
    r = random.Random(21)
    base, rows = prose(r, 120).split(), []
    for i in range(90):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 2, 3])):
            w[r.randrange(120)] = f"q{r.randrange(12)}"
        rows.append((i, " ".join(w)))
    r.shuffle(rows)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), least_block=block, block=block).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"]) for x in got} == brute_near(rows)


def test_ids_of_other_types_are_refused(spark):
    df = spark.createDataFrame([("a", "b")], "doc_id string, text string")
    for f in (neardup.near_duplicates, substring_dedup.remove_repeats):
        with pytest.raises(ValueError):
            f(df)


def test_near_duplicate_chain(spark):
    """A chain whose ends are not alike is one component, though its smallest member links to one only."""
    r = random.Random(9)
    w, rows = prose(r, 300).split(), []
    order = list(range(12))
    r.shuffle(order)
    for k in range(12):
        rows.append((order[k], " ".join(w)))
        for _ in range(4):
            w[r.randrange(300)] = f"new{k}{r.random()}"
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_near(rows)
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"]) for x in neardup.near_duplicates(docs).collect()} == want


def test_odd_sketches_estimate():
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 62, 400).astype(np.uint64)
    other = base.copy()
    other[:31] = r.integers(0, 1 << 62, 31).astype(np.uint64)  # Jaccard 369 / 431 = 0.856
    a, b = np.sort(base), np.sort(other)
    s = neardup.odd_sketches(neardup.minhashes(np.concatenate([a, b]), np.array([0, 400, 800]), neardup.BANDS * neardup.ROWS))
    assert np.bitwise_count(s[0] ^ s[1]).sum() <= neardup.most_differing_bits(85) < neardup.SKETCH_BITS // 2


def test_site_templates(spark):
    page = lambda i, extra="": f"<html><body><div class=top><b>Site name</b></div><p>Own text number {i} &amp; more.</p><p>Tail {i}<br>line {extra}</p><div><span>Follow us everywhere</span></div></body></html>"
    rows = [(i, "https://h.org/x", page(i)) for i in range(8)]
    rows += [(20, "https://other.org", page(20)), (21, None, None), (22, "https://h.org/y", "")]
    rows += [(30, "https://a.org", "<body><nav>Menu</nav><header>Top</header><article class=post><header><h1>Title</h1></header><p>One<b>two</b> three<p>four<aside>x</aside><div class='comments list'>no</div></article><article class=comment>bad</article><footer>f</footer>")]
    got = {x["page_id"]: x for x in html_main.extract_main(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3]["text"] == "Own text number 3 & more. Tail 3 line" and got[3]["n_chars"] == len(got[3]["text"])
    assert got[20]["text"].startswith("Site name") and got[21]["text"] == "" and got[22]["text"] == ""
    assert got[30]["text"] == "Title Onetwo three four"


def test_repeated_articles_are_no_template(spark):
    rows = [(i, "https://h.org/x", "<nav>m</nav><article><p>Same words on every page.</p></article>") for i in range(9)]
    got = html_main.extract_main(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {x["text"] for x in got} == {"Same words on every page."}


def brute_hits(rows, items):
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    grams = defaultdict(set)
    for name, t in items:
        w = tok(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams[tuple(w[k : k + n])].add(str(name) if name is not None else "")
    out = []
    for i, t, *_ in rows:
        w, hit, names = tok(t), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                g = tuple(w[k : k + n])
                if g in grams:
                    hit.update(range(k, k + n))
                    names |= grams[g]
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 24, 200])
def test_decontamination(spark, docs, none, rows, block):
    items = [(1, " ".join(rows[0][1].split()[5:40])), (2, "One, TWO"), (3, None), (4, "..."), (10, "x x x x x x x x x x x x x x x"), (11, prose(random.Random(77), 30)), (None, " ".join(rows[7][1].split()[:20])), (1, "a b c")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.decontaminate(docs, bench, block_bytes=block)
    assert sorted((x["doc_id"], x["n_words"], x["n_hit"], x["n_items"], x["items_sha256"], x["contaminated"]) for x in got.collect()) == brute_hits(rows, items)
    if block > 1000:
        assert decontam.decontaminate(none, bench).count() == 0
        assert not any(x["contaminated"] for x in decontam.decontaminate(docs, bench.limit(0)).collect())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red apple pie tonight"), (2, "red sweet apple pie tonight"), (3, "pie with no fruit")], "doc_id bigint, text string")
    items = spark.createDataFrame([(5, "red apple")], "item_id bigint, text string")
    got = {x["doc_id"]: x for x in decontam.decontaminate(docs, items, slop=2).collect()}
    assert got[1]["n_items"] == 1 and got[2]["n_items"] == 0 and got[2]["n_near"] == 1 and got[3]["n_near"] == 0


def test_chat_round_trip(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", r"<\|im_end|>", "<", "<|", r"a <\\| b", "<|im_start|>user\nhi<|im_end|>\n", "", None, "\n", "plain\ntext", "trailing <|im_end|>"]
    rows = [(c, k, ("user", "assistant", "tool\n<|x", None)[(c + k) % 4], nasty[(c * 3 + k) % len(nasty)]) for c in range(8) for k in range(5)]
    rows += [(3, 2, "user", "again"), (3, 2, "user", "again"), (None, None, "assistant", "lost")]
    chats = chat.format_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = {x["conv_id"]: x for x in chat.read_back(chats).collect()}
    assert all(x["round_trip"] for x in got.values())
    by = defaultdict(list)
    for c, k, role, t in rows:
        by[c].append((-1 if k is None else k, role or "", t or ""))
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        x = got[c]
        assert (x["n_turns"], x["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (x["loss_chars"], x["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    first = chats.where("conv_id = 0").first()
    for s in first["loss_spans"]:
        raw = first["formatted"][s["start"] : s["start"] + s["length"]]
        assert raw == first["turns"][s["turn"]]["raw"]


def test_chat_of_odd_tables(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, formatted string, turns int, n int"
    none = spark.createDataFrame([], schema)
    assert chat.read_back(chat.format_chats(none)).count() == 0
    long = "<|im_end|> word " * 60_000
    rows = [(1, 0, "user", long, "clash", 1, 2), (1, 1, "assistant", long + "!", "clash", 1, 2), (2, 0, "assistant", "a", "clash", 1, 2), (2, 0, "assistant", "a", "clash", 1, 2)]
    got = {x["conv_id"]: x for x in chat.read_back(chat.format_chats(spark.createDataFrame(rows, schema))).collect()}
    assert got[1]["round_trip"] and got[1]["loss_chars"] == len(long) + 1 and got[1]["loss_sha256"] == hashlib.sha256((long + "!").encode()).hexdigest()
    assert got[2]["n_turns"] == 2 and got[2]["loss_chars"] == 2


def test_one_conversation_of_many_turns(spark):
    """A third of a table may be one conversation: its spans are found in about linear time."""
    n = 20_000
    df = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 1, 'assistant', 'user') AS role", "concat('text ', id, IF(id % 5 = 0, ' <|im_end|>', '')) AS text")
    x = chat.read_back(chat.format_chats(df)).first()
    said = "".join(f"text {i}" + (" <|im_end|>" if i % 5 == 0 else "") for i in range(1, n, 2))
    assert (x["n_turns"], x["loss_chars"], x["round_trip"]) == (n, len(said), True) and x["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_sums_before(spark):
    for k in (0, 1, 2, 511, 512, 513, 1025):
        got = spark.range(1).select(chat.sums_before(F.when(F.lit(k) > 0, F.sequence(F.lit(1), F.lit(max(k, 1)))).otherwise(F.array().cast("array<int>")))).first()[0]
        assert got == [i * (i + 1) // 2 for i in range(k)]


def write_tables(spark, path, rows, labels, items):
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(path / "benchmark.parquet"))


def brute_pipeline(rows, toxic, items):
    """Ids and texts after each of the first three stages, by plain loops; ``toxic`` is the first stage's verdict by text."""
    first = [x for x in rows if x[1] not in toxic]
    sets = lambda t: (lambda w: frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))(WORD.findall(lower(t)))
    texts = sorted({(float("inf") if x[0] is None else x[0], x[1] or "") for x in first})
    comp = {x: x for x in texts}
    pairs = [(a, b) for a in texts for b in texts if a < b and sets(a[1]) and 100 * len(sets(a[1]) & sets(b[1])) >= 85 * len(sets(a[1]) | sets(b[1]))]
    for _ in texts:
        for a, b in pairs:
            comp[a] = comp[b] = min(comp[a], comp[b])
    second = [x for x in texts if comp[x][0] == x[0]]
    hits = {h[0] for h in brute_hits([(k, t) for k, (_, t) in enumerate(second)], items) if h[5]}
    third = [x for k, x in enumerate(second) if k not in hits]
    return [sorted((float("inf") if x[0] is None else x[0], x[1] or "") for x in first), second, third]


def test_pipeline_stages(spark, tmp_path, rows):
    import corpus_pipeline as p

    r = random.Random(3)
    extra = [(500 + i, prose(r, 60) + (" vile nasty" if i % 3 == 0 else ""), "en", "s1", 400) for i in range(60)]
    odd = [(None, prose(r, 30), None, None, None), (None, prose(r, 40), "en", "s1", 1), (None, rows[1][1], "en", "s1", 1), (900, prose(r, 30), "en", "s", 1), (900, rows[2][1], "en", "s", 1), (901, "", "en", "s", 0)]
    all_rows = [x[:5] for x in rows] + extra + odd
    items = [(1, " ".join(rows[0][1].split()[5:40]))]
    write_tables(spark, tmp_path, all_rows, [(500 + i, 1, int(i % 3 == 0)) for i in range(60)], items)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found, sizes = [], [docs.count()]
    for i, (name, stage) in enumerate(p.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if i < 4:
            assert docs.columns == p.COLUMNS
        if i < 3:
            found.append(sorted((float("inf") if x["doc_id"] is None else x["doc_id"], x["text"] or "") for x in docs.collect()))
    toxic = {x[1] for x in extra if "vile" in x[1]}
    want = brute_pipeline(all_rows, toxic, items)
    assert found == want
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > sizes[4] == sizes[5] > 0
    last, mixed = docs.collect(), spark.read.parquet(str(tmp_path / "mixing")).collect()
    assert set(p.COLUMNS) < set(docs.columns) and sorted((tuple(x[c] for c in p.COLUMNS) for x in last), key=str) == sorted((tuple(x) for x in mixed), key=str)
    by = defaultdict(list)
    for x in last:
        by[x["shard"]].append(x["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline as p

    write_tables(spark, tmp_path, [], [], [])
    assert p.run(spark, str(tmp_path)).count() == 0
