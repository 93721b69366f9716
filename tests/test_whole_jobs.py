"""Queries over all of their rows and all of each row, against plain Python."""

import hashlib
import re

import duckdb

import trustloom.plans.queries  # noqa: F401  registers its queries
from trustloom.plans.registry import ORACLE, QUERIES

ODD = [
    "Été À LA plage: NASA et l'ÉCOLE, ÉTUDES. le la LE LA le la",
    "NASA NASA,UNESCO ÉNASA NASAé naïve_NASA NASA2 NASA",
    "Der Titel und die Straße\n\nThe first and the last\n\nauf in In IN et und the",
    "thent thents hation hationé éhation hation_x of the of the thentß",
    "", None, "  \n ", "日本 NASA 日本NASA 日本", "the the  and", "x",
]


def documents(spark, tmp_path, texts):
    rows = [(i, x, ("en", "fr", "de", None)[i % 4]) for i, x in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_texts_are_cleaned_beyond_200_characters(spark, tmp_path):
    texts = [*ODD, "a" * 300 + "\x07 \t b\n\n\n\nc‮d  ", " " + "wort é " * 5000 + " ", "z" * 50_010]
    sf = documents(spark, tmp_path, texts)
    got = {r["doc_id"]: r["cleaned"] for r in QUERIES["cleaned_text"](spark, sf).collect()}

    def clean(x):
        x = re.sub(r"[\x00-\x08\x0B\x0C\x0E-\x1F‎‏‪-‮⁦-⁩]", "", x or "")
        return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", x)).strip()

    assert got == {i: clean(x) for i, x in enumerate(texts)}
    assert len(got[len(ODD) + 1]) == 34_999 and len(got[len(ODD) + 2]) == 50_010


# Word characters of the texts above are alike in Python's and Java's Unicode patterns.


def test_shouting_is_counted_in_all_languages(spark, tmp_path):
    sf = documents(spark, tmp_path, ODD)
    got = {r["doc_id"]: (r["shouted"], r["density"]) for r in QUERIES["caps_density"](spark, sf).where("doc_id <> 5").collect()}
    want = {i: len(re.findall(r"\b[A-Z]{4,}\b", x)) for i, x in enumerate(ODD) if x is not None}
    assert got == {i: (n, round(n / max(len(ODD[i].split()), 1), 5)) for i, n in want.items()}
    assert want[0] == 1 and want[1] == 4 and want[7] == 1


def test_documents_of_all_languages_are_tagged(spark, tmp_path):
    sf = documents(spark, tmp_path, ODD)
    got = {r["doc_id"]: r["tags"] for r in QUERIES["positional_tags"](spark, sf).collect()}

    def tags(x):
        title, _, rest = (x or "").strip().partition("\n")
        first, _, body = rest.strip().partition("\n\n")
        out = []
        for i, (label, keys, boost) in enumerate([("articles", ("the", "le la"), 1.0), ("links", ("and", "und", "et"), 0.9), ("places", ("in", "auf"), 1.2), ("rare", ("zzz",), 1.0)]):
            score = sum(sum(len(re.findall(rf"\b{k}\b", z.lower())) for k in keys) / len(z.split()) * w for z, w in ((title, 3.0), (first, 1.5), (body, 1.0)) if z.split()) * boost
            out += [(-score, i, label)] if score else []
        return ",".join(x for _, _, x in sorted(out)) or "general"

    assert got == {i: tags(x) for i, x in enumerate(ODD)}
    assert got[0] == "articles,links" and got[2] == "links,articles,places"


def test_relevance_of_documents_of_all_languages(spark, tmp_path):
    sf = documents(spark, tmp_path, ODD)
    got = {r["doc_id"]: (r["hits"], r["relevant"]) for r in QUERIES["topic_relevance"](spark, sf).where("doc_id <> 5").collect()}
    for i, x in enumerate(ODD):
        if x is not None:
            low = x.lower()
            stem = len(re.findall(r"\bhation\w*\b", low))
            n = stem + len(re.findall(r"\b(?:thents|thent)\b", low)) + low.count("of the")
            assert got[i] == (n, stem > 0 and n >= 2 and n / len(x.split()) >= 0.003)
    assert got[3] == (7, True)


def by_sql(sf, name, table):
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet/*.parquet')")
        return dict(con.execute(ORACLE[name]).fetchall())


def test_article_texts_keep_references_without_semicolon(spark, tmp_path):
    bodies = {
        "<h1>a&amp;&amp;b&amp</h1><p>c&am</p>": "a&&b&amp\n\nc&am",
        "<p>x&quot y&amp;lt; &copy2 &copy;</p>": "x&quot y&lt; &copy2 ©",
        "<p>&ampere; &notit; & && &; &amp=1 &lt;b&gt</p>": "&ampere; &notit; & && &; &amp=1 <b&gt",
        "<p>&amp;amp</p><p>&amp;amp;</p>&amp": "&amp\n\n&amp;\n\n&amp",
    }
    rows = [(i, f"<html><title>t&amp</title><body><article>{x}</article></body></html>") for i, x in enumerate(bodies)]
    spark.createDataFrame(rows, "page_id bigint, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["body_md5"] for r in QUERIES["html_articles"](spark, str(tmp_path)).collect()}
    assert got == {i: hashlib.md5(x.encode()).hexdigest() for i, x in enumerate(bodies.values())}
    assert got == by_sql(tmp_path, "html_articles", "pages")


def test_tags_of_equal_scores_keep_taxonomy_order(spark, tmp_path):
    def text(n, **words):
        return "title\n" + " ".join([w for w, k in words.items() for _ in range(k)] + ["x"] * (n - sum(words.values())))

    # the scores of "and" (0.9) and "in" (1.2), or of "the" (1.0), are equal fractions; the last bits of their doubles differ
    texts = [text(187, **{"and": 4, "in": 3}), text(478, **{"and": 32, "in": 24}), text(153, the=6, **{"in": 5}), text(110, the=9, **{"and": 10}), text(187, **{"and": 3, "in": 4})]
    sf = documents(spark, tmp_path, texts)
    got = {r["doc_id"]: r["tags"] for r in QUERIES["positional_tags"](spark, sf).collect()}
    assert got == {0: "links,places", 1: "links,places", 2: "articles,places", 3: "articles,links", 4: "places,links"}
    assert got == by_sql(sf, "positional_tags", "documents")
