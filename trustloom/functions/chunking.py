"""Sentence-aligned chunks with overlap and quality, as one expression per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions import lexicons as L
from trustloom.functions import stats
from trustloom.functions.features import once
from trustloom.functions.text import BLANK, SPACE, content_words, strip, words

SENTENCE = f"(?<=[.!?]){SPACE}"
_RUN = "struct<a:int,b:int,long:boolean>"


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(strip(text), SENTENCE), strip), lambda s: s != "")


def runs(sizes: Column, max_words: int = DEFAULT.chunk_max_words) -> Column:
    """Greedy runs (a, b, long) of sentences by their word counts alone: at most ``max_words`` words a run,
    and a sentence with more is a run of its own, marked long. Places count from 1."""

    def closed(acc: Column) -> Column:
        return F.when(acc["n"] > 0, F.concat(acc["out"], F.array(F.struct(acc["at"].alias("a"), acc["i"].alias("b"), F.lit(False).alias("long"))))).otherwise(acc["out"])

    def state(i: Column, n, at: Column, out: Column) -> Column:
        return F.struct(i.alias("i"), (F.lit(n) if isinstance(n, int) else n).alias("n"), at.alias("at"), out.alias("out"))

    def step(acc: Column, n: Column) -> Column:
        i = acc["i"] + 1
        alone = F.array(F.struct(i.alias("a"), i.alias("b"), F.lit(True).alias("long")))
        return (
            F.when(n > max_words, state(i, 0, i + 1, F.concat(closed(acc), alone)))
            .when(acc["n"] + n <= max_words, state(i, acc["n"] + n, acc["at"], acc["out"]))
            .otherwise(state(i, n, i, closed(acc)))
        )

    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("n"), F.lit(1).alias("at"), F.array().cast(f"array<{_RUN}>").alias("out"))
    return F.aggregate(sizes, zero, step, closed)


def pack(docs: DataFrame, text_col: str, out_col: str, max_words: int = DEFAULT.chunk_max_words) -> DataFrame:
    """Adds raw chunks as (t, w): text and words. Sentences are joined by a space; a long one is cut by words.

    Every word is split off its text once; all later steps work on the word arrays.
    """
    df = once(docs, _s=sentences(F.coalesce(F.col(text_col), F.lit(""))))
    df = once(df, _n=F.transform("_s", lambda s: F.size(words(s))))
    df = once(df, _r=runs(F.col("_n"), max_words))
    pieces = F.transform("_r", lambda r: F.struct(F.array_join(F.slice("_s", r["a"], r["b"] - r["a"] + 1), " ").alias("t"), r["long"].alias("long")))
    df = once(df, _p=pieces)
    split = F.transform("_p", lambda p: F.struct(p["t"].alias("t"), words(p["t"]).alias("w"), p["long"].alias("long")))
    df = once(df, _w=split)

    def cut(p: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.size(p["w"]), F.lit(max_words)), lambda i: F.slice(p["w"], i, F.lit(max_words)))
        return F.transform(parts, lambda w: F.struct(F.array_join(w, " ").alias("t"), w.alias("w")))

    whole = lambda p: F.array(F.struct(p["t"].alias("t"), p["w"].alias("w")))
    df = once(df, **{out_col: F.flatten(F.transform("_w", lambda p: F.when(p["long"], cut(p)).otherwise(whole(p))))})
    return df.drop("_s", "_n", "_r", "_p", "_w")


def ends_sentence(text: Column) -> Column:
    return text.rlike(rf"(?:[.!?]|\.\"){BLANK}*+\z")


def quality(text: Column, n: Column, distinct: Column, sorted_content: Column) -> Column:
    """Lexical diversity, completeness and absence of one dominating word; rounded to 3 places.

    ``n`` words, ``distinct`` ones in lower case, and the sorted content words. A word dominates with more
    than a tenth of the content words.
    """
    m = F.size(sorted_content)
    even = F.when((m > 0) & stats.some_run(sorted_content, F.floor(m / 10).cast("int") + 1), 0.0).otherwise(1.0)
    ends = F.when(ends_sentence(text), 1.0).otherwise(0.5)
    return F.when(n < 3, 0.0).otherwise(F.round(distinct / n * 0.5 + ends * 0.3 + even * 0.2, 3))


def chunk(docs: DataFrame, text_col: str = "text", out_col: str = "content_chunks", s: Settings = DEFAULT, content_col: str | None = None) -> DataFrame:
    """Adds ``out_col``: array of (text, chunk_index, total_chunks, quality_score, has_overlap, word_count).

    ``content_col``: adds ``assemble(out_col)`` too, from the words at hand.

    Short raw chunks go first; the overlap is taken from the raw chunk before, whether or not that one
    is kept; chunks below the quality floor go last, and the rest is numbered.
    """
    df = pack(docs, text_col, "_all", s.chunk_max_words)
    df = once(df, _raw=F.filter("_all", lambda c: F.size(c["w"]) >= s.chunk_min_words))

    def overlapped(c: Column, i: Column) -> Column:
        before = F.element_at("_raw", F.greatest(i, F.lit(1)))["w"]
        tail = F.slice(before, F.greatest(F.size(before) - s.chunk_overlap + 1, F.lit(1)), F.lit(s.chunk_overlap))
        return F.when(i == 0, F.struct(c["t"].alias("t"), c["w"].alias("w"), F.lit(False).alias("o"))).otherwise(
            F.struct(F.concat(F.array_join(tail, " "), F.lit(" "), c["t"]).alias("t"), F.concat(tail, c["w"]).alias("w"), F.lit(True).alias("o"))
        )

    df = once(df, _with=F.transform("_raw", overlapped))
    df = once(df, _low=F.transform("_with", lambda c: F.transform(c["w"], F.lower)))
    df = once(df, _content=F.transform("_low", lambda w: F.sort_array(content_words(w, L.CHUNK_STOP_WORDS))))

    def judged(c: Column, i: Column) -> Column:
        q = quality(c["t"], F.size(c["w"]), F.size(F.array_distinct(F.element_at("_low", i + 1))), F.element_at("_content", i + 1))
        n = F.size(c["w"])
        body = F.when(c["o"] & (n > s.chunk_overlap), F.array_join(F.slice(c["w"], F.lit(s.chunk_overlap + 1), F.greatest(n - s.chunk_overlap, F.lit(0))), " ")).otherwise(c["t"])
        more = [body.alias("body")] if content_col else []
        return F.struct(c["t"].alias("text"), c["o"].alias("has_overlap"), n.alias("n"), q.alias("q"), *more)

    df = once(df, _q=F.transform("_with", judged))
    df = once(df, _kept=F.filter("_q", lambda c: c["q"] >= s.chunk_quality))
    out = F.transform(
        "_kept",
        lambda c, i: F.struct(
            c["text"].alias("text"),
            i.alias("chunk_index"),
            F.size("_kept").alias("total_chunks"),
            c["q"].alias("quality_score"),
            c["has_overlap"].alias("has_overlap"),
            c["n"].alias("word_count"),
        ),
    )
    if content_col:
        df = once(df, **{content_col: F.array_join(F.transform("_kept", lambda c: c["body"]), "\n\n")})
    return once(df, **{out_col: out}).drop("_all", "_raw", "_with", "_low", "_content", "_q", "_kept")


def fallback_chunk(text: Column, source_type: Column, s: Settings = DEFAULT) -> Column:
    """The one chunk of a text for which the chunker gave none."""
    q = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in s.chunk_fallback.items() for x in kv]), source_type), F.lit(s.chunk_fallback["blog"]))
    return F.array(
        F.struct(
            text.alias("text"), F.lit(0).alias("chunk_index"), F.lit(1).alias("total_chunks"), q.alias("quality_score"), F.lit(False).alias("has_overlap"), F.size(words(text)).alias("word_count")
        )
    )


def assemble(chunks: Column, overlap: int = DEFAULT.chunk_overlap) -> Column:
    """Text that is scored: chunks without their overlap, joined by blank lines."""

    def body(c: Column) -> Column:
        w = words(c["text"])
        return F.when(c["has_overlap"] & (F.size(w) > overlap), F.array_join(F.slice(w, overlap + 1, F.greatest(F.size(w) - overlap, F.lit(0))), " ")).otherwise(c["text"])

    return F.array_join(F.transform(chunks, body), "\n\n")
