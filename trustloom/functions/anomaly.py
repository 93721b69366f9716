"""Anomaly flags of a text, in fixed order, as one array expression over ``with_features`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions import lexicons as L
from trustloom.functions import stats
from trustloom.functions.text import count_of, strip, words


def stuffing_threshold(vocabulary: Column, s: Settings = DEFAULT) -> Column:
    """Share of the top word from which a text is stuffed: lower for larger vocabularies."""
    return F.least(F.lit(s.stuffing_max), F.greatest(F.lit(s.stuffing_base), F.lit(s.stuffing_k) / F.ln(F.greatest(vocabulary, F.lit(2)))))


def stuffed(source_type: Column, s: Settings = DEFAULT) -> Column:
    share = F.col("_top.n") / F.size("_content_words")
    return (F.col("_n") >= s.stuffing_min_words) & (source_type != "pubmed") & (F.size("_content_words") > 0) & (share > stuffing_threshold(F.size("_ccounts"), s))


def top_share() -> Column:
    return F.when(F.size("_content_words") > 0, F.col("_top.n") / F.size("_content_words"))


def corrupt_marks(text: Column) -> Column:
    return count_of(text, "â€") + count_of(text, "Ã")


def link_share(text: Column) -> Column:
    urls = F.when(F.contains(text, F.lit("://")), F.regexp_extract_all(text, F.lit(L.URL), 0)).otherwise(F.array().cast("array<string>"))
    return F.aggregate(urls, F.lit(0), lambda a, u: a + F.length(u)) / F.greatest(F.length(text), F.lit(1))


def paragraph_sizes(text: Column, delimiter: str = "\n\n") -> Column:
    return F.filter(F.transform(F.split(text, delimiter), lambda p: F.size(words(p))), lambda n: n > 0)


def templated(sizes: Column, s: Settings = DEFAULT) -> Column:
    """Many paragraphs of nearly one length."""

    def even(x: Column) -> Column:
        n = F.size(x)
        mean = F.aggregate(x, F.lit(0.0), lambda a, k: a + k) / n
        var = F.aggregate(x, F.lit(0.0), lambda a, k: a + k * k) / n - mean * mean
        return (n >= s.template_min_paras) & (mean > s.template_min_mean) & (F.sqrt(F.greatest(var, F.lit(0.0))) / mean < s.template_cv)

    return stats.let(sizes, even)


def flags(text: Column, source_type: Column, s: Settings = DEFAULT) -> Column:
    """All flags of a text; needs ``with_features`` columns of the same row."""
    year = int(s.as_of[:4])
    facts = F.struct(
        F.regexp_count(text, F.lit(L.PROMO)).alias("promo"),
        corrupt_marks(text).alias("corrupt"),
        F.when(F.col("_n") >= s.entropy_min_words, stats.entropy(F.col("_counts"), F.col("_n"))).alias("h"),
        F.try_element_at(F.filter(F.regexp_extract_all(text, F.lit(L.YEAR), 1), lambda y: y.cast("int") > year), F.lit(1)).alias("late"),
        stuffed(source_type, s).alias("stuffed"),
        F.length(text).alias("chars"),
    )
    limit = F.when(source_type == "youtube", s.link_density_youtube).otherwise(s.link_density)

    def found(f: Column) -> Column:
        promo_flag = F.format_string("promotional_language:%d_hits", f["promo"])
        corrupt_flag = F.format_string("encoding_corruption:%d_chars", f["corrupt"])
        thin = F.array(F.lit("thin_content"), F.when(f["promo"] >= s.promo_hits, promo_flag), F.when(f["corrupt"] > 0, corrupt_flag))
        full = F.array(
            F.when(f["h"] < s.entropy_low, F.format_string("low_entropy:%.2f", f["h"])),
            F.when(f["stuffed"], F.format_string("keyword_stuffing:%s:%.3f", F.col("_top.w"), top_share())),
            F.when(f["promo"] >= F.greatest(F.lit(s.promo_hits), F.floor(F.col("_n") / s.promo_divisor).cast("int")), promo_flag),
            F.when(link_share(text) > limit, F.lit("high_link_density")),
            F.when(F.regexp_count(text, F.lit(L.CAPS)) / F.greatest(F.col("_n"), F.lit(1)) > s.caps_density, F.lit("excessive_caps")),
            F.when(f["late"].isNotNull(), F.concat(F.lit("future_year_reference:"), f["late"])),
            F.when((f["corrupt"] > s.corruption_floor) | (f["corrupt"] / F.greatest(f["chars"], F.lit(1)) > s.corruption_ratio), corrupt_flag),
            F.when(templated(paragraph_sizes(text), s), F.lit("templated_paragraphs")),
        )
        return F.array_compact(F.when(f["chars"] < s.thin_chars, thin).otherwise(full))

    return stats.let(facts, found)


def repeated_sentences(text: Column) -> Column:
    """Share of sentences equal to the one before."""
    sents = F.filter(F.transform(F.split(text, r"[.!?]+"), lambda x: F.lower(strip(x))), lambda x: x != "")
    same = F.size(F.filter(F.zip_with(sents, F.slice(sents, F.lit(2), F.greatest(F.size(sents) - 1, F.lit(0))), lambda a, b: a == b), lambda x: F.coalesce(x, F.lit(False))))
    return F.struct(F.size(sents).alias("n"), (same / F.greatest(F.size(sents) - 1, F.lit(1))).alias("share"))


def language_windows(text: Column, language, s: Settings = DEFAULT) -> Column:
    """Share of sampled windows in another than the most frequent language; ``language`` maps a Column."""
    size, n = s.transcript_window, s.transcript_windows
    step = F.greatest(F.lit(1), F.floor((F.length(text) - size) / max(n - 1, 1)).cast("int"))
    windows = F.filter(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.substr(text, i * step + 1, F.lit(size))), lambda x: F.length(x) >= 20)
    langs = F.transform(windows, lambda x: language(x))
    top = F.array_max(F.transform(langs, lambda x: F.size(F.filter(langs, lambda y: x == y))))  # a handful of windows
    return F.when(F.size(langs) > 0, (F.size(langs) - top) / F.size(langs)).otherwise(0.0)


def transcript_flags(text: Column, language=None, s: Settings = DEFAULT) -> Column:
    """Flags of a spoken text. Without a language function all windows are of one language."""
    noise = F.regexp_count(text, F.lit(r"\[[^\]]{1,30}\]")) / F.greatest(F.size(words(text)), F.lit(1))
    rep = repeated_sentences(text)
    other = language_windows(text, language, s) if language else F.lit(0.0)
    found = F.array(
        F.when(noise > s.transcript_noise, F.format_string("transcript_high_noise:%.2f", noise)),
        F.when((rep["n"] >= s.transcript_min_sentences) & (rep["share"] > s.transcript_repetition), F.format_string("transcript_repetition:%.2f", rep["share"])),
        F.when(other > s.transcript_inconsistency, F.format_string("transcript_language_inconsistency:%.2f", other)),
    )
    return F.when(F.length(text) < s.thin_chars, F.array().cast("array<string>")).otherwise(F.array_compact(found))
