"""Topic relevance: anchor word, hit count, density, and an optional vector gate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions.text import topic_words, words


def anchor_pattern(word: Column) -> Column:
    """A pattern for a word and its forms: long words by stem, plurals with their singular, else exact."""
    n = F.length(word)
    safe = lambda x: F.regexp_replace(x, r"([\\.\[\]{}()*+?^$|\-])", r"\\$1")
    stem = F.substr(word, F.lit(1), F.greatest(F.lit(5), n - 3))
    single = F.substr(word, F.lit(1), n - 1)
    plural = (n > 4) & F.endswith(word, F.lit("s")) & ~F.endswith(word, F.lit("ss"))
    return (
        F.when(n >= 7, F.concat(F.lit(r"(?U)\b"), safe(stem), F.lit(r"\w*\b")))
        .when(plural, F.concat(F.lit(r"(?U)\b(?:"), safe(word), F.lit("|"), safe(single), F.lit(r")\b")))
        .otherwise(F.concat(F.lit(r"(?U)\b"), safe(word), F.lit(r"\b")))
    )


def hits(text: Column, topic: Column, terms: Column) -> Column:
    """Occurrences of the phrases (fixed strings) and of the single words (by pattern), each word once."""
    low = F.lower(text)
    lowered = F.transform(terms, F.lower)
    phrases = F.filter(lowered, lambda t: F.contains(t, F.lit(" ")))
    singles = F.array_distinct(F.concat(topic_words(topic), F.filter(lowered, lambda t: ~F.contains(t, F.lit(" ")) & (t != ""))))
    by_phrase = F.aggregate(phrases, F.lit(0), lambda a, t: a + ((F.length(low) - F.length(F.replace(low, t, F.lit("")))) / F.length(t)).cast("int"))
    return by_phrase + F.aggregate(singles, F.lit(0), lambda a, w: a + F.regexp_count(low, anchor_pattern(w)))


def has_anchor(text: Column, topic: Column) -> Column:
    """The first content word of the topic is in the text, in some form; a topic without one passes."""
    first = F.try_element_at(topic_words(topic), F.lit(1))
    return first.isNull() | (F.regexp_count(F.lower(text), anchor_pattern(first)) > 0)


def relevant(text: Column, topic: Column, terms: Column, similarity: Column | None = None, s: Settings = DEFAULT) -> Column:
    n = F.size(words(text))
    total = hits(text, topic, terms)
    ok = (n > 0) & has_anchor(text, topic) & (total >= s.relevance_hits) & (total / F.greatest(n, F.lit(1)) >= s.relevance_density)
    if similarity is not None:
        ok = ok & (similarity.isNull() | (similarity >= s.semantic_similarity))
    return F.coalesce(ok, F.lit(False))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null for null, empty or zero ones."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) > 0) & (norm > 0), dot(a, b) / norm)
