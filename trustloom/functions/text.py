"""String expressions: cleaning, words, URLs, identifiers, dates, zones. Column in, Column out.

Words follow Unicode white space; every expression is a built-in one and stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions import lexicons as L
from trustloom.functions.stats import let

#: White space of any kind, written out: Java's own Unicode class is several times slower.
BLANK = r"[\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
SPACE = BLANK + "+"
BANNED = r"[\x00-\x08\x0B\x0C\x0E-\x1F‎‏‪-‮⁦-⁩]"


def listed(names) -> Column:
    """A constant array of strings, as one literal that the optimizer splits once."""
    return F.split(F.lit("\x1f".join(names)), "\x1f")


def strip(text: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}++\z", "")


def words(text: Column) -> Column:
    """Words between runs of white space, without empty ones."""
    return F.array_remove(F.split(text, SPACE), "")


def content_words(lower_words: Column, stop: list[str] | None = None) -> Column:
    """Purely alphabetic words that are no stop words."""
    names = L.STOP_WORDS if stop is None else stop
    return F.filter(lower_words, lambda w: ~w.isin(*names) & w.rlike(r"^\p{L}+$"))  # a hash set, as there are many


def clean_text(value: Column, max_len: int | None = DEFAULT.max_field) -> Column:
    """Null becomes empty; control and direction marks go; blanks collapse; then strip, then cut (None: whole)."""
    text = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), BANNED, "")
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return strip(text) if max_len is None else F.substring(strip(text), 1, max_len)


def count_of(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a fixed string."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / F.lit(len(part))).cast("int")


# --- URLs ------------------------------------------------------------------------------------------


def raw_netloc(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def netloc(url: Column) -> Column:
    """Lower-case authority without any "www."."""
    return F.replace(F.lower(raw_netloc(url)), F.lit("www."), F.lit(""))


def valid_url(url: Column, max_len: int = DEFAULT.max_url) -> Column:
    return F.coalesce(strip(url).rlike(r"^(?i:https?)://[^/?#]+") & (F.length(url) < max_len), F.lit(False))


def clean_url(url: Column) -> Column:
    """Without query, fragment and the parameters of the last path segment."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r";[^/]*$", "")


def region(url: Column) -> Column:
    """Country of the longest listed suffix of the host, else Unknown."""
    host = F.regexp_replace(F.lower(raw_netloc(url)), r"^www\.", "")
    out = F
    for suffix in sorted(L.REGIONS, key=len, reverse=True):
        out = out.when(F.endswith(host, F.lit(f".{suffix}")), L.REGIONS[suffix])
    return out.otherwise("Unknown")


def diversity_key(url: Column) -> Column:
    """Host, with the first path segment on medium.com, where that is the publication."""
    host = netloc(url)
    first = F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"^[^:]+://[^/]*/+([^/]+)", 1)
    return F.when(host.contains("medium.com") & (first != ""), F.concat_ws("/", host, first)).otherwise(host)


def host_suffixes(host: Column) -> Column:
    """The host and all its parent domains: an equi-join key instead of an endswith join."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))


def domain_tier(url: Column) -> Column:
    """2: high authority, 1: medium, 0: neither. Exact domain or a subdomain of it."""
    suffixes = host_suffixes(netloc(url))
    return F.when(F.arrays_overlap(suffixes, listed(L.HIGH_AUTHORITY)), 2).when(F.arrays_overlap(suffixes, listed(L.MEDIUM_AUTHORITY)), 1).otherwise(0)


# --- identifiers, topics, zones ----------------------------------------------------------------------


def record_id(source_type: Column, url: Column) -> Column:
    return F.substring(F.sha2(F.concat(source_type, F.lit(":"), url), 256), 1, 16)


def topic_slug(topic: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(topic), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def safe_topic(topic: Column) -> Column:
    """Control characters to spaces, instruction markers out, blanks collapsed, 200 characters."""
    text = F.regexp_replace(topic, r"[\x00-\x1F\x7F]", " ")
    text = F.regexp_replace(text, L.TOPIC_MARKERS, " ")
    return F.substring(strip(F.regexp_replace(text, SPACE, " ")), 1, 200)


def topic_words(topic: Column) -> Column:
    """Content tokens of a topic in order, repetitions kept."""
    stop = listed(L.STOP_WORDS)
    return F.filter(F.split(F.lower(topic), r"[^a-z0-9]+"), lambda w: (F.length(w) >= 2) & ~F.array_contains(stop, w))


def fallback_terms(topic: Column) -> Column:
    """Terms of a topic that nobody expanded: itself, and its words if there are several."""
    base = F.lower(strip(topic))
    parts = words(base)
    return F.when(F.size(parts) > 1, F.array_distinct(F.concat(F.array(base), parts))).otherwise(F.array(base))


def zones(text: Column) -> Column:
    """Title (first line), first paragraph and body."""

    def cut(t: Column) -> Column:
        return let(
            F.split(t, "\n", 2),
            lambda lines: let(
                F.split(strip(F.coalesce(F.try_element_at(lines, F.lit(2)), F.lit(""))), "\n\n", 2),
                lambda rest: F.struct(F.element_at(lines, 1).alias("title"), F.element_at(rest, 1).alias("first"), F.coalesce(F.try_element_at(rest, F.lit(2)), F.lit("")).alias("body")),
            ),
        )

    return let(strip(text), cut)


def cap_words(text: Column, n: int = DEFAULT.blog_max_words) -> Column:
    """The first ``n`` words; a text that is no longer stays as it is."""
    w = words(text)
    return F.when(F.size(w) > n, F.array_join(F.slice(w, 1, n), " ")).otherwise(text)


def tier_name(score: Column, s: Settings = DEFAULT) -> Column:
    out = F
    for least, name in s.tiers:
        out = out.when(score >= least, name)
    return out.otherwise(s.tier_rest)


# --- dates -------------------------------------------------------------------------------------------


def parse_date(value: Column) -> Column:
    """Timestamp without zone: the first form that fits, each read from a prefix of fixed length.

    Any ISO date is cut to its day. RFC-822 dates with a numeric offset are turned to UTC; a named zone
    is read over. Week days are only looked at for their shape.
    """
    text = strip(value)
    stamp = lambda x, fmt: F.try_to_timestamp(x, F.lit(fmt))
    day = r"^(?i:mon|tue|wed|thu|fri|sat|sun), "
    rest = F.regexp_replace(text, day, "")
    is_rfc = text.rlike(day)
    fixed = lambda n: F.regexp_replace(F.substring(text, 1, n), day, "")
    offset = F.regexp_extract(rest, r"([+-])(\d{2}):?(\d{2})$", 0)
    minutes = (F.try_element_at(F.regexp_extract_all(offset, F.lit(r"(\d{2})"), 1), F.lit(1)).cast("int") * 60 + F.try_element_at(F.regexp_extract_all(offset, F.lit(r"(\d{2})"), 1), F.lit(2)).cast("int")) * F.when(
        F.startswith(offset, F.lit("-")), -1
    ).otherwise(1)
    local = stamp(F.trim(F.regexp_replace(rest, r"[+-]\d{2}:?\d{2}$", "")), "d MMM yyyy HH:mm:ss")
    forms = [
        stamp(F.substring(text, 1, 10), "yyyy-MM-dd"),
        stamp(F.substring(text, 1, 10), "yyyy/MM/dd"),
        F.when(is_rfc & (offset != ""), local - F.make_interval(mins=minutes)),
        F.when(is_rfc, stamp(fixed(25), "d MMM yyyy HH:mm:ss")),
        F.when(is_rfc, stamp(fixed(16), "d MMM yyyy")),
        stamp(text, "MMMM d, yyyy"),
        stamp(text, "d MMMM yyyy"),
        stamp(text, "MMM d, yyyy"),
        stamp(text, "yyyy MMM d"),
        stamp(text, "yyyy MMM"),
        F.when(F.substring(text, 1, 4).rlike(r"^\d{4}$"), stamp(F.substring(text, 1, 4), "yyyy")),
    ]
    return F.when(~F.coalesce(F.lower(value), F.lit("")).isin(*L.MISSING_DATES), F.coalesce(*forms)).cast("timestamp_ntz")


def age_days(published: Column, as_of: str = DEFAULT.as_of) -> Column:
    """Whole days from ``published`` to ``as_of``, rounded down."""
    seconds = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(published.cast("timestamp"))
    return F.floor(seconds / 86400).cast("int")


def seconds_of(iso: Column) -> Column:
    """ISO-8601 PT#H#M#S in seconds; 0 if the text does not begin so."""
    part = lambda unit: F.coalesce(F.nullif(F.regexp_extract(iso, rf"^PT(?=[0-9])(?:[0-9]+H)?(?:[0-9]+M)?(?:[0-9]+S)?", 0), F.lit("")), F.lit(""))  # noqa: E731, F541
    head = part("")
    unit = lambda u: F.coalesce(F.nullif(F.regexp_extract(head, rf"([0-9]+){u}", 1), F.lit("")).cast("long"), F.lit(0))
    return unit("H") * 3600 + unit("M") * 60 + unit("S")
