"""Line-first cleaning (native): judge every line, drop the failing ones, then judge what is left.

Defined cases: a null or empty text has no words, so every count is 0, ``base_failed`` is true and
``kept`` false. Lines without a word are neither judged nor counted. Repeated rows are judged one by
one, each on its own text. Columns of the input beyond the id and the text are ignored, whatever
their names; texts of any length are judged whole; an empty table gives no rows. Words are maximal runs of characters other than space and U+0009 to U+000D.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustloom.functions.features import once
from trustloom.functions.stats import let
from trustloom.llm.common import SPACES

#: The base rule of the contract.
MIN_WORDS = 10
MAX_REPEAT_SHARE = 20
REPEAT_WINDOW = 5
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the verdict on the document. Phrases are in English, German, French and Spanish."""

    #: A line this short or shorter without closing punctuation fails (a heading, a menu entry).
    short_words: int = 3
    #: Marks that end a sentence or lead to what follows, and quotes and brackets after them.
    closing: str = r"[.!?:;…。！？][\"'”’»)\]}]*$"
    #: Symbols per 100 word characters from which a line fails.
    max_symbol_percent: int = 10
    #: A navigation line has at least two separators and at most this many words between two of them.
    words_per_separator: int = 4
    separators: tuple = ("|", "»", "›", ">", "·", "•", "/")
    #: Lines of at most so many words that say nothing but one of these, in lower case, are navigation.
    navigation_words: int = 6
    navigation: str = (
        r"^\W*(home|menu|log ?in|sign (in|up)|next|previous|back to top|read more|click here|share this|search|"
        r"startseite|menü|anmelden|weiter|zurück|nach oben|mehr lesen|hier klicken|teilen|suche|"
        r"accueil|connexion|suivant|précédent|haut de page|lire la suite|cliquez ici|partager|recherche|"
        r"inicio|menú|iniciar sesión|siguiente|anterior|volver arriba|leer más|haga clic aquí|compartir|buscar)\W*$"
    )
    #: Lines with one of these phrases, in lower case, are boilerplate.
    boilerplate: tuple = (
        "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use of cookies", "enable javascript", "lorem ipsum", "powered by", "licensed under", "copyright ©", "copyright (c)",
        "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "cookie-richtlinie", "verwendung von cookies", "javascript aktivieren",
        "tous droits réservés", "conditions d'utilisation", "politique de confidentialité", "politique de cookies", "utilisation de cookies", "activer javascript",
        "todos los derechos reservados", "términos de uso", "condiciones de uso", "política de privacidad", "política de cookies", "uso de cookies", "activar javascript",
    )
    #: Percent of the word characters that may go with the failing lines.
    max_lost_percent: int = 60


def _spaces_out(text: Column) -> Column:
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def _count(text: Column, marks: str) -> Column:
    """Occurrences of ASCII characters, each from lengths in bytes."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in marks), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of ``text`` in order; without a regular expression, which is the dear part on long texts."""
    return F.array_remove(F.split(_spaces_out(text), " ", -1), "")


def word_chars_of(text: Column) -> Column:
    return (F.length(text) - _count(text, SPACES)).cast("long")


def symbols_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long")


def has_phrase(text: Column, rules: LineRules) -> Column:
    return let(F.lower(text), lambda low: reduce(or_, (F.contains(low, F.lit(p)) for p in rules.boilerplate)))


def line_fails(line: Column, rules: LineRules, suspect: Column | None = None) -> Column:
    """Whether a line (with at least one word) breaks a punctuation, navigation or boilerplate rule.

    ``suspect``: whether the text has a boilerplate phrase at all, if that is known.
    """

    def judged(words: Column) -> Column:
        n_words = F.size(words)
        closed = F.rtrim(line, F.lit(SPACES)).rlike(rules.closing)
        separators = F.size(F.filter(words, lambda w: w.isin(*rules.separators)))
        phrase = has_phrase(line, rules)
        return (
            ((n_words <= rules.short_words) & ~closed)
            | (F.lit(100) * symbols_of(line) > F.lit(rules.max_symbol_percent) * word_chars_of(line))
            | ((separators >= 2) & (n_words <= rules.words_per_separator * (separators + 1)))
            | ((n_words <= rules.navigation_words) & F.lower(line).rlike(rules.navigation))
            | (phrase if suspect is None else suspect & phrase)
        )

    return let(words_of(line), judged)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: the counts, the cleaned text and the verdict.

    No shuffle: everything is a projection over the row, so a document's windows are compared inside
    it and the plan is as wide as the scan. The repeated windows are found by sorting (hash, position)
    pairs, and only for documents in which some hash occurs twice.
    """
    text = F.coalesce(F.col("_t"), F.lit(""))
    df = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("_t"))
    df = df.select(id_col, text.alias("_t"))
    df = df.withColumn("_w", words_of(F.col("_t"))).withColumn("n_words", F.size("_w").cast("long"))
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w))).drop("_w")
    k = REPEAT_WINDOW
    windows = F.when(
        F.col("n_words") > k,
        F.transform(
            F.sequence(F.lit(1), F.col("n_words").cast("int") - (k - 1)),
            lambda i: F.xxhash64(*[F.element_at("_h", i + j) for j in range(k)]),
        ),
    )
    df = df.withColumn("_g", windows).drop("_h")
    # positions of windows whose hash stands at least twice, ascending
    pairs = F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.withColumn("_p", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), pairs)).drop("_g")
    n = F.size("_p")
    gs = F.transform("_p", lambda p: p["g"])
    df = df.withColumn(
        "_p",
        F.when(
            F.col("_p").isNotNull(),
            F.sort_array(
                F.transform(
                    F.filter(
                        F.zip_with(
                            "_p",
                            F.zip_with(
                                F.concat(F.array(F.lit(None).cast("long")), F.slice(gs, F.lit(1), n - 1)),
                                F.concat(F.slice(gs, F.lit(2), n - 1), F.array(F.lit(None).cast("long"))),
                                lambda a, b: F.struct(a.alias("a"), b.alias("b")),
                            ),
                            lambda p, ab: F.struct(p["i"].alias("i"), (p["g"].eqNullSafe(ab["a"]) | p["g"].eqNullSafe(ab["b"])).alias("d")),
                        ),
                        lambda x: x["d"],
                    ),
                    lambda x: x["i"],
                )
            ),
        ),
    )
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(-k).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(k), p - acc["last"])).alias("n")),
        lambda acc: acc["n"].cast("long"),
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_p")

    df = df.withColumn("_l", F.filter(F.split("_t", "\n", -1), lambda s: F.btrim(s, F.lit(SPACES)) != ""))
    df = df.withColumn("word_chars", word_chars_of(F.col("_t"))).withColumn("n_symbols", symbols_of(F.col("_t")))
    df = df.withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
    df = once(df, _b=has_phrase(F.col("_t"), rules))  # once a text, not once a line
    df = df.withColumn("_k", F.filter("_l", lambda s: ~line_fails(s, rules, F.col("_b"))))
    df = df.withColumn("clean_text", F.array_join("_k", "\n")).withColumn("n_lines_removed", (F.size("_l") - F.size("_k")).cast("long"))
    df = df.withColumn("kept_chars", word_chars_of(F.col("clean_text")))
    df = df.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_SHARE) * F.col("n_words")),
    )
    lost = F.lit(100) * (F.col("word_chars") - F.col("kept_chars"))
    df = df.withColumn("kept", ~F.col("base_failed") & (lost <= F.lit(rules.max_lost_percent) * F.col("word_chars")))
    return df.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed", "kept_chars", "clean_text"
    )
