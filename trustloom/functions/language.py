"""Language of a text: a rule for short ones, and a detector that can be exchanged.

A detector maps a Column of text to a Column of codes, null where it cannot tell. The fallback for short
texts and for null is English.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustloom.functions.stats import let
from trustloom.functions.text import words

FALLBACK = "en"
MIN_CHARS, MAX_CHARS = 20, 2000
Detector = Callable[[Column], Column]

#: Frequent function words that are rare in the other languages listed.
FUNCTION_WORDS = {
    "en": "the and of to that is with for this was are it".split(),
    "de": "der und die nicht das ist ein mit auf sich den von".split(),
    "fr": "le les et des est une dans pour que qui pas avec".split(),
    "es": "el los y una por con para las del más como su".split(),
    "it": "il di che gli per una sono della non più anche ha".split(),
    "pt": "o os não uma para com em mais dos são ao pelo".split(),
    "nl": "het een van niet dat zijn op te voor met ook aan".split(),
}


def _held(code: str, names: list[str], ord_: int):
    def score(w: Column) -> Column:
        return F.struct((-F.size(F.filter(w, lambda x: x.isin(*names)))).alias("neg"), F.lit(ord_).alias("ord"), F.lit(code).alias("code"))

    return score


def by_function_words(text: Column) -> Column:
    """The language most of whose function words stand in the text; of equals the first; null for none."""
    scores = [_held(code, names, i) for i, (code, names) in enumerate(FUNCTION_WORDS.items())]
    return let(let(words(F.lower(text)), lambda w: F.least(*[f(w) for f in scores])), lambda best: F.when(best["neg"] < 0, best["code"]))


def detect(text: Column, detector: Detector | None = by_function_words) -> Column:
    """Code of the language; English for null, for fewer than ``MIN_CHARS`` characters and where the detector fails."""
    if detector is None:
        return F.lit(FALLBACK)
    found = F.when(F.length(text) >= MIN_CHARS, detector(F.substring(text, 1, MAX_CHARS)))
    return F.coalesce(found, F.lit(FALLBACK))
