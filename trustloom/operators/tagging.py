"""Topic tags by weighted term frequency in title, first paragraph and body.

The taxonomy is a parameter, a list of (label, keywords, boost); ``taxonomy_table`` gives it as rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.functions.features import once
from trustloom.functions.lexicons import TAXONOMY
from trustloom.functions.stats import let
from trustloom.functions.text import words, zones

#: Scores are compared in whole billionths: equal fractions may differ in the last bit of their doubles.
_UNITS = 1e9


def taxonomy_table(spark, taxonomy=TAXONOMY) -> DataFrame:
    return spark.createDataFrame([(label, i, k, float(b)) for i, (label, ks, b) in enumerate(taxonomy) for k in ks], "label string, label_ord int, keyword string, boost double")


def zone_table(text: Column, s: Settings = DEFAULT) -> Column:
    """(t, n, w) of the zones that have words: lower-case text, word count, weight."""

    def rows(z: Column) -> Column:
        each = [F.struct(F.lower(z[name]).alias("t"), F.size(words(z[name])).alias("n"), F.lit(w).alias("w")) for name, w in zip(("title", "first", "body"), s.tag_weights, strict=True)]
        return F.filter(F.array(*each), lambda p: p["n"] > 0)

    return let(zones(F.coalesce(text, F.lit(""))), rows)


def _zone_score(keys: tuple[str, ...]):
    def found(z: Column, key: str) -> Column:
        key = key.lower()
        return F.when(F.contains(z["t"], F.lit(key)), F.regexp_count(z["t"], F.lit(rf"(?U)\b{_quoted(key)}\b"))).otherwise(0)

    def add(total: Column, z: Column) -> Column:
        return total + sum((found(z, k) for k in keys), F.lit(0)) / z["n"] * z["w"]

    return add


def with_tags(df: DataFrame, text_col: str = "text", out_col: str = "topic_tags", taxonomy=TAXONOMY, s: Settings = DEFAULT) -> DataFrame:
    """Adds up to ``max_tags`` labels, best first, equals to nine decimals in taxonomy order; ["general"] for none.

    Zones are cut and counted once a row. A keyword is looked for as a fixed string first, and only a
    zone that has it is searched for whole words.
    """
    df = once(df, _z=zone_table(F.col(text_col), s))
    scored = []
    for i, (label, keys, boost) in enumerate(taxonomy):
        raw = F.aggregate("_z", F.lit(0.0), _zone_score(keys))
        score = F.round(raw * F.lit(float(boost)) * F.lit(_UNITS))
        scored.append(F.struct((-score).alias("neg"), F.lit(i).alias("ord"), F.lit(label).alias("label")))
    df = once(df, _t=F.slice(F.sort_array(F.filter(F.array(*scored), lambda x: x["neg"] < 0)), 1, s.max_tags))
    best = F.transform("_t", lambda x: x["label"])
    return df.withColumn(out_col, F.when(F.size("_t") == 0, F.array(F.lit("general"))).otherwise(best)).drop("_z", "_t")


def _quoted(keyword: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", keyword.lower())
