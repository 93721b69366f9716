"""One pass of tokenising: the columns that anomalies, signals and penalties share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustloom.functions import stats
from trustloom.functions.text import content_words, words


def once(df: DataFrame, **columns) -> DataFrame:
    """Adds columns behind a one-element Generate, so that the optimizer cannot copy their expressions
    into the places that use them (inside a lambda a copy would run for every element)."""
    if len(columns) == 1:
        ((name, expr),) = columns.items()
        return df.select("*", F.explode(F.array(expr)).alias(name))
    packed = df.select("*", F.explode(F.array(F.struct(*[e.alias(n) for n, e in columns.items()]))).alias("_once"))
    return packed.select(*df.columns, *[F.col(f"_once.{n}").alias(n) for n in columns])


def with_features(df: DataFrame, text_col: str = "content", frequencies: bool = True) -> DataFrame:
    """Adds _words (lower case), _n, _content_words, and with ``frequencies`` _counts (ascending, all words), _ccounts, _top.

    Each is computed once a row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = once(df, _words=words(F.lower(text))).withColumn("_n", F.size("_words"))
    df = once(df, _content_words=content_words(F.col("_words")))
    if not frequencies:
        return df
    pairs = F.sort_array(F.transform("_content_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    df = once(df, _sorted=F.sort_array("_words"), _pairs=pairs)
    df = once(df, _ends=stats.run_ends(F.col("_sorted")), _cends=stats.run_ends(F.transform("_pairs", lambda p: p["w"])))
    df = once(df, _counts=stats.run_counts(F.col("_ends")), _ccounts=stats.run_counts(F.col("_cends")), _top=stats.top_of(F.col("_pairs"), F.col("_cends")))
    return df.drop("_sorted", "_pairs", "_ends", "_cends")


FEATURES = ["_words", "_n", "_content_words", "_counts", "_ccounts", "_top"]
