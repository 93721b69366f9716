"""Plumbing of the subpackage: tables of the input, safe column names, batches for Python workers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from trustloom.storage import BROADCAST_BYTES, checked, discard, materialize, written_bytes

__all__ = ["BROADCAST_BYTES", "SPACES", "checked", "discard", "fresh", "materialize", "partitions_for", "small_batches", "table", "whole_ids", "written_bytes"]

#: Rows of an Arrow batch, unless the session sets its own: whole texts make the default of 10,000 too many.
ARROW_ROWS = 2000
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Characters that separate words in the documents' contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def small_batches(spark: SparkSession) -> None:
    """Python workers get texts in batches of ``ARROW_ROWS``, where the session has Spark's default.

    Spark reads this setting when a plan runs, so it stays set in the session of the query.
    """
    if spark.conf.get(_ARROW) == "10000":
        spark.conf.set(_ARROW, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_ids(df: DataFrame, name: str = "doc_id") -> None:
    """Refuses ids that are no whole numbers; a cast could make two of them equal."""
    if not isinstance(df.schema[name].dataType, T.IntegralType):
        raise ValueError(f"{name} must be of a whole-number type, not {df.schema[name].dataType.simpleString()}")


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to differ from every one in ``taken``."""
    low = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in low:
            name = "_" + name
        low.add(name.lower())
        out.append(name)
    return out
