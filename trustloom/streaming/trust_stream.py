"""Streaming form: the batch's column functions on a stream, with state only where a batch has order.

The state is one (n, mean) pair a domain and one mark a record id within the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trustloom.config import DEFAULT, Settings
from trustloom.functions import trust
from trustloom.functions.text import netloc, record_id, tier_name
from trustloom.operators.priors import step


def deduplicated(records: DataFrame, event_time: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """First of each record id within the watermark."""
    keyed = records.withColumn("record_id", record_id(F.col("source_type"), F.col("source_url")))
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["record_id"])


def with_priors(scored: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """(domain, seq, penalized) to scores with the domain's running prior, by the batch's own step.

    Rows of one micro-batch are taken by seq. A row that comes in a later micro-batch than a larger seq of
    its domain counts as later: the order of arrival is the order of the stream.
    """

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, mean = state.get if state.exists else (0, s.prior_init)
        rows = pd.concat(frames)[["seq", "penalized"]].sort_values(["seq", "penalized"])
        seqs, finals, used = rows["seq"].tolist(), [], []
        for penalized in rows["penalized"].tolist():
            final, prior, after = step(n, mean, penalized, s) if key[0] else step(0, s.prior_init, penalized, s)
            if key[0]:
                n, mean = n + 1, after
            finals.append(final)
            used.append(prior)
        state.update((n, mean))
        yield pd.DataFrame({"domain": key[0], "seq": seqs, "trust_score": finals, "prior_used": pd.Series(used, dtype="float64")})

    return scored.groupBy("domain").applyInPandasWithState(
        fold, "domain string, seq bigint, trust_score double, prior_used double", "n bigint, mean double", "append", GroupStateTimeout.NoTimeout
    )


def trust_stream(records: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """Scored, prior-blended records of a stream with a ``seq`` column."""
    scored = trust.score(records, s).select("seq", netloc(F.col("source_url")).alias("domain"), F.col("penalized_score").alias("penalized"))
    out = with_priors(scored, s)
    return out.withColumn("trust_tier", tier_name(F.col("trust_score"), s))


def tier_windows(scored: DataFrame, event_time: str = "event_time", delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Tier histogram by event-time window, late rows dropped after ``delay``."""
    return scored.withWatermark(event_time, delay).groupBy(F.window(event_time, width), "trust_tier").agg(F.count(F.lit(1)).alias("n"))
