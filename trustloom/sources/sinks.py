"""Files that a run leaves: records by type, run manifests, the index over topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trustloom.operators import publishing


def write_by_type(records: DataFrame, path: str) -> None:
    """One folder of JSON lines per source type."""
    records.write.mode("overwrite").partitionBy("source_type").json(path)


def manifest(records: DataFrame, ingested_at: str) -> DataFrame:
    """One row per topic: counts, mean score, tiers and sources as maps. Aggregates only, no record lists."""
    tiers = records.groupBy("topic", "trust_tier").agg(F.count(F.lit(1)).alias("n")).groupBy("topic").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("trust_tier", "n")))).alias("trust_tiers"))
    kinds = records.groupBy("topic", "source_type").agg(F.count(F.lit(1)).alias("n")).groupBy("topic").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source_type", "n")))).alias("sources"))
    base = records.groupBy("topic").agg(F.count(F.lit(1)).alias("total_records"), F.round(F.sum("trust_score") / F.greatest(F.count(F.lit(1)), F.lit(1)), 3).alias("avg_trust"), F.max("schema_version").alias("schema_version"))
    return base.join(tiers, "topic").join(kinds, "topic").withColumns({"ingested_at": F.lit(ingested_at), "sorted_by": F.lit("trust_score desc, source_url")})


def write_manifests(records: DataFrame, path: str, ingested_at: str) -> None:
    """Records partitioned by topic in rank order, and beside them the manifest rows.

    Ranges of (topic, rank) are dealt out, so a large topic is written by several tasks; its files follow
    each other in rank order.
    """
    order = ["topic", F.desc("trust_score"), "source_url"]
    records.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("topic").json(f"{path}/records")
    manifest(records, ingested_at).write.mode("overwrite").json(f"{path}/manifest")


def _by_topic(a, b):
    return F.when(a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0)


def index(manifests: DataFrame) -> DataFrame:
    """The index over all topics as one JSON row: totals and one entry a topic."""
    entry = F.struct(*sorted(manifests.columns))
    return manifests.agg(F.to_json(F.struct(F.count(F.lit(1)).alias("topics_n"), F.sum("total_records").alias("total_records"), F.array_sort(F.collect_list(F.struct("topic", entry.alias("entry"))), _by_topic).alias("topics"))).alias("index"))


def write_raw(rows: DataFrame, path: str, source_type: str) -> None:
    """What a source delivered, as JSON lines, before anything is filtered."""
    rows.write.mode("overwrite").json(f"{path}/raw/{source_type}")


def result_table(records: DataFrame, n: int = 50) -> DataFrame:
    """The best ``n`` records of each topic as they are shown: place, score, tier, source, author, end of the URL, flags."""
    place = F.row_number().over(W.partitionBy("topic").orderBy(F.desc("trust_score"), "source_url"))
    top = records.withColumn("place", place).where(F.col("place") <= n)
    return top.select(
        "topic", "place", F.format_number("trust_score", 3).alias("trust"), "trust_tier", "source_type", F.substring("author", 1, 40).alias("author"), F.right("source_url", F.lit(60)).alias("url"),
        F.size("anomaly_flags").alias("n_flags"), F.size("content_chunks").alias("n_chunks"),
    )


def index_entries(saved: DataFrame) -> DataFrame:
    """Index rows over saved runs (topic_dir, meta, records as canonical ones): counts of the valid records by source,
    and mean score and tiers as the run's own meta has them."""
    rows = saved.select("topic_dir", F.explode_outer("records").alias("r")).select("topic_dir", "r.*")
    valid = rows.withColumn("ok", F.col("record_id").isNotNull() & publishing.error_of(rows).isNull())
    kinds = [F.count_if(F.col("ok") & (F.col("source_type") == k)).alias(k) for k in ("blog", "youtube", "pubmed")]
    counts = valid.groupBy("topic_dir").agg(F.count_if("ok").alias("total"), F.count_if(~F.col("ok") & F.col("record_id").isNotNull()).alias("invalid"), *kinds)
    return counts.join(saved.select("topic_dir", F.col("meta.avg_trust").alias("avg_trust"), F.col("meta.generated_at").alias("generated_at")), "topic_dir")
