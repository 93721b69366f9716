"""The corpus pipeline: toxicity, near-duplicates, benchmark decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but
the last return the columns of ``documents``; the last adds its shard and slot to them.

Defined cases, in every stage: an empty table gives an empty table; a null text is clean, no duplicate and
not contaminated; verdicts go by id and text together, so rows with one id (or a null id) and different
texts stand for themselves; of rows with one id and one text the near-duplicate stage keeps one; columns
other than those of ``documents`` are dropped. Near-duplicates are linked from a similarity of 0.85.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustloom.llm import decontam, mixing, neardup, sharding, toxicity
from trustloom.llm.common import checked, materialize, table
from trustloom.llm.queries import TOXIC_GRADES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: The stages hold classifiers, hashes of text and an iterative graph step: SQL cannot express them.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("grade"))
    model = toxicity.train(docs, labels, grades_by_density=TOXIC_GRADES)
    return toxicity.score(docs.select(*COLUMNS), model, keep_columns=True).where(~F.col("toxic")).select(*COLUMNS)


def _without(docs: DataFrame, verdict: DataFrame, bad: str) -> DataFrame:
    """Rows whose id and text have no row in ``verdict`` (doc_id, text_hash, ...) that is ``bad``."""
    side = materialize(verdict.where(bad).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "dropped")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.select(*COLUMNS).join(checked(side), same, "left_anti")


def _once(docs: DataFrame) -> DataFrame:
    """One of the rows with equal id and text; only ids and hashes are shuffled, but for the repeated rows."""
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    repeated = hashed.groupBy("doc_id", "_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    side = checked(materialize(repeated.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_same")), "repeated"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_same"))
    return hashed.join(side, same, "left_anti").unionByName(hashed.join(side, same, "left_semi").dropDuplicates(["doc_id", "_hash"])).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    return _once(_without(docs, neardup.near_duplicates(docs.select("doc_id", "text")), "NOT kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = decontam.decontaminate(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return _without(docs, verdict, "contaminated")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(*COLUMNS), mixing.topic_of(F.col("text"))).where("_sampled").select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(docs, ["source", "lang", "n_chars"], n_shards=8, carry=[c for c in COLUMNS if c != "doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each returns is written and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
