"""Per-domain running prior: the one ordered recurrence.

final = clamp((1 - w) * penalized + w * mean) once a domain has ``prior_min_n`` records, and each final
moves the domain's mean. Each score depends on the rounded one before it, so a domain cannot be split:
narrow rows (domain, order, score) are sorted by domain and order, and every task reads its sorted
partition batch by batch, carrying one (n, mean) pair. A domain of any size takes constant memory.

A state is saved as numbered versions. Spark's committer marks a version as whole when its job ends;
a reader takes the newest whole one, so a crash at any moment leaves the version before.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustloom.config import DEFAULT, Settings
from trustloom.storage import checked, file_system, materialize

STATE = "domain string, n bigint, mean_score double"
_FOLDED = "row bigint, domain string, seq bigint, trust_score double, prior_used double, n bigint, mean_score double, last boolean"


def step(n: int, mean: float, penalized: float, s: Settings = DEFAULT, digits: tuple[int, int] = (3, 4)) -> tuple[float, float | None, float]:
    """(final score, prior used, new mean) of a record after ``n`` others of its domain."""
    prior = mean if n >= s.prior_min_n else None
    blended = penalized if prior is None else (1 - s.prior_weight) * penalized + s.prior_weight * prior
    final = round(min(max(blended, 0.0), 1.0), digits[0])
    return final, prior, round((mean * n + final) / (n + 1), digits[1])


def _fold(s: Settings, digits: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, not yet known to be its domain's last
        n, mean = 0, s.prior_init
        for batch in batches:
            out = []
            for row, domain, seq, penalized, n0, mean0 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                same = held is not None and held[1] == domain
                if held is not None:
                    out.append((*held, not same))
                if not same:
                    n, mean = n0 or 0, s.prior_init if mean0 is None else mean0
                final, prior, mean = step(n, mean, penalized, s, digits)
                n += 1
                held = (row, domain, seq, final, prior, n, mean)
            yield _batch(out)
        if held is not None:
            yield _batch([(*held, True)])

    return run


_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.bool_()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, _KINDS, strict=True)], [f.split()[0] for f in _FOLDED.split(", ")])


def apply_priors(scored: DataFrame, state: DataFrame | None = None, s: Settings = DEFAULT, digits: tuple[int, int] = (3, 4)) -> tuple[DataFrame, DataFrame]:
    """Scores (seq, domain, penalized) to (seq, domain, trust_score, prior_used), and the new state (domain, n, mean_score).

    Records without a domain neither read nor move a prior; a null score counts as 0. An optional column
    ``row`` tells rows with one ``seq`` apart, orders them, and is given back.
    """
    with_row = "row" in scored.columns
    row = F.col("row").cast("bigint") if with_row else F.lit(0).cast("bigint")
    base = scored.select(row.alias("row"), "domain", F.col("seq").cast("bigint").alias("seq"), F.coalesce(F.col("penalized").cast("double"), F.lit(0.0)).alias("penalized"))
    named = base.where(F.coalesce("domain", F.lit("")) != "")
    before = "n bigint, mean_score double"
    if state is None:
        joined = named.selectExpr("*", *[f"CAST(NULL AS {f.split()[1]}) AS {f.split()[0]}" for f in before.split(", ")])
    else:
        joined = named.join(checked(materialize(state.select("domain", "n", "mean_score"), "prior-state")), "domain", "left")
    joined = joined.select("row", "domain", "seq", "penalized", "n", "mean_score")
    ordered = joined.repartition("domain").sortWithinPartitions("domain", "seq", "row")
    folded, _ = materialize(ordered.mapInArrow(_fold(s, digits), _FOLDED), "priors")
    keys = ["row", "seq", "domain"] if with_row else ["seq", "domain"]
    alone = base.where(F.coalesce("domain", F.lit("")) == "").select(
        *keys, F.round(F.least(F.greatest(F.col("penalized"), F.lit(0.0)), F.lit(1.0)), digits[0]).alias("trust_score"), F.lit(None).cast("double").alias("prior_used")
    )
    new_state = folded.where("last").select("domain", "n", "mean_score")
    if state is not None:
        new_state = new_state.unionByName(state.select("domain", "n", "mean_score").join(new_state.select("domain"), "domain", "left_anti"))
    return folded.select(*keys, "trust_score", "prior_used").unionByName(alone), new_state


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole versions below ``path``, ascending; a passing fault of the file system is raised."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(root) if x.isDirectory()]
    numbers = sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())
    return [n for n in numbers if fs.exists(file_system(spark, f"{path}/v{n}/_SUCCESS")[1])]


#: What Spark says of files that are there and are no Parquet, or lack the columns.
_DAMAGED = ("CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE", "is not a Parquet file", "UNABLE_TO_INFER_SCHEMA", "Could not read footer")


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version that can be read; empty if there is none. Other faults are raised."""
    for n in reversed(_versions(spark, path)):
        try:
            df = spark.read.schema(STATE).parquet(f"{path}/v{n}")
            df.agg(F.count(F.lit(1)), F.sum("n"), F.sum("mean_score"), F.max("domain")).collect()
            return df
        except (PySparkException, Py4JJavaError) as e:
            if not any(x in str(e) for x in _DAMAGED):
                raise
    return spark.createDataFrame([], STATE)


def save_state(state: DataFrame, path: str, keep: int = 2) -> None:
    """Write the next version, then delete all but the newest ``keep`` (a reader of the one before may be at work)."""
    spark = state.sparkSession
    fs, root = file_system(spark, path)
    taken = [int(x.getPath().getName()[1:]) for x in fs.listStatus(root) if x.getPath().getName()[1:].isdigit()] if fs.exists(root) else []
    state.select("domain", "n", "mean_score").write.parquet(f"{path}/v{max(taken, default=0) + 1}")
    for n in _versions(spark, path)[:-keep]:
        fs.delete(file_system(spark, f"{path}/v{n}")[1], True)
