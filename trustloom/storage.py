"""Tables in the folder that driver and executors share, and broadcasts by their written size."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its written size is below this; above it the join is shuffled.
BROADCAST_BYTES = 24 * 1024 * 1024

_written: list[tuple[SparkSession, str]] = []
_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Where it is unset, a local session (tests) gets a folder
    of its own; a cluster has no folder that all machines share, and gets an error."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _local:
        _local.append(f"file://{tempfile.mkdtemp(prefix='trustloom-')}")
    return _local[0]


def materialize(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table in the shared folder; returns the table read back and its path.

    Cuts the lineage so that a lost executor costs at most the tasks that were running, and gives the
    written size that the checked broadcasts look at.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path), path


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def written_bytes(spark: SparkSession, path: str) -> int:
    fs, p = file_system(spark, path)
    return int(fs.getContentSummary(p).getLength())


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables of ``materialize`` that no later step reads. The rest goes when the process ends."""
    for path in paths:
        fs, p = file_system(spark, path)
        fs.delete(p, True)
        if (spark, path) in _written:
            _written.remove((spark, path))


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            fs, p = file_system(spark, path)
            fs.delete(p, True)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            return


def checked(side: tuple[DataFrame, str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """The written table, hinted for broadcast only if its files are below ``limit``.

    Parquet may be several times smaller than the rows in memory, so ``limit`` is compared with four
    times the written size. Above it, the join is left to Spark (sort-merge, with skewed keys split).
    """
    df, path = side
    return F.broadcast(df) if 4 * written_bytes(df.sparkSession, path) <= limit else df
