"""Where queries and their SQL are registered, and how they read tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table of texts, dealt out where its files are fewer than the cores.

    A file of one row group is one task. Tables of many files are read as they are, without a shuffle.
    """
    df = t(spark, sf, name)
    df = df.select(*columns) if columns else df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if len(df.inputFiles()) < cores else df


def values(spark: SparkSession, cols: str, rows: list[tuple]) -> tuple[DataFrame, str]:
    """The same literal rows for Spark and, as text, for SQL."""

    def lit(v) -> str:
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    names = [c.split()[0] for c in cols.split(", ")]
    sql = f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(lit(v) for v in r) + ')' for r in rows)}) AS v({', '.join(names)}))"
    return spark.createDataFrame(rows, cols) if spark else None, sql


#: White space as in ``text.SPACE`` and word characters as in Java's ``(?U)\w``, for RE2, whose own are ASCII only.
WHITE = r"[\t-\r \x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WORD = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{24B6}-\x{24E9}\x{200C}\x{200D}"


def split_sql(x: str) -> str:
    """Words between runs of white space."""
    return f"list_filter(string_split_regex({x}, '{WHITE}+'), lambda w: w <> '')"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WHITE}+|{WHITE}+$', '', 'g')"
