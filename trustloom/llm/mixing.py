"""Mixing to target weights (native): iterative proportional fitting, then calibrated sampling.

Tokens are summed by cell (source, language, topic). Raking scales the cells' weights so that the
marginals of all three dimensions meet their targets, one dimension after the other; after each scaling
a cell is held at no more than the tokens it has, as nothing is repeated. It ends when a sweep moves no
cell by more than ``TOLERANCE`` of the budget, or after ``SWEEPS``. A document is sampled with probability weight /
tokens of its cell, by a hash of its id, so that the expected tokens of the sample have the raked
marginals and sum to ``budget`` of all tokens. ``residuals`` says how far each value stays from its
target, and whether its tokens are too few for it.

Targets are shares of the budget by value. ``tempered`` derives them from the data as tokens to the
power ``alpha``, which lifts the small values of a dimension. A value without a target keeps its own
share; targets that the tokens cannot meet are met as nearly as the bound allows.

Texts are read once: ids, dimensions, token counts and the columns to carry are written, and the rest
works on that table. A marginal is a sum with partial sums in every task, its factors join the cells
(broadcast below the limit of ``common.checked``), and the cells are written once a sweep, so no value
of a dimension is gathered in one task, however many cells it has.

Defined cases: nulls are a value of their own in each dimension; a null or empty text has 0 tokens
and probability 1 (it weighs nothing); repeated rows share an id's draw; a null id draws as such; a text
of any length is counted whole; an empty table gives no rows; other columns are carried along untouched,
but for those named like the four results, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustloom.llm.common import SPACES, checked, discard, fresh, materialize

SWEEPS = 12
TOLERANCE = 1e-9
MADE = ("_topic", "_n_tokens", "_probability", "_sampled")


def _count(text: Column, mark: str) -> Column:
    """Occurrences of an ASCII character, from lengths in bytes."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def n_tokens(text: Column) -> Column:
    """Words of the text, counted as the runs of spaces around them; null: 0.

    Once all spaces are blanks, tab and line feed are free to mark where a run begins and ends.
    """
    blank = F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" "))
    for c in SPACES[1:]:
        blank = F.replace(blank, F.lit(c), F.lit(" "))
    runs = F.replace(F.replace(blank, F.lit(" "), F.lit("\t\n")), F.lit("\n\t"), F.lit(""))
    return (_count(runs, "\t") - 1).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse content type in place of a topic: by the marks that tables, code, notices and shouting leave, and by length."""
    chars = F.length(text)
    marks = lambda some: sum((_count(text, c) for c in some), F.lit(0))
    return (
        F.when(text.isNull() | (chars == 0), "empty")
        .when(marks("|") * 50 > chars, "table")
        .when(marks("{}();=") * 25 > chars, "code")
        .when(marks("#*$%&") * 20 > chars, "symbols")
        .when(marks("!") * 60 > chars, "shouting")
        .when(chars < 600, "note")
        .when(chars < 6000, "article")
        .otherwise("long read")
    )


def _joined(cells: DataFrame, side: tuple[DataFrame, str], dim: str) -> DataFrame:
    """Cells with the columns of a (dim, ...) table, by equal values or both null."""
    (v,) = fresh(cells.columns, "_value")
    right = checked((side[0].withColumnRenamed(dim, v), side[1]))
    return cells.join(right, F.col(dim).eqNullSafe(F.col(v)), "left").drop(v)


def tempered(cells: DataFrame, dim: str, alpha: float) -> DataFrame:
    """Target shares (``dim``, ``share``) proportional to tokens ** alpha."""
    sums = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(alpha)).alias("p"))
    total = sums.agg(F.sum("p").alias("all"))
    return sums.join(F.broadcast(total), F.lit(True)).select(dim, (F.col("p") / F.col("all")).alias("share"))  # one row


def rake(cells: DataFrame, dims: list[str], targets: dict[str, DataFrame], budget: float, sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells (dims, tokens) with ``weight``: tokens to expect from each after bounded raking."""
    spark = cells.sparkSession
    whole = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    wanted = whole * budget
    out = cells
    for i, d in enumerate(dims):
        sums = cells.groupBy(d).agg(F.sum("tokens").alias("_own"))
        share = targets[d].select(F.col(d).alias("_v"), "share").join(sums, F.col("_v").eqNullSafe(F.col(d)), "right")
        side = materialize(share.select(d, F.coalesce(F.col("share"), F.col("_own") / F.lit(whole or 1.0)).alias(f"_t{i}")), "targets")
        out = _joined(out, side, d)
    out, path = materialize(out.withColumn("weight", F.col("tokens") * F.lit(budget)), "cells")
    for _ in range(sweeps):
        used = []
        out = out.withColumn("_before", F.col("weight"))
        for i, d in enumerate(dims):
            have = out.groupBy(d).agg(F.sum("weight").alias("_h"), F.first(f"_t{i}").alias("_t"))
            scale = F.when(F.col("_h") > 0, F.col("_t") * F.lit(wanted) / F.col("_h")).otherwise(1.0)
            side = materialize(have.select(d, scale.alias("_f")), "factors")
            used.append(side[1])
            out = _joined(out, side, d).withColumn("weight", F.least(F.col("tokens").cast("double"), F.col("weight") * F.col("_f"))).drop("_f")
        out, after = materialize(out, "cells")
        discard(spark, path, *used)
        path = after
        moved = out.agg(F.max(F.abs(F.col("weight") - F.col("_before")))).first()[0] or 0.0
        out = out.drop("_before")
        if moved <= tolerance * wanted:
            break
    return out.select(*dims, "tokens", "weight", *[f"_t{i}" for i in range(len(dims))])


def residuals(raked: DataFrame, dims: list[str], budget: float) -> DataFrame:
    """By dimension and value: target, expected share of the budget, residual, and whether all its tokens are too few."""
    total = raked.agg((F.sum("tokens") * F.lit(budget)).alias("_all"))
    out = None
    for i, d in enumerate(dims):
        part = raked.groupBy(F.col(d).alias("value")).agg(F.sum("weight").alias("w"), F.sum("tokens").alias("n"), F.first(f"_t{i}").alias("target"))
        part = part.join(F.broadcast(total), F.lit(True)).select(  # one row
            F.lit(d.lstrip("_")).alias("dimension"), "value", "target", (F.col("w") / F.col("_all")).alias("expected"),
            (F.col("w") / F.col("_all") - F.col("target")).alias("residual"), (F.col("n") < F.col("target") * F.col("_all")).alias("too_few"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def draw(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) from the id alone."""
    name = F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(
    docs: DataFrame,
    topic: Column,
    budget: float = 0.6,
    alpha: float = 0.7,
    seed: int = 7,
    targets: dict[str, DataFrame] | None = None,
    sweeps: int = SWEEPS,
    carry: list[str] | None = None,
    report: bool = False,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Columns of ``docs`` (doc_id, text, source, lang; or those of ``carry``), with topic, n_tokens, probability, sampled.

    The new ones are named as in ``MADE``. ``targets`` may give (value, share) tables for ``_source``,
    ``_lang`` and ``_topic``; the rest is tempered by ``alpha``. ``report`` returns ``residuals`` too.
    """
    kept = [c for c in (docs.columns if carry is None else carry) if c.lower() not in MADE]
    d_source, d_lang, draws = fresh([*kept, *MADE], "_source", "_lang", "_draw")
    dims = ["_source", "_lang", "_topic"]
    measured = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("source").cast("string").alias(d_source),
        F.col("lang").cast("string").alias(d_lang),
        topic.alias("_topic"),
        n_tokens(F.col("text").cast("string")).alias("_n_tokens"),
        draw(F.col("doc_id"), seed).alias(draws),
    )
    measured, _ = materialize(measured, "measured")
    sums = measured.groupBy(F.col(d_source).alias("_source"), F.col(d_lang).alias("_lang"), "_topic").agg(F.sum("_n_tokens").alias("tokens"))
    cells, cells_path = materialize(sums, "cells")
    given = {d: (targets or {}).get(d) for d in dims}
    raked = rake(cells, dims, {d: tempered(cells, d, alpha) if t is None else t for d, t in given.items()}, budget, sweeps)
    discard(docs.sparkSession, cells_path)
    p = F.when(F.col("tokens") > 0, F.round(F.col("weight") / F.col("tokens"), 9)).otherwise(1.0)
    names = fresh(measured.columns, "_source2", "_lang2", "_topic2")
    side = materialize(raked.select(*[F.col(d).alias(n) for d, n in zip(dims, names, strict=True)], p.alias("_probability")), "raked")
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip((d_source, d_lang, "_topic"), names, strict=True)]
    joined = measured.join(checked(side), same[0] & same[1] & same[2], "left")
    out = joined.select(*[F.col(f"`{c}`") for c in kept], "_topic", "_n_tokens", "_probability", (F.col(draws) < F.col("_probability")).alias("_sampled"))
    return (out, residuals(raked, dims, budget)) if report else out
