"""Word statistics of a text as higher-order expressions: no explode, no shuffle.

Arrays are sorted by ``sort_array``; ``array_sort`` would call a lambda for every comparison.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it: a lambda binds it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def run_ends(sorted_items: Column) -> Column:
    """Positions (from 1) at which a run of equal items ends. Pass a column: lambdas would sort again."""
    after = F.slice(sorted_items, F.lit(2), F.greatest(F.size(sorted_items) - 1, F.lit(0)))
    same_as_next = F.zip_with(sorted_items, after, lambda x, y: x.eqNullSafe(y))
    return F.filter(F.transform(same_as_next, lambda same, i: F.when(~same, i + 1)), lambda i: i.isNotNull())


def run_counts(ends: Column) -> Column:
    """Ascending lengths of the runs."""
    runs = F.zip_with(ends, F.concat(F.array(F.lit(0)), ends), lambda end, before: end - before)
    return F.sort_array(F.filter(runs, lambda n: n.isNotNull()))


def counts(items: Column) -> Column:
    """Ascending counts of the distinct items. Pass few items: a lambda sorts them again for each."""
    return run_counts(run_ends(F.sort_array(items)))


def some_run(sorted_items: Column, least: Column) -> Column:
    """Whether some item stands ``least`` times or more in a sorted array: equal at that distance."""
    later = F.slice(sorted_items, least, F.greatest(F.size(sorted_items) - least + 1, F.lit(0)))
    return F.exists(F.zip_with(sorted_items, later, lambda a, b: a == b), lambda same: F.coalesce(same, F.lit(False)))


def top_of(sorted_pairs: Column, ends: Column) -> Column:
    """(w, n): the most frequent item, of equals the one that comes first, from (w, i) pairs sorted."""
    best = F.array_min(
        F.zip_with(
            F.slice(F.concat(F.array(F.lit(0)), ends), F.lit(1), F.size(ends)),
            ends,
            lambda before, end: F.struct((before - end).alias("neg"), F.element_at(sorted_pairs, before + 1)["i"].alias("i"), F.element_at(sorted_pairs, before + 1)["w"].alias("w")),
        )
    )
    return F.struct(best["w"].alias("w"), F.coalesce(-best["neg"], F.lit(0)).alias("n"))


def entropy(sorted_counts: Column, total: Column) -> Column:
    return F.aggregate(sorted_counts, F.lit(0.0), lambda a, c: a - (c / total) * F.log2(c / total))


def gini(sorted_counts: Column) -> Column:
    """0 for no item, 1 for one distinct item."""
    n = F.size(sorted_counts)
    weighted = F.aggregate(F.transform(sorted_counts, lambda c, i: (c * (i + 1)).cast("double")), F.lit(0.0), lambda a, x: a + x)
    total = F.aggregate(sorted_counts, F.lit(0.0), lambda a, x: a + x)
    return F.when(n == 0, 0.0).when(n == 1, 1.0).otherwise(2 * weighted / (n * total) - (n + 1) / n)


def ngram_repetition(items: Column, n: int = 4) -> Column:
    """1 - distinct / all n-grams; 0 for fewer items than n."""
    m = F.size(items) - (n - 1)
    grams = F.transform(F.sequence(F.lit(1), m), lambda i: F.concat_ws("\u0001", *[F.element_at(items, i + k) for k in range(n)]))
    return F.when(m < 1, 0.0).otherwise(1 - F.size(F.array_distinct(grams)) / m)
