"""K-d tree sharding (native): split at distributed weighted medians until leaves have the target bytes.

Each level looks at all nodes at once: one aggregation finds every dimension's range in every node,
the widest (relative to the whole) is split, and histograms of bytes narrow the weighted quantile down
to one value. Rows that share that value are told apart by a hash of (id, text, copy), again by a
histogram, so a value that holds a third of all rows does not make a shard larger. Only histograms
(``BINS`` numbers a node, fewer when there are many nodes) come to the driver.

A dimension becomes a number in its own order: whole numbers and times as they are, fractions as a place
between least and greatest, texts as the rank of their value among the distinct ones.

Law of the shards: ``bytes``. Slots are numbered inside (shard, bucket of ids), and the buckets' counts
are summed up in two steps, so that no shard is ever sorted in one task. Shards and slots follow from
the rows' values alone: another layout of the files gives the same ones. Rows equal in id, text and all
dimensions are numbered as copies (inside a partition of the written table, after those of the
partitions before), and which of them is which makes no difference.

Defined cases: a null text has 0 bytes plus 1; null and NaN dimensions sort first; repeated rows get a place
each; a text of any length is one row, so a shard may exceed the mean by the longest; an empty table gives
no rows and one shard needs no split. Columns that are neither dimensions nor carried are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from trustloom.llm.common import checked, discard, fresh, materialize

BINS = 4096
MAX_HISTOGRAM = 1 << 17
HASH_RANGE = 1 << 40
SLOT_ROWS = 50_000


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


FRACTION_STEPS = 1 << 40


def _ranks(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(value, rank) of the distinct values of a text column: ranges are sorted apart and counted up."""
    values = docs.select(F.col(f"`{name}`").cast("string").alias("_v")).where("_v IS NOT NULL").distinct()
    ordered = values.repartitionByRange("_v").sortWithinPartitions("_v").withColumn("_at", F.monotonically_increasing_id())
    ordered, path = materialize(ordered, "values")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before, offsets = 0, {}
    for r in ordered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect():  # one row a range
        offsets[r["p"]] = before
        before += r["n"]
    at = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), part) if offsets else F.lit(0)
    out = materialize(ordered.select("_v", (at + place).cast("long").alias("_rank")), "ranks")
    discard(docs.sparkSession, path)
    return out


def coordinates(docs: DataFrame, dims: list[str], names: list[str]) -> DataFrame:
    """Adds for each of ``dims`` a long column of the name given, in the dimension's order; null and NaN are lowest."""
    numbers: dict[str, Column] = {}
    for d in dims:
        kind, c = docs.schema[d].dataType, F.col(f"`{d}`")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            numbers[d] = F.unix_micros(c.cast("timestamp"))
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            numbers[d] = c.cast("long")
        elif isinstance(kind, T.NumericType):
            numbers[d] = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    ends = docs.agg(F.count(F.lit(1)), *[f(c) for c in numbers.values() for f in (F.min, F.max)]).first()[1:] if numbers else ()
    bounds = {d: (ends[2 * i], ends[2 * i + 1]) for i, d in enumerate(numbers)}
    out = docs
    for d, name in zip(dims, names, strict=True):
        lo, hi = bounds.get(d, (None, None))
        if d not in numbers:
            ranks = _ranks(docs, d)
            (v,) = fresh(out.columns, "_value")
            side = checked((ranks[0].select(F.col("_v").alias(v), F.col("_rank").alias(name)), ranks[1]))
            out = out.join(side, F.col(f"`{d}`").cast("string") == F.col(v), "left").drop(v).withColumn(name, F.coalesce(F.col(name), F.lit(-1).cast("long")))
        elif lo is None:  # no value at all
            out = out.withColumn(name, F.lit(0).cast("long"))
        elif isinstance(lo, float):
            out = out.withColumn(name, F.coalesce(((numbers[d] - F.lit(lo)) / F.lit(hi - lo if hi > lo else 1.0) * FRACTION_STEPS).cast("long"), F.lit(-1).cast("long")))
        else:
            out = out.withColumn(name, F.coalesce(numbers[d], F.lit(int(lo) - 1).cast("long")))
    return out


def _histogram(rows: DataFrame, key: Column, spans: dict[int, tuple[int, int]], bins: int) -> dict[int, list[tuple[int, int]]]:
    """By node, (bin, bytes) ascending, where the node's span [lo, hi] is cut into ``bins`` steps."""
    pairs = sorted(spans.items())
    lo = F.element_at(F.create_map([F.lit(x) for n, (a, _) in pairs for x in (n, a)]), F.col("node"))
    step = F.element_at(F.create_map([F.lit(x) for n, (a, b) in pairs for x in (n, _step(a, b, bins))]), F.col("node"))
    grouped = rows.where(F.col("node").isin([n for n, _ in pairs])).select("node", F.expr("1").alias("_"), key.alias("k"), lo.alias("lo"), step.alias("step"), "w")
    grouped = grouped.groupBy("node", F.expr("(k - lo) div step").alias("bin")).agg(F.sum("w").alias("w"))
    out: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for r in grouped.collect():
        out[r["node"]].append((r["bin"], r["w"]))
    return {n: sorted(v) for n, v in out.items()}


def _step(lo: int, hi: int, bins: int) -> int:
    return max(1, -(-(hi - lo + 1) // bins))


def _pick(cells: list[tuple[int, int]], target: float) -> tuple[int, int]:
    """The bin in which the running sum reaches ``target``, and the sum before it."""
    before = 0
    for b, w in cells[:-1]:
        if before + w >= target:
            return b, before
        before += w
    return cells[-1][0], before


def tree(meta: DataFrame, dims: list[str], n_leaves: int) -> list[dict]:
    """Splits, parents first: node, dim, value, tie, left, right, first leaf of the right side."""
    splits: list[dict] = []
    open_nodes = {0: (0, n_leaves)}  # node -> leaves [a, b)
    next_id, top, rows = 1, None, meta.withColumn("node", F.lit(0))
    while open_nodes := {n: ab for n, ab in open_nodes.items() if ab[1] - ab[0] > 1}:
        rows = with_node(meta, splits).where(F.col("node").isin(list(open_nodes)))
        ranges = rows.groupBy("node").agg(F.sum("w").alias("w"), *[f(d).alias(f"{g}_{d}") for d in dims for f, g in ((F.min, "lo"), (F.max, "hi"))]).collect()
        stats = {r["node"]: r.asDict() for r in ranges}
        if top is None and stats:
            top = {d: max(1, stats[0][f"hi_{d}"] - stats[0][f"lo_{d}"]) for d in dims}
        bins = max(16, min(BINS, MAX_HISTOGRAM // max(1, len(open_nodes))))
        dim, target, spans, before = {}, {}, {}, {}
        for n, (a, b) in list(open_nodes.items()):
            if n not in stats:
                del open_nodes[n]
                continue
            s = stats[n]
            dim[n] = max(dims, key=lambda d: ((s[f"hi_{d}"] - s[f"lo_{d}"]) / top[d], -dims.index(d)))
            target[n] = s["w"] * ((b - a) // 2) / (b - a)
            spans[n], before[n] = (s[f"lo_{dim[n]}"], s[f"hi_{dim[n]}"]), 0
        if not open_nodes:
            break
        key = F.coalesce(*[F.when(F.col("node").isin([n for n in dim if dim[n] == d]), F.col(d)) for d in dims if d in dim.values()], F.lit(0).cast("long"))
        value: dict[int, int] = {}
        tie: dict[int, int] = {}
        ties = False
        while spans:
            inside = rows.withColumn("_k", key).where(_within(spans))
            for n, cells in _histogram(inside, F.col("_k"), spans, bins).items():
                lo, hi = spans[n]
                step = _step(lo, hi, bins)
                b, w = _pick(cells, target[n] - before[n])
                before[n] += w
                spans[n] = (lo + b * step, min(hi, lo + (b + 1) * step - 1))
            done = [n for n, (lo, hi) in spans.items() if lo == hi]
            for n in done:
                value[n] = spans.pop(n)[0]
        # rows at the median itself go left while their hash is below ``tie``
        at = {n: (v, v) for n, v in value.items()}
        same = rows.withColumn("_k", key).where(_within(at))
        for n, cells in _histogram(same, F.col("h"), {n: (0, HASH_RANGE - 1) for n in value}, bins).items():
            need, best, total = target[n] - before[n], 0, 0
            sums = [0]
            for _, w in cells:
                total += w
                sums.append(total)
            i = bisect_left(sums, need)
            i = min(range(max(0, i - 1), min(len(sums), i + 1)), key=lambda j: abs(sums[j] - need))
            best = 0 if i == 0 else cells[i - 1][0] + 1
            tie[n] = best * _step(0, HASH_RANGE - 1, bins)
        fresh = {}
        for n, (a, b) in open_nodes.items():
            mid = a + (b - a) // 2
            splits.append({"node": n, "dim": dim[n], "value": value[n], "tie": tie.get(n, 0), "left": next_id, "right": next_id + 1})
            fresh |= {next_id: (a, mid), next_id + 1: (mid, b)}
            next_id += 2
        open_nodes = fresh
        for n, (a, b) in fresh.items():
            if b - a == 1:
                splits.append({"node": n, "leaf": a})
    if not splits:
        splits.append({"node": 0, "leaf": 0})
    return splits


def _within(spans: dict[int, tuple[int, int]]) -> Column:
    cond = F.lit(False)
    for n, (lo, hi) in spans.items():
        cond = cond | ((F.col("node") == n) & F.col("_k").between(lo, hi))
    return cond


def with_node(meta: DataFrame, splits: list[dict]) -> DataFrame:
    """The deepest node of each row, as one nested CASE over the splits."""
    by = {s["node"]: s for s in splits if "dim" in s}

    def walk(n: int) -> Column:
        s = by.get(n)
        if s is None:
            return F.lit(n)
        left = (F.col(s["dim"]) < s["value"]) | ((F.col(s["dim"]) == s["value"]) & (F.col("h") < s["tie"]))
        return F.when(left, walk(s["left"])).otherwise(walk(s["right"]))

    return meta.withColumn("node", walk(0))


def _copies(meta: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``copy``: 0 for rows that are alone with their keys, else the row's number among the equal ones."""
    part = F.shiftright("_row", 33)
    repeated = meta.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    groups, path = materialize(repeated.withColumn("_group", F.monotonically_increasing_id()), "repeated")
    same = None
    for k in keys:
        cond = F.col(k).eqNullSafe(F.col(f"_g_{k}"))
        same = cond if same is None else same & cond
    side = checked((groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_group"), path))
    rows = meta.select(*keys, "_row").join(side, same).select("_group", "_row", part.alias("_part"))
    counts = rows.groupBy("_group", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("_group", "_part", F.coalesce(F.sum("n").over(W.partitionBy("_group").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    number = F.row_number().over(W.partitionBy("_group", "_part").orderBy("_row")) - 1
    numbered = rows.withColumn("_k", number).join(before, ["_group", "_part"]).select(F.col("_row").alias("_r"), (F.col("_k") + F.col("before")).alias("copy"))
    numbered = materialize(numbered, "copies")
    discard(meta.sparkSession, path)
    return meta.join(checked(numbered), F.col("_row") == F.col("_r"), "left").drop("_r").withColumn("copy", F.coalesce("copy", F.lit(0)).cast("long"))


def _slots(rows: DataFrame, buckets: int) -> DataFrame:
    """Adds ``slot``, gapless from 0 in every ``shard``: bucket by bucket, and by id inside a bucket."""
    groups = max(1, int(buckets**0.5))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("group", (F.col("bucket") / groups).cast("int"))
    running = lambda keys, order: F.coalesce(F.sum("n").over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    over_groups = counts.groupBy("shard", "group").agg(F.sum("n").alias("n")).select("shard", "group", running(["shard"], "group").alias("far"))
    inside = counts.select("shard", "group", "bucket", running(["shard", "group"], "bucket").alias("near"))
    offsets = materialize(inside.join(over_groups, ["shard", "group"]).select(F.col("shard").alias("_s"), F.col("bucket").alias("_b"), (F.col("far") + F.col("near")).alias("off")), "offsets")
    number = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("_id", "crc", "copy"))
    numbered = rows.withColumn("_n", number)
    return numbered.join(checked(offsets), (F.col("shard") == F.col("_s")) & (F.col("bucket") == F.col("_b"))).withColumn("slot", F.col("_n") - 1 + F.col("off"))


def kd_shards(docs: DataFrame, dims: list[str], id_col: str = "doc_id", text_col: str = "text", n_shards: int | None = None, target_bytes: int | None = None, carry: list[str] | None = None) -> DataFrame:
    """Shards of documents: id, size, text_crc32, shard, slot (and the columns of ``carry``).

    ``dims`` are metadata columns, in the order that decides between equally wide ones. Either ``n_shards``,
    or ``target_bytes`` from which their number follows.
    """
    spark = docs.sparkSession
    names = [f"_d{i}" for i in range(len(dims))]
    text = F.col(f"`{text_col}`").cast("string")
    held = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry or [])]
    plain = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        text_bytes(text).alias("w"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        *[F.col(f"`{d}`").alias(f"_v{i}") for i, d in enumerate(dims)],
        *held,
    )
    spread = [f"_v{i}" for i in range(len(dims))]
    meta = coordinates(plain, spread, names).select("_id", "w", "crc", *names, *[f"_c{i}" for i in range(len(held))], F.monotonically_increasing_id().alias("_row"))
    meta, _ = materialize(meta, "shard-meta")
    meta = _copies(meta, ["_id", "w", "crc", *names]).withColumn("h", F.pmod(F.xxhash64("_id", "crc", "copy"), F.lit(HASH_RANGE)))
    narrow, narrow_path = materialize(meta.select("w", "h", *names), "shard-dims")
    n_rows, total = narrow.agg(F.count(F.lit(1)), F.sum("w")).first()
    leaves = n_shards or max(1, -(-(total or 0) // max(1, target_bytes or 1)))
    splits = tree(narrow, names, leaves) if n_rows else [{"node": 0, "leaf": 0}]
    discard(spark, narrow_path)
    leaf = F.element_at(F.create_map([F.lit(x) for s in splits if "leaf" in s for x in (s["node"], s["leaf"])]), F.col("node"))
    rows = with_node(meta, splits).withColumn("shard", leaf)
    buckets = max(1, n_rows // SLOT_ROWS) * 8
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("_id", "crc", "copy"), F.lit(buckets)).cast("int")).drop("h", "_row", *names)
    return _slots(rows, buckets).select(
        F.col("_id").alias(id_col),
        F.col("w").alias("size"),
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry or [])],
    )
