"""Exact substring removal with super-k-mers.

A window is ``window`` consecutive words of one document. A word goes if some window over it also
starts in a document with a smaller id. Windows are brought together by their minimiser: the smallest
hash among the ``seed_words``-word grams inside. Consecutive windows with one minimiser are a
super-k-mer.

1. One row (minimiser, document, place) a super-k-mer, without its words; a minimiser that only one
   document has cannot belong to a repeat, and ends here. The rest is grouped by document again.
2. The super-k-mers that are left travel to their minimiser's bucket as one packed string of words.
   Equal strings are merged, with the smallest document id, before they are shuffled.
3. In a bucket the windows of all strings are sorted, which puts equal ones together, and each string
   gets for each of its windows the smallest id of a document in which it starts. A bucket with more
   than ``hot`` windows in different strings is not sorted in one task: its windows go on by 128-bit
   digests, with the smallest id taken before the shuffle. A window that makes up more than one in
   ``SHARE`` of all such windows, of which there are fewer than ``SHARE``, gets its smallest id by broadcast;
   the others join it by digest, so no window is gathered in one task.
4. Places whose window has a smaller document than their own come back to it as word ranges.

Windows of a bucket are compared as bytes, those of hot buckets and whole packed strings by 128-bit
digests. 64-bit hashes of grams only route, and tell rows of one doc_id apart.

Defined cases: a null text has no words; shorter texts than a window lose nothing; rows with one
doc_id never remove each other's words, and each is cut by its own text; a null doc_id is larger than
every id; ids are whole numbers below 2^63 - 1, other types are refused; texts of any length are read
whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustloom.llm.common import discard, materialize, whole_ids
from trustloom.llm.words import chunks, signed

WINDOW = 50
SEED_WORDS = 12
#: Windows of different strings of one minimiser that are still sorted in one task.
HOT = 50_000
#: One in so many of the windows of hot buckets makes a window frequent.
SHARE = 1000
NO_ID = (1 << 63) - 1


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, have = h, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def super_kmers(chunk, window: int, seed_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, text, first window, number of windows) of a chunk; places count from the chunk's start."""
    n = len(chunk.hash)
    if n < window:
        e = np.zeros(0, dtype=np.int64)
        return e.astype(np.uint64), e, e, e
    low = sliding_min(chunk.ngrams(seed_words), window - seed_words + 1)
    place = np.arange(len(low))
    text = np.searchsorted(chunk.bounds, place, side="right") - 1
    inside = place + window <= chunk.bounds[text + 1]
    place, text, low = place[inside], text[inside], low[inside]
    if not len(place):
        return low, place, place, place
    new = np.ones(len(place), dtype=bool)
    new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1)
    at = np.flatnonzero(new)
    return low[at], text[at], place[at], np.diff(np.append(at, len(place)))


def _seeds(docs: DataFrame, window: int, seed_words: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for c in chunks(batch.column(2)):
                low, text, place, n = super_kmers(c, window, seed_words)
                row = pa.array(text + c.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(low), pa.int64()),
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array((place - c.bounds[text]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ],
                    ["seed", "id", "key", "place", "n"],
                )

    return docs.mapInArrow(run, "seed bigint, id bigint, key bigint, place int, n int")


def _pack(docs: DataFrame, window: int) -> DataFrame:
    """Packed strings of the super-k-mers listed in ``runs``."""

    def run(batches):
        for batch in batches:
            ids, keys, runs = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            out: list[list] = [[], [], [], [], [], [], []]
            for i, text in enumerate(batch.column(2).to_pylist()):
                words = text.encode().split()
                for r in runs[i].as_py():
                    packed = b" ".join(words[r["place"] : r["place"] + r["n"] + window - 1])
                    name = hashlib.blake2b(packed, digest_size=16).digest()
                    for col, v in zip(out, (r["seed"], name, packed, ids[i], keys[i], r["place"], r["n"]), strict=True):
                        col.append(v)
                if len(out[0]) > 4000:
                    yield _packed_batch(out)
                    out = [[], [], [], [], [], [], []]
            if out[0]:
                yield _packed_batch(out)

    return docs.mapInArrow(run, "bucket bigint, name binary, packed binary, id bigint, key bigint, place int, n int")


def _packed_batch(out: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["bucket", "name", "packed", "id", "key", "place", "n"])


def _count(strings: DataFrame, window: int) -> DataFrame:
    """For each string, by window, the smallest document in which it starts; buckets come one after another."""

    def settle(held: list[tuple[bytes, bytes, int]]) -> list[tuple[bytes, list[int]]]:
        if len(held) == 1:
            name, packed, first = held[0]
            return [(name, [first] * (packed.count(b" ") + 2 - window))]
        windows = []
        for k, (_, packed, first) in enumerate(held):
            cuts = [0, *[i + 1 for i, b in enumerate(packed) if b == 32], len(packed) + 1]
            windows += [(packed[cuts[j] : cuts[j + window] - 1], first, k, j) for j in range(len(cuts) - window)]
        windows.sort()
        out: list[list[int]] = [[0] * (p.count(b" ") + 2 - window) for _, p, _ in held]
        at, least = None, 0
        for words, first, k, j in windows:
            if words != at:
                at, least = words, first
            out[k][j] = least
        return [(name, firsts) for (name, _, _), firsts in zip(held, out, strict=True)]

    def rows(batches):
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def run(batches):
        names, firsts = [], []
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            for name, f in settle([r[1:] for r in group]):
                names.append(name)
                firsts.append(f)
            if len(names) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))], ["name", "firsts"])
                names, firsts = [], []
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))], ["name", "firsts"])

    return strings.select("bucket", "name", "packed", "first").mapInArrow(run, "name binary, firsts array<bigint>")


def _count_spread(strings: DataFrame, window: int, share: int = SHARE) -> DataFrame:
    """The same as ``_count`` for hot buckets: windows by digest, spread over all tasks."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                out: list[list] = [[], [], [], []]
                for name, packed, first in zip(*(c.to_pylist() for c in batch.slice(at, 200).columns), strict=True):
                    words = packed.split(b" ")
                    for j in range(len(words) - window + 1):
                        for col, v in zip(out, (hashlib.blake2b(b" ".join(words[j : j + window]), digest_size=16).digest(), name, j, first), strict=True):
                            col.append(v)
                kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["w", "name", "j", "first"])

    windows, _ = materialize(strings.select("name", "packed", "first").mapInArrow(run, "w binary, name binary, j int, first bigint"), "windows")
    least, _ = materialize(windows.groupBy("w").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n")), "least")
    total = least.agg(F.sum("n")).first()[0] or 0
    frequent = least.where(F.col("n") * share > F.lit(total)).select("w", F.col("least").alias("often"))  # fewer than share rows
    split = windows.join(F.broadcast(frequent), "w", "left")
    known = split.where(F.col("often").isNotNull()).select("name", "j", F.col("often").alias("least"))
    rest = split.where(F.col("often").isNull()).select("w", "name", "j").join(least.select("w", "least"), "w").select("name", "j", "least")
    each = known.unionByName(rest).groupBy("name").agg(F.sort_array(F.collect_list(F.struct("j", "least"))).alias("x"))
    return each.select("name", F.col("x.least").alias("firsts"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS, hot: int = HOT, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_removed, kept_sha256 and the kept words."""
    whole_ids(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("key", F.xxhash64("id", "text"))
    seeds, seeds_path = materialize(_seeds(docs.select("id", "key", "text"), window, seed_words), "seeds")
    shared = seeds.groupBy("seed").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where(F.col("lo") < F.col("hi")).select("seed")
    runs, runs_path = materialize(seeds.join(shared, "seed").groupBy("id", "key").agg(F.collect_set(F.struct("place", "n", "seed")).alias("runs")), "runs")
    discard(docs.sparkSession, seeds_path)
    packed, packed_path = materialize(_pack(docs.join(runs, ["id", "key"]).select("id", "key", "text", "runs"), window), "packed")
    crowded = packed.select("bucket", "name", "n").distinct().groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") > hot).select("bucket")
    crowded, _ = materialize(crowded, "crowded")
    strings = packed.groupBy("bucket", "name", "packed").agg(F.min("id").alias("first"))
    calm, spread = strings, None
    if not crowded.isEmpty():
        calm, spread = strings.join(crowded, "bucket", "left_anti"), strings.join(crowded, "bucket", "left_semi")
    counted = _count(calm.repartition("bucket").sortWithinPartitions("bucket"), window)
    if spread is not None:
        counted = counted.unionByName(_count_spread(spread, window))
    places = packed.select("name", "id", "key", "place").join(counted, "name")
    cut = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("id"), F.col("place") + i)), lambda p: p.isNotNull())
    ranges, _ = materialize(
        places.select("id", "key", cut.alias("cut")).where(F.size("cut") > 0).groupBy("id", "key").agg(F.array_distinct(F.flatten(F.collect_list("cut"))).alias("cut")), "cuts"
    )
    discard(docs.sparkSession, packed_path, runs_path)
    joined = docs.join(ranges, ["id", "key"], "left").select("doc_id", "text", "cut")

    def finish(batches):
        for batch in batches:
            n_words, n_removed, digest, kept_text = [], [], [], []
            cuts = batch.column(2)
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = text.encode().split()
                n_words.append(len(words))
                if cuts[i].is_valid:
                    keep = np.zeros(len(words) + 1, dtype=np.int32)
                    p = cuts[i].values.to_numpy()
                    np.add.at(keep, p, 1)
                    np.add.at(keep, p + window, -1)
                    words = [w for w, k in zip(words, keep[:-1].cumsum(), strict=True) if not k]
                n_removed.append(n_words[-1] - len(words))
                kept = b" ".join(words)
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept_text, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return joined.mapInArrow(finish, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")
