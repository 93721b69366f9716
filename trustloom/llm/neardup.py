"""MinHash near-dedup with odd sketches.

1. Texts with the same words are one class, named by its smallest doc_id; only classes go on.
2. A class has ``BANDS * ROWS`` MinHash samples of its word shingles. They make band keys, and are folded
   into an odd sketch: a bitmap in which each sample flips one bit, so that the XOR of two sketches
   counts the samples in which they differ, and its population count estimates a high similarity.
3. Classes that share a band key are candidates. First each is compared with the smallest class of its
   bucket, and verified links are contracted to components. That closes most buckets, however large.
4. In the buckets whose members still lie in several components, sketches are compared inside the
   bucket's task (never emitted as pairs): a member stays if the sketch of some member of another
   component is as near as two sets at the threshold may be by chance of ``MARGIN`` deviations. The
   members that stay meet again with their full sets, exact intersections come from one matrix
   product, and only links that join two components are emitted, fewer than the bucket has members.
5. Components come from alternating large and small stars, as joins and aggregations over the links.

A large bucket is never one task: its members are dealt into blocks, and every two blocks (and every block
by itself) are a group of their own, of at most ``2 * BLOCK`` members, so each pair of members meets in
some group and no bucket size changes a result. All links are judged on full sets, in the star step by
reading both texts. A pair at the threshold shares no band, and is missed, with probability below 3e-7.

Defined cases: a null or empty text has the empty set, is in a component of its own and is kept; fewer
words than a shingle are one shingle; repeated rows and equal texts are one class, of which the
smallest doc_id is kept (rows repeated with that id are all marked kept); of rows with one id and
several texts, each has its own set size, and the smallest text is the one compared; a null doc_id is larger than
every other and a null component is given back for it. Ids are whole numbers below 2^63 - 1, other types
are refused. Texts of any length are read whole; an empty table gives no rows; other columns are ignored.
Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from trustloom.llm.common import checked, discard, materialize, partitions_for, whole_ids, written_bytes
from trustloom.llm.words import U, chunks, mix, signed

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 26, 5
SKETCH_BITS = 512
MARGIN = 6.0
#: Members of a block, at least and at most; a bucket that fits into the least is one group.
LEAST_BLOCK, BLOCK = 256, 1000
NO_ID = (1 << 63) - 1

_SEEDS = mix(np.arange(1, 2048, dtype=np.uint64) * U(0x9E3779B97F4A7C15))


def shingle_sets(chunk, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts of a chunk, and where each text's begin."""
    n_words = np.diff(chunk.bounds)
    grams = chunk.ngrams(k)
    place = np.arange(len(grams))
    text = np.searchsorted(chunk.bounds, place, side="right") - 1
    inside = place + k <= chunk.bounds[text + 1] if len(place) else np.zeros(0, dtype=bool)
    grams, text = grams[inside], text[inside]
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        whole = np.array([chunk.span_hash(chunk.bounds[t], chunk.bounds[t + 1], 7) for t in short], dtype=U)
        grams, text = np.concatenate([grams, whole]), np.concatenate([text, short])
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    grams, text = grams[new], text[new]
    return grams, np.searchsorted(text, np.arange(chunk.n_texts + 1))


def minhashes(grams: np.ndarray, starts: np.ndarray, n: int, first: int = 0) -> np.ndarray:
    """``n`` MinHash samples (texts by samples) of non-empty sets; 32 bits of each are kept."""
    out = np.empty((len(starts) - 1, n), dtype=np.uint32)
    low = (grams >> U(32)).astype(np.uint32) ^ grams.astype(np.uint32)
    high = (grams >> U(17)).astype(np.uint32)
    for j in range(n):
        a, b = int(_SEEDS[(first + j) * 2]) | 1, int(_SEEDS[(first + j) * 2 + 1])
        h = low * np.uint32(a & 0xFFFFFFFF) + (high ^ np.uint32(b & 0xFFFFFFFF)) * np.uint32((a >> 32) | 1)
        h ^= h >> np.uint32(15)
        h *= np.uint32((b >> 32) | 1)
        h ^= h >> np.uint32(13)
        out[:, j] = np.minimum.reduceat(h, starts[:-1])
    return out


def odd_sketches(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps of the (sample number, value) pairs; rows of ``bits // 8`` bytes."""
    n, k = samples.shape
    spot = mix(samples.astype(U) + _SEEDS[:k][None, :]) % U(bits)
    flat = (np.arange(n, dtype=np.int64)[:, None] * bits + spot.astype(np.int64)).ravel()
    return np.packbits((np.bincount(flat, minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits), axis=1)


def most_differing_bits(percent: int, k: int = BANDS * ROWS, bits: int = SKETCH_BITS, margin: float = MARGIN) -> int:
    """Set bits in the XOR beyond which a pair cannot reach the threshold, within ``margin`` deviations."""
    j = percent / 100
    differing = k * (1 - j) + margin * (k * j * (1 - j)) ** 0.5
    flips = 2 * differing
    expected = bits / 2 * (1 - (1 - 2 / bits) ** flips)
    return int(min(bits, expected + margin * (bits / 4 * (1 - (1 - 4 / bits) ** flips)) ** 0.5 + 2))


def _class_hash(chunk) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text's word sequence."""
    out = np.zeros((2, chunk.n_texts), dtype=U)
    n = np.diff(chunk.bounds)
    for s, odd in enumerate((U(0xA24BAED4963EE407), U(0x9FB21C651E98DF25))):
        place = np.arange(len(chunk.hash), dtype=U)
        local = place - np.repeat(chunk.bounds[:-1], n).astype(U)
        each = mix(chunk.hash * odd + local * U(0xD6E8FEB86659FD93))
        total = np.concatenate([[U(0)], np.cumsum(each)])
        out[s] = mix(total[chunk.bounds[1:]] - total[chunk.bounds[:-1]] + n.astype(U))
    return out[0], out[1]


def signatures(docs: DataFrame) -> DataFrame:
    """(id, text_hash, c1, c2, n_shingles, bands, sketch) of each row of (id, text_hash, text); zero bands for empty sets."""

    def run(batches):
        for batch in batches:
            for c in chunks(batch.column(2), lower=True):
                c1, c2 = _class_hash(c)
                grams, starts = shingle_sets(c)
                sizes = np.diff(starts)
                full = np.flatnonzero(sizes)
                bands = np.zeros((c.n_texts, BANDS), dtype=U)
                sketch = [None] * c.n_texts
                if len(full):
                    samples = minhashes(grams, np.append(starts[:-1][full], len(grams)), BANDS * ROWS)
                    acc = np.zeros((len(full), BANDS), dtype=U)
                    cube = samples.reshape(len(full), BANDS, ROWS)
                    for r in range(ROWS):
                        acc = mix(acc * U(0x9E3779B97F4A7C15) + cube[:, :, r].astype(U) + U(r + 1))
                    bands[full] = mix(acc + _SEEDS[:BANDS][None, :])
                    for t, row in zip(full, odd_sketches(samples), strict=True):
                        sketch[t] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(c.first, c.n_texts),
                        batch.column(1).slice(c.first, c.n_texts),
                        pa.array(signed(c1), pa.int64()),
                        pa.array(signed(c2), pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.arange(c.n_texts + 1, dtype=np.int32) * BANDS), pa.array(signed(bands.ravel()), pa.int64())),
                        pa.array(sketch, pa.binary()),
                    ],
                    ["id", "text_hash", "c1", "c2", "n_shingles", "bands", "sketch"],
                )

    return docs.select("id", "text_hash", "text").mapInArrow(run, "id bigint, text_hash bigint, c1 bigint, c2 bigint, n_shingles bigint, bands array<bigint>, sketch binary")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach ``percent``; both texts travel by id, by pair."""
    left, right = texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yes: list[bool] = []
                both = pa.concat_arrays([part.column(2), part.column(3)])
                sets: list[np.ndarray] = []
                for c in chunks(both, lower=True):
                    grams, starts = shingle_sets(c)
                    sets += [grams[starts[i] : starts[i + 1]] for i in range(c.n_texts)]
                n = part.num_rows
                for i in range(n):
                    x, y = sets[i], sets[n + i]
                    meet = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) else 0
                    yes.append(meet > 0 and 100 * meet >= percent * (len(x) + len(y) - meet))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(yes, pa.bool_())], ["a", "b", "ok"])

    return joined.mapInArrow(run, "a bigint, b bigint, ok boolean").where("ok").select("a", "b")


def _parts(spark, path: str) -> int | None:
    """A partition for each 16 MB of a written table; None where that is no fewer than Spark's own number."""
    n = max(4, written_bytes(spark, path) // (16 << 20))
    return int(n) if n < partitions_for(spark) else None


def components(links: DataFrame, few: int | None = None) -> DataFrame:
    """(id, comp) of every id in ``links`` (a, b): comp is the smallest id connected with it.

    Alternating large and small stars until the links no longer change. Each star is an aggregation of
    the smallest neighbour and a join with it; hub ids are split by Spark's skew handling.
    """
    spark = links.sparkSession

    def held(df: DataFrame, n: int | None) -> tuple[DataFrame, str]:
        return materialize(df.coalesce(n) if n else df, "links")

    edges, path = held(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), few)
    before = None
    while True:
        # large star: every larger neighbour of u goes to u's smallest neighbour (or u)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every smaller neighbour of u, and u, go to u's smallest neighbour
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        fresh, fresh_path = held(after, _parts(spark, path))
        discard(spark, path)
        edges, path = fresh, fresh_path
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(roots)


def _buckets(batches):
    """The record batches of a partition sorted by its first column, as one batch a key."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            if held and held[-1].column(0)[0] != part.column(0)[0]:
                yield _joined(held)
                held = []
            held.append(part)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _groups(members: DataFrame, least: int, most: int) -> DataFrame:
    """(grp, side, id, comp, sketch) of (bucket, n, id, ...): the pairs of blocks in which a bucket's members meet.

    ``side`` is 0 or 1 where two blocks meet, and 2 in the group of one block.
    """
    size = F.greatest(F.lit(least), F.least(F.lit(most), (F.col("n") / 16).cast("long")))
    blocks = F.ceil(F.col("n") / size).cast("long")
    dealt = members.withColumn("_b", F.pmod(F.xxhash64("id"), blocks)).withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    side = F.when(F.col("_b") == F.col("_o"), 2).when(F.col("_b") < F.col("_o"), 0).otherwise(1)
    return dealt.select(F.xxhash64("bucket", F.least("_b", "_o"), F.greatest("_b", "_o")).alias("grp"), side.cast("byte").alias("side"), "id", "comp", "sketch")


def _open_members(groups: DataFrame, most_bits: int) -> DataFrame:
    """(grp, id, comp) of the members to whose sketch one of another component is near enough."""

    def run(batches):
        out: list[pa.RecordBatch] = []
        rows = 0
        for group in _buckets(batches):
            comp, side = group.column(2).to_numpy(), group.column(3).to_numpy()
            sk = np.frombuffer(b"".join(group.column(4).to_pylist()), dtype=np.uint64).reshape(len(comp), -1)
            near = np.zeros(len(comp), dtype=bool)
            rest = np.flatnonzero(side != 0)  # one against the other side, or a block against itself
            for i in np.flatnonzero(side != 1):
                hit = (np.bitwise_count(sk[rest] ^ sk[i]).sum(axis=1, dtype=np.int64) <= most_bits) & (comp[rest] != comp[i])
                if hit.any():
                    near[rest[hit]] = True
                    near[i] = True
            if near.any():
                out.append(group.select([0, 1, 2]).filter(pa.array(near)))
                rows += out[-1].num_rows
            if rows > 5000:
                yield from pa.Table.from_batches(out).to_batches()
                out, rows = [], 0
        if out:
            yield from pa.Table.from_batches(out).to_batches()

    ordered = groups.select("grp", "id", "comp", "side", "sketch").repartition("grp").sortWithinPartitions("grp", "id")
    return ordered.mapInArrow(run, "grp bigint, id bigint, comp bigint")


def shingle_table(texts: DataFrame) -> DataFrame:
    """(id, shingles): the sorted 64-bit shingle hashes of each text, packed."""

    def run(batches):
        for batch in batches:
            for c in chunks(batch.column(1), lower=True):
                grams, starts = shingle_sets(c)
                cells = [grams[starts[i] : starts[i + 1]].tobytes() for i in range(c.n_texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(c.first, c.n_texts), pa.array(cells, pa.binary())], ["id", "shingles"])

    return texts.select("id", "text").mapInArrow(run, "id bigint, shingles binary")


def meets(sets: list[np.ndarray], rows: np.ndarray, width: int = 1024) -> np.ndarray:
    """Sizes of the intersections of the sets at ``rows`` with all sets: products of 0/1 matrices, by columns."""
    sizes = [len(x) for x in sets]
    _, cols, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n > 1
    place = np.cumsum(shared) - 1
    member = np.repeat(np.arange(len(sets)), sizes)
    keep = shared[cols]
    member, cols = member[keep], place[cols[keep]]
    order = np.argsort(cols, kind="stable")
    member, cols = member[order], cols[order]
    out = np.zeros((len(rows), len(sets)), dtype=np.float32)
    total = int(shared.sum())
    for at in range(0, total, width):
        a, b = np.searchsorted(cols, [at, at + width])
        x = np.zeros((len(sets), min(width, total - at)), dtype=np.float32)
        x[member[a:b], cols[a:b] - at] = 1
        out += x[rows] @ x.T
    return out


def spanning_links(ids: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links at the threshold that join components of a bucket: a spanning forest of them."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    names, of, n = np.unique(comp, return_inverse=True, return_counts=True)
    rows = np.flatnonzero(of != n.argmax())
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    block = max(1, (1 << 20) // len(sets))
    for at in range(0, len(rows), block):
        part = rows[at : at + block]
        inter = meets(sets, part).astype(np.int64)
        linked = (100 * inter >= percent * (sizes[part][:, None] + sizes[None, :] - inter)) & (of[part][:, None] != of[None, :])
        for i, j in zip(*np.nonzero(linked), strict=True):
            x, y = root(of[part[i]]), root(of[j])
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((max(int(ids[part[i]]), int(ids[j])), min(int(ids[part[i]]), int(ids[j]))))
    return out


def _links_inside(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of ``spanning_links`` in every group."""

    def run(batches):
        found: list[tuple[int, int]] = []
        for group in _buckets(batches):
            ids, comp = group.column(1).to_numpy(), group.column(2).to_numpy()
            found += spanning_links(ids, comp, [np.frombuffer(x, dtype=U) for x in group.column(3).to_pylist()], percent)
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

    full = members.join(sets, "id").select("grp", "id", "comp", "shingles")
    return full.repartition("grp").sortWithinPartitions("grp", "id").mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, least_block: int = LEAST_BLOCK, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_shingles, component_id, kept, and ``text_hash``, the
    xxhash64 of the text, which tells rows of one id apart."""
    spark = docs.sparkSession
    whole_ids(docs)
    most_bits = most_differing_bits(percent)
    docs = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    sig, sig_path = materialize(signatures(docs), "signatures")
    classes = sig.where("n_shingles > 0").groupBy("c1", "c2").agg(F.min(F.struct("id", "sketch", "bands", "n_shingles")).alias("s"))
    classes, classes_path = materialize(classes.select("c1", "c2", "s.id", "s.sketch", "s.bands"), "classes")

    # band buckets with two members or more; the smallest class of each, with its sketch
    keyed = classes.select("id", "sketch", F.explode("bands").alias("bucket"))
    centres = keyed.groupBy("bucket").agg(F.min(F.struct("id", "sketch")).alias("c"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "c", "n")
    members, members_path = materialize(keyed.join(centres, "bucket").select("bucket", "id", "sketch", "c", "n"), "members")
    wide = F.bit_count  # population count of the XOR, eight bytes at a time
    bits = sum(
        (
            wide(
                F.conv(F.hex(F.substring("sketch", 8 * i + 1, 8)), 16, -10).cast("long").bitwiseXOR(F.conv(F.hex(F.substring("c.sketch", 8 * i + 1, 8)), 16, -10).cast("long"))
            )
            for i in range(SKETCH_BITS // 64)
        ),
        F.lit(0),
    )
    pairs = members.where(F.col("id") != F.col("c.id")).select(F.col("id").alias("a"), F.col("c.id").alias("b"), bits.alias("bits"))
    pairs = pairs.where(F.col("bits") <= most_bits).select("a", "b").distinct()
    # texts of the classes that share a bucket with another one
    wanted = materialize(members.select("id").distinct(), "wanted")
    texts, texts_path = materialize(docs.select("id", "text").join(checked(wanted), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")), "texts")
    links, links_path = materialize(confirm(pairs, texts, percent), "confirmed")
    comps, comps_path = materialize(components(links, _parts(spark, links_path)), "components")

    with_comp = members.join(comps, "id", "left").select("bucket", "id", "sketch", "n", F.coalesce("comp", "id").alias("comp"))
    several = lambda df: df.join(df.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("bucket"), "bucket", "left_semi")
    active, active_path = materialize(several(with_comp), "open")
    left, left_path = materialize(_open_members(_groups(active, least_block, block), most_bits), "near")
    wanted_sets = shingle_table(texts.join(left.select("id").distinct(), "id", "left_semi"))
    more, more_path = materialize(_links_inside(left, wanted_sets, percent), "confirmed")
    if not more.isEmpty():
        links, old = materialize(comps.select(F.col("id").alias("a"), F.col("comp").alias("b")).unionByName(more), "confirmed")
        discard(spark, comps_path)
        comps, comps_path = materialize(components(links, _parts(spark, old)), "components")
        discard(spark, old)
    discard(spark, active_path, left_path, more_path, members_path, texts_path, links_path, wanted[1])

    by_class = classes.select("c1", "c2", "id").join(comps, "id", "left").select("c1", "c2", F.coalesce("comp", "id").alias("comp"))
    found = materialize(by_class, "class-components")
    discard(spark, classes_path, comps_path)
    out = sig.select("id", "text_hash", "c1", "c2", "n_shingles").join(checked(found), ["c1", "c2"], "left")
    comp = F.coalesce("comp", "id")
    kind = docs.schema["doc_id"].dataType
    return out.select(
        F.when(F.col("id") != NO_ID, F.col("id")).cast(kind).alias("doc_id"),
        "n_shingles",
        F.when(comp != NO_ID, comp).alias("component_id"),
        (F.col("id") == comp).alias("kept"),
        "text_hash",
    )
