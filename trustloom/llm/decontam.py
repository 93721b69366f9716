"""Benchmark decontamination over a distributed positional inverted index.

1. Count, over all documents, the terms that occur in the test items.
2. For each test phrase (13 words, or a shorter item whole) take its rarest term and the rarest of its
   other places as anchors. Neighbouring phrases mostly share them, so an item has a few anchor pairs.
3. Store the postings (term, document, positions) of the anchor terms of all documents as a table.
4. Intersect the offset-adjusted lists: the postings of both anchors, each less the anchor's place in
   the item, have the alignments of item and document in common. With ``slop``, all alignments up to
   ``slop`` away from where an anchor stands are candidates of proximity matches.
5. Documents with alignments are read once more and compared word by word, so hits are exact. What comes
   back is a row (document, item, ranges of words).

The test items are the query set: they are read in blocks of ``block_bytes``. A task holds one block's terms
or items at a time, whatever the number of blocks; a block costs two readings of the corpus and one of
the documents with alignments. Its anchors are broadcast below the limit of ``common.checked``. Joins are
by (document, term) or by term, whose postings are spread by Spark's skew handling; no group is
gathered but a document's own alignments and hits.

A proximity match: an alignment at which all but ``slop`` words of a phrase, two at least, stand within
``slop`` words of their places.

Defined cases: a null text has no words and no hit; an item without words is in no document; a null
doc_id is matched with itself; repeated rows each get the result; item ids are compared as strings, a
null one as the empty string, and equal ids count once. An empty table of items leaves all clean, an empty
table of documents gives no rows; texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustloom.llm.common import checked, discard, materialize
from trustloom.llm.words import ALNUM

WINDOW = 13
BLOCK_BYTES = 16 << 20


def tokens(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lowering A-Z, as bytes."""
    return text.encode().translate(ALNUM).split() if text else []


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    held: list[tuple[str, list[bytes]]] = []
    size = 0
    for row in items.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t")).toLocalIterator():
        if words := tokens(row["t"]):
            held.append((row["i"] or "", words))
            size += sum(map(len, words)) + 8 * len(words)
        if size > block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def term_counts(docs: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """How often each of ``terms`` occurs in all documents; partial counts are summed per task first."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches):
        seen: Counter = Counter()
        has = known.value.__contains__
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(filter(has, tokens(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term binary, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["term"]): r["n"] for r in rows}


def anchors(block: list[tuple[str, list[bytes]]], counts: dict[bytes, int], window: int = WINDOW, slop: int = 0) -> list[tuple[int, bytes, int, bytes | None, int]]:
    """(item, rarest term, its place, second anchor or None, its place) for the phrases of a block.

    Phrases with a term that no document has cannot occur and get no anchors. With ``slop``, pairs of the
    ``slop`` + 2 rarest places whose terms do occur are added: a near phrase may lack any ``slop`` words.
    """
    out = set()
    for k, (_, words) in enumerate(block):
        n = min(window, len(words))
        df = [counts.get(w, 0) for w in words]
        for at in range(len(words) - n + 1):
            order = sorted(range(at, at + n), key=lambda p: (df[p], words[p], p))
            if slop:  # of slop + 2 places, two are left when up to slop words are
                there = [p for p in order if df[p]]
                if len(there) >= max(2, n - slop):
                    out.update((k, words[p], p, words[q], q) for p, q in combinations(there[: slop + 2], 2))
            if df[order[0]] == 0:
                continue
            p = order[0]
            other = next((q for q in order[1:] if words[q] != words[p]), order[1] if n > 1 else None)
            out.add((k, words[p], p, None if other is None else words[other], p if other is None else other))
    return sorted(out, key=lambda a: (a[0], a[2], a[4]))


def postings(docs: DataFrame, terms: set[bytes]) -> DataFrame:
    """The index: (key, term, positions) of ``terms`` in all documents."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def index(batches):
        wanted = known.value
        for batch in batches:
            ids, of, terms_out, places = batch.column(0), [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                lists: dict[bytes, list[int]] = {}
                words = tokens(text)
                if wanted.isdisjoint(words):
                    continue
                for p, w in enumerate(words):
                    if w in wanted:
                        lists.setdefault(w, []).append(p)
                of += [row] * len(lists)
                terms_out += lists
                places += lists.values()
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(of, pa.int64())), pa.array(terms_out, pa.binary()), pa.array(places, pa.list_(pa.int32()))], ["key", "term", "positions"]
            )

    return docs.select("key", "text").mapInArrow(index, "key bigint, term binary, positions array<int>")


def alignments(index: DataFrame, pairs: DataFrame, slop: int = 0) -> DataFrame:
    """(key, item, delta, exact) where both anchors of a pair stand at ``delta`` plus their places.

    With ``slop`` above 0, also (exact false) all up to ``slop`` away from one anchor and from the other.
    """
    first = index.join(pairs, index["term"] == pairs["term1"]).select("key", "item", "term2", "p2", F.transform("positions", lambda p: p - F.col("p1")).alias("d1"))
    alone = first.where(F.col("term2").isNull()).select("key", "item", F.col("d1").alias("d"), F.lit(True).alias("exact"))
    second = index.select(F.col("key").alias("_key"), F.col("term").alias("_term"), F.col("positions").alias("_p"))
    both = first.join(second, (F.col("key") == F.col("_key")) & (F.col("term2") == F.col("_term")))
    both = both.select("key", "item", "d1", F.transform("_p", lambda p: p - F.col("p2")).alias("d2"))
    found = alone.unionByName(both.select("key", "item", F.array_intersect("d1", "d2").alias("d"), F.lit(True).alias("exact")))
    if slop:
        around = lambda name: F.array_distinct(F.flatten(F.transform(name, lambda d: F.sequence(d - slop, d + slop))))
        found = found.unionByName(both.select("key", "item", F.array_intersect(around("d1"), around("d2")).alias("d"), F.lit(False).alias("exact")))
    return found.select("key", "item", F.explode("d").alias("delta"), "exact").distinct()


def phrase_hits(words: list[bytes], item: list[bytes], delta: int, window: int) -> list[tuple[int, int]]:
    """Ranges of document words that lie in phrases of ``item`` placed at ``delta``."""
    n = min(window, len(item))
    lo, hi = max(0, -delta), min(len(item), len(words) - delta)
    out, p = [], lo
    while p < hi:
        if words[p + delta] != item[p]:
            p += 1
            continue
        q = p
        while q < hi and words[q + delta] == item[q]:
            q += 1
        if q - p >= n:
            out.append((p + delta, q + delta))
        p = q
    return out


def is_near(words: list[bytes], item: list[bytes], delta: int, window: int, slop: int) -> bool:
    """Some phrase of ``item`` placed at ``delta`` has all but ``slop`` words, two at least, within ``slop`` words of their places."""
    n = min(window, len(item))
    there = [w in words[max(0, p + delta - slop) : max(0, p + delta + slop + 1)] for p, w in enumerate(item)]
    return any(sum(there[at : at + n]) >= max(2, n - slop) for at in range(len(item) - n + 1))


def _hits(docs: DataFrame, block: list[tuple[str, list[bytes]]], window: int, slop: int) -> DataFrame:
    """(doc_id, key, item, spans) of a block's items: ranges of hit words, or none for a proximity match."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = term_counts(docs, {w for _, words in block for w in words})
    pairs = anchors(block, counts, window, slop)
    schema = f"doc_id {kind}, key bigint, item string, spans array<struct<a:int,b:int>>"
    if not pairs:
        return spark.createDataFrame([], schema)
    index, index_path = materialize(postings(docs, {t for a in pairs for t in (a[1], a[3]) if t is not None}), "postings")
    rows = materialize(spark.createDataFrame(pairs, "item int, term1 binary, p1 int, term2 binary, p2 int"), "anchors")
    found = alignments(index, checked(rows), slop).groupBy("key").agg(F.collect_list(F.struct("item", "delta", "exact")).alias("found"))
    side = materialize(found.withColumnRenamed("key", "_key"), "alignments")
    discard(spark, index_path, rows[1])
    joined = docs.join(checked(side), F.col("key") == F.col("_key")).select("doc_id", "key", "text", "found")
    items = spark.sparkContext.broadcast(block)

    def compare(batches):
        every = items.value
        for batch in batches:
            of, names, spans = [], [], []
            for i, (text, places) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                words = tokens(text)
                hit: dict[str, list] = {}
                close: set[str] = set()
                for f in places:
                    name, item = every[f["item"]]
                    if f["exact"]:
                        if at := phrase_hits(words, item, f["delta"], window):
                            hit.setdefault(name, []).extend(at)
                    elif name not in close and is_near(words, item, f["delta"], window, slop):
                        close.add(name)
                found = list(hit.items()) + [(name, []) for name in sorted(close - set(hit))]
                of += [i] * len(found)
                names += [name for name, _ in found]
                spans += [[{"a": a, "b": b} for a, b in at] for _, at in found]
            row = pa.array(of, pa.int64())
            kinds = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(names, pa.string()), pa.array(spans, kinds)], ["doc_id", "key", "item", "spans"])

    hits, _ = materialize(joined.mapInArrow(compare, schema), "hits")
    items.destroy()
    discard(spark, side[1])
    return hits


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, items, n_near, contaminated, text_hash (xxhash64 of the text).

    ``n_near``: items with a proximity match and no exact phrase (0 if slop is 0).
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))  # rows of one id and different texts are told apart
    hits = None
    for block in _blocks(items, block_bytes):
        found = _hits(keyed, block, window, slop)
        hits = found if hits is None else hits.unionByName(found)
    found_type = "array<struct<item:string,spans:array<struct<a:int,b:int>>>>"
    if hits is None:
        joined = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.lit(None).cast(found_type).alias("found"))
    else:
        per_doc = hits.groupBy("doc_id", "key").agg(F.collect_list(F.struct("item", "spans")).alias("found"))
        side = materialize(per_doc.select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), "found"), "found")
        joined = keyed.join(checked(side), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key")), "left").select("doc_id", "text", F.xxhash64("text").alias("text_hash"), "found")

    def judge(batches):
        for batch in batches:
            n_words, n_hit, n_items, near, names = [], [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                n_words.append(len(tokens(text)))
                hit: set[int] = set()
                there = {f["item"] for f in found or () if f["spans"]}
                for f in found or ():
                    for s in f["spans"]:
                        hit.update(range(s["a"], s["b"]))
                n_hit.append(len(hit))
                n_items.append(len(there))
                near.append(len({f["item"] for f in found or ()} - there))
                names.append(sorted(there))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(n_items, pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
                    pa.array([h > 0 and 20 * h >= w for h, w in zip(n_hit, n_words, strict=True)], pa.bool_()),
                    pa.array(names, pa.list_(pa.string())),
                    pa.array(near, pa.int64()),
                    batch.column(2),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "n_near", "text_hash"],
            )

    return joined.mapInArrow(
        judge, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, items array<string>, n_near bigint, text_hash bigint"
    )
