"""Benchmark passages with words put in or left out, by the registered query."""

from trustloom.llm import decontam
from trustloom.llm.queries import QUERIES


def test_near_passages_are_returned(spark, tmp_path):
    w = [f"word{chr(97 + i)}" for i in range(16)]
    texts = {
        1: " ".join(w),
        2: " ".join(["start", *w[:8], "inserted", *w[8:], "end"]),
        3: " ".join(w[:7] + w[8:]),
        4: " ".join(w[:4]),
        5: " ".join(reversed(w)),
        6: None,
    }
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, " ".join(w)), (2, " ".join(w[:5] + ["absent"] + w[5:13])), (3, " ".join(w[:3] + ["no", "such", "words"] + w[3:13]))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    exact = {r["doc_id"]: r for r in QUERIES["op9_positional_index"](spark, str(tmp_path)).collect()}
    near = {r["doc_id"]: r for r in QUERIES["op9_proximity"](spark, str(tmp_path)).collect()}
    assert all(near[i][c] == r[c] for i, r in exact.items() for c in exact[1].__fields__)
    assert (near[1]["n_items"], near[1]["contaminated"]) == (1, True)
    # item 2 has a word that no document has, item 3 has three of them
    assert {i: r["n_near"] for i, r in near.items()} == {1: 1, 2: 2, 3: 2, 4: 0, 5: 0, 6: 0}


def test_absent_terms_give_no_anchor_but_may_be_passed_over():
    item = [(("1"), [b"a", b"b", b"absent", b"c"])]
    counts = {b"a": 1, b"b": 2, b"c": 3}
    assert decontam.anchors(item, counts) == []
    assert decontam.anchors(item, counts, slop=2) == [(0, b"a", 0, b"b", 1), (0, b"a", 0, b"c", 3), (0, b"b", 1, b"c", 3)]


def test_proximity_equals_brute_force(spark):
    """Every alignment of every item with every document, compared word by word."""
    import random

    r = random.Random(3)
    word = lambda: f"w{r.randrange(60)}"
    items = [(i, [word() for _ in range(r.choice([3, 9, 13, 20]))]) for i in range(12)]
    docs = []
    for i in range(60):
        w = list(r.choice(items)[1])
        for _ in range(r.randrange(5)):
            at = r.randrange(len(w) + 1)
            if r.random() < 0.5:
                w.insert(at, word())
            elif len(w) > 2:
                del w[min(at, len(w) - 1)]
        docs.append((i, [word() for _ in range(r.randrange(20))] + w + [word() for _ in range(r.randrange(20))]))
    made = lambda rows, name: spark.createDataFrame([(i, " ".join(w)) for i, w in rows], f"{name} bigint, text string")
    for slop in (1, 2):
        got = {x["doc_id"]: (x["n_items"], x["n_near"]) for x in decontam.decontaminate(made(docs, "doc_id"), made(items, "item_id"), slop=slop, block_bytes=400).collect()}
        for i, w in docs:
            text = [x.encode() for x in w]
            exact, near = set(), set()
            for k, item in items:
                it = [x.encode() for x in item]
                for delta in range(-len(it), len(text)):
                    if decontam.phrase_hits(text, it, delta, decontam.WINDOW):
                        exact.add(k)
                    if decontam.is_near(text, it, delta, decontam.WINDOW, slop):
                        near.add(k)
            assert got[i] == (len(exact), len(near - exact))
