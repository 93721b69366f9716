"""Templates inside the main element against copies of articles."""

import random

import pytest

from trustloom.llm import html_main

SYL = "ta re mi so lu den kor vash pel un".split()
BOX = "<div class=box><p>Get our letter every week.</p><ul><li><a href=/x>More like this</a></li></ul></div>"
SAID = "Get our letter every week. More like this"


def prose(r, n):
    return " ".join("".join(r.choice(SYL) for _ in range(r.randint(1, 3))) for _ in range(n))


def texts(spark, pages):
    rows = [(i, f"https://{host}/{i}", html) for i, (host, html) in enumerate(pages)]
    return [x["text"] for x in html_main.extract_main(spark.createDataFrame(rows, "page_id bigint, url string, html string")).orderBy("page_id").collect()]


@pytest.mark.parametrize("tag", ["article", "main"])
def test_boxes_inside_the_main_element_are_template(spark, tag):
    r = random.Random(5)
    own = [(prose(r, 3), prose(r, 60), prose(r, 40)) for _ in range(12)]
    pages = [("h.org", f"<nav>m</nav><{tag}><h1>{a}</h1><p>{b}</p>{BOX}<p>{c}</p></{tag}>") for a, b, c in own]
    pages += [("few.org", p) for _, p in pages[:3]]
    got = texts(spark, pages)
    assert got[:12] == [f"{a} {b} {c}" for a, b, c in own]
    assert got[12:] == [f"{a} {b} {SAID} {c}" for a, b, c in own[:3]]  # on too few pages


def test_boxes_of_short_pages_and_beside_copies(spark):
    r = random.Random(6)
    own = [f"<p>Own text number {i} &amp; more.</p>" for i in range(8)]
    copy = f"<p>{prose(r, 50)}</p>"
    got = texts(spark, [("h.org", f"<article>{x}{BOX}</article>") for x in own] + [("h.org", f"<article>{copy}{BOX}</article>")] * 40)
    assert got[:8] == [f"Own text number {i} & more." for i in range(8)]
    assert set(got[8:]) == {copy[3:-4]}


def test_copies_and_near_copies_of_an_article_stay(spark):
    r = random.Random(7)
    same, near, pages = [prose(r, 50) for _ in range(4)], [prose(r, 50) for _ in range(4)], []
    pages += [("a.org", "<article>" + "".join(f"<p>{p}</p>" for p in same) + "</article>")] * 9
    want = [" ".join(same)] * 9
    for i in range(12):
        w = near[i % 4].split()
        w[r.randrange(50)] = f"new{i}"
        parts = [" ".join(w) if k == i % 4 else p for k, p in enumerate(near)]
        pages.append(("b.org", "<article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article>"))
        want.append(" ".join(parts))
    one = "<p>again</p>" * 9
    pages.append(("c.org", f"<article>{one}</article>"))
    assert texts(spark, pages) == [*want, " ".join(["again"] * 9)]
