"""Broken and odd pages, site templates against brute force, responses with codings and digests."""

import base64
import gzip
import hashlib
import json
import random
import time
import zlib
from collections import Counter, defaultdict
from html import unescape
from html.parser import HTMLParser

import pytest

from trustloom.llm import html_main, warc

SCHEMA = "page_id bigint, url string, html string"


@pytest.mark.parametrize("unit", ["<a ", "<a href='", '<p title="', "<!", "<!--", "</", "<b>", "</i>", "<li>", "<b><div><i></b>", "<script>", "< ", "<a x=\"'>", "&amp;", "<p class ", "<td>", "<article>"])
def test_broken_pages_take_linear_time(unit):
    html = "<html><body><p>start</p>" + unit * ((1 << 20) // len(unit))
    began = time.time()
    root = html_main.parse(html)
    nodes = html_main.main_nodes(root)
    html_main.hash_subtrees(root, nodes)
    assert html_main.text_of(nodes, set()).startswith("start") or "<article>" in unit
    parsed = time.time() - began
    began = time.time()
    assert warc.read_html(html, "https://x.org/")[0].startswith("start")
    assert parsed < 8 and time.time() - began < 8  # seconds for a megabyte; quadratic time would be hours


def test_quotes_and_raw_elements():
    root = html_main.parse("<p title='a>b' data-id=menu>it's<br/>one</p><p class=\"x>two</p><script>if (a<b) '</p>'</script><P>Three</p>")
    assert html_main.text_of([root], set()) == "it's one two Three"
    text, links, title = warc.read_html("<title>A &lt; B</title><a href=/x?a=1&amp;b=2>go</a> 1 < 2 <img src='i.png'><iframe src=//y.org/>in", "https://x.org/d/")
    assert (text, title) == ("go 1 < 2 in", "A < B") and [x["url"] for x in links] == ["https://x.org/x?a=1&b=2", "https://x.org/d/i.png", "https://y.org/"]


class Tree(HTMLParser):
    """Well-formed pages as nested lists [tag, children...], by the standard library."""

    def __init__(self, html):
        super().__init__(convert_charrefs=False)
        self.stack = [["#"]]
        self.feed(html)

    def handle_starttag(self, tag, attrs):
        node = [tag]
        self.stack[-1].append(node)
        self.stack.append(node)

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        self.stack[-1].append(data)

    def handle_entityref(self, name):
        self.stack[-1].append(f"&{name};")


def pages_without_main(seed):
    """Hosts whose pages mix own paragraphs with boxes that recur, some nested, none of a furniture class."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    out = []
    for h in range(4):
        boxes = [f"<div><b>{word()}</b><ul><li>{word()}</li><li>{word()} &amp; {word()}</li></ul></div>" for _ in range(3)]
        for _ in range((2, 6, 15, 40)[h]):
            parts = [f"<p>{' '.join(word() for _ in range(r.randint(1, 9)))}</p>" for _ in range(r.randint(1, 5))]
            for b in boxes:
                if r.random() < (0.9, 0.6, 0.2)[boxes.index(b)]:
                    parts.insert(r.randrange(len(parts) + 1), b if r.random() < 0.7 else f"<section>{b}<p>{word()}</p></section>")
            out.append((len(out), f"https://h{h}.org/{len(out)}", f"<html><body>{''.join(parts)}</body></html>"))
    return out


def brute_templates(rows, share, least):
    """Counts every subtree as nested text, page by page, and cuts what recurs."""
    trees = {i: (u.split("/")[2], Tree(h).stack[0]) for i, u, h in rows}
    seen, pages = defaultdict(Counter), Counter()

    def subtrees(node):
        for c in node[1:]:
            if isinstance(c, list):
                yield c
                yield from subtrees(c)

    for host, tree in trees.values():
        pages[host] += 1
        seen[host].update({json.dumps(x) for x in subtrees(tree) if x[0] not in ("html", "body")})

    def text(node, host):
        out = []
        for c in node[1:]:
            if isinstance(c, str):
                out.append(c)
            elif not (seen[host][json.dumps(c)] >= max(least, share * pages[host])):
                out.append(" " + text(c, host) + " " if c[0] != "b" else text(c, host))
        return "".join(out)

    return {i: " ".join(unescape(text(tree, host)).split()) for i, (host, tree) in trees.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_equal_brute_force(spark, seed):
    rows = pages_without_main(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {x["page_id"]: x for x in html_main.extract_main(df).collect()}
    assert {i: x["text"] for i, x in got.items()} == brute_templates(rows, html_main.SHARE, html_main.LEAST_PAGES)
    off = {x["page_id"]: x for x in html_main.extract_main(df, share=2.0).collect()}
    assert {i: x["text"] for i, x in off.items()} == brute_templates(rows, 2.0, html_main.LEAST_PAGES)
    changed = [i for i in got if got[i]["text"] != off[i]["text"]]
    assert len(changed) > len(rows) / 2 and all(got[i]["n_template"] > 0 for i in changed) and not any(x["n_template"] for x in off.values())


def test_odd_pages(spark):
    rows = [(1, None, "<p>a</p>"), (2, "x", None), (2, "x", ""), (3, "https://h.org/", "<p>" + "word " * 200_000 + "</p>")] + [(4, "https://h.org/1", "<div>same box</div><p>own</p>")] * 9
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], SCHEMA + ", text string, host int")
    got = html_main.extract_main(df).collect()
    assert sorted((x["page_id"], x["n_chars"]) for x in got if x["page_id"] < 4) == [(1, 1), (2, 0), (2, 0), (3, 999_999)]
    assert len(got) == len(rows) and html_main.extract_main(df.limit(0)).count() == 0


def response(body, *headers, status="HTTP/1.1 200 OK"):
    return "\r\n".join([status, *headers]).encode() + b"\r\n\r\n" + body


def chunked(data, size=7):
    parts = [data[i : i + size] for i in range(0, len(data), size)]
    return b"".join(b"%x;ext=1\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def test_codings_and_digests():
    page = "<p>Grüße an alle</p>".encode()
    sha = hashlib.sha1(page)
    b32, hexed = "sha1:" + base64.b32encode(sha.digest()).decode(), "sha1:" + sha.hexdigest()
    cases = [
        (response(page), b32, True), (response(page), hexed, True), (response(page), "sha1:" + "A" * 32, False), (response(page), "odd:1", False), (response(page), None, True),
        (response(chunked(page), "Transfer-Encoding: chunked"), b32, True),
        (response(page, "Transfer-Encoding: chunked"), b32, True),
        (response(gzip.compress(page), "Content-Encoding: gzip"), "sha1:" + hashlib.sha1(gzip.compress(page, mtime=0)).hexdigest(), None),
        (response(chunked(zlib.compress(page)), "transfer-encoding: chunked", "content-encoding: deflate"), None, True),
        (response(page.decode().encode("latin-1"), "Content-Type: text/html; charset=ISO-8859-1"), None, True),
    ]
    for block, given, ok in cases:
        meta, text = warc.derive("<urn:x>", "https://x.org/", "2024-01-01T00:00:00Z", None, given, block)
        assert text["block"] == "Grüße an alle" and (ok is None or text["digest_ok"] == ok)
        assert given is None or json.loads(meta["block"])["source"]["given_payload_digest"] == given == text["source_payload_digest"]
    for coding in ("br", "gzip"):
        meta, text = warc.derive(None, None, None, None, None, response(b"\x00\xff<p>x", f"Content-Encoding: {coding}"))
        assert text["block"] == "" and json.loads(meta["block"])["http"]["decoded"] is False


def test_derivatives_keep_the_given_digest_and_every_link(spark, tmp_path):
    rows = [(i, f"https://h.org/{i}", f"<a href=/{i}>x</a><p>Text {i}</p>") for i in range(30)] + [(5, "u\r\nX: y", "<p>" + "w " * 300_000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA + ", block string, record_id int")
    responses = warc.responses_of_pages(df)
    got = warc.derivatives(responses, key="page_id").collect()
    assert len(got) == 2 * len(rows) and all(x["digest_ok"] for x in got)
    for x in got:
        html = [h for i, _, h in rows if i == x["page_id"]]
        assert x["source_payload_digest"] in {"sha1:" + hashlib.sha1(h.encode()).hexdigest() for h in html}
    assert warc.derivatives(responses.limit(0)).count() == 0
    out = str(tmp_path / "w")
    assert warc.write_warc(warc.derivatives(responses.repartition(3)), out) == len(got)
    heads = [h for f in (tmp_path / "w").iterdir() for h, _ in warc.parse_warc(open(f, "rb"))]
    assert len(heads) == len(got) and all("X" not in h for h in heads) and sum(h["WARC-Target-URI"] == "u%0D%0AX: y" for h in heads) == 2


def test_warc_files_are_read_as_streams(spark, tmp_path):
    bodies = [response(b"<p>%d</p>" % i) for i in range(50)]
    raw = [b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:%d>\r\nX-Long: a\r\n b\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (b"response" if i % 5 else b"request", i, len(b), b) for i, b in enumerate(bodies)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in raw))
    (tmp_path / "b.warc").write_bytes(b"".join(raw))
    (tmp_path / "c.warc").write_bytes(b"")
    got = warc.read_warc(spark, str(tmp_path)).collect()
    assert Counter(x["record_id"] for x in got) == Counter({f"<urn:{i}>": 2 for i in range(50) if i % 5})
    assert {x["record_id"]: bytes(x["block"]) for x in got} == {f"<urn:{i}>": bodies[i] for i in range(50) if i % 5}
    assert json.loads(got[0]["warc_headers"])["X-Long"] == "a b"
