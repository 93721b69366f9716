"""Tags and texts of HTML in one linear pass, however broken the page is.

Quotes count only after ``=``, and a quote that is never closed is an ordinary character. A tag, comment
or raw element that never ends takes the rest of the page with it, as in browsers, so that no part of a
page is looked at again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|["'=])*+)>""")
_ATTR = re.compile(r"""(?<![^\s/"'])([a-zA-Z][a-zA-Z0-9_:.-]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_ends: dict[str, re.Pattern] = {}

#: A text, or (closing, name, attributes, content of a raw element or None).
Token = str | tuple[bool, str, str, str | None]


def tokens(html: str, raw: frozenset[str]) -> Iterator[Token]:
    """Texts and tags in order; the content of ``raw`` elements is no markup and comes with their start tag."""
    at = look = 0
    n = len(html)
    while True:
        i = html.find("<", look)
        if i < 0:
            if at < n:
                yield html[at:]
            return
        c = html[i + 1 : i + 2]
        if c in _LETTERS and c or c == "/" and html[i + 2 : i + 3] in _LETTERS and html[i + 2 : i + 3]:
            m = _TAG.match(html, i)
            end = m.end() if m else -1
        elif html.startswith("<!--", i):
            m, end = None, html.find("-->", i + 2)
            end = end + 3 if end >= 0 else -1
        elif c in ("!", "?", "/"):
            m, end = None, html.find(">", i) + 1 or -1
        else:  # a plain "<"
            look = i + 1
            continue
        if i > at:
            yield html[at:i]
        if end < 0:
            return
        at = look = end
        if m is None:
            continue
        name = m[2].lower()
        if m[1] or name not in raw:
            yield bool(m[1]), name, m[3], None
            continue
        if m[3].rstrip().endswith("/"):
            yield False, name, m[3], ""
            continue
        close = _ends.setdefault(name, re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>?", re.I)).search(html, at)
        yield False, name, m[3], html[at : close.start()] if close else html[at:]
        if not close:
            return
        at = look = close.end()


def attributes(text: str) -> Iterator[tuple[str, str]]:
    """(name in lower case, value) of the attributes of a tag; no value is the empty one."""
    for m in _ATTR.finditer(text):
        yield m[1].lower(), m[2] or m[3] or m[4] or ""
