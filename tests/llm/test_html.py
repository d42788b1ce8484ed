"""Rendered pages by rule, and pages that once took time or text growing with their square."""

import time

import pytest

from cairn.llm.html import COLUMNS, INDENT, page_text

GOLDEN = {
    "blocks": ("<div>a<p>b<p>c</div>d", "a\n\nb\n\nc\n\nd"),
    "inline": ("a <b>b</b><i>c</i>\n d<br>e<br><br>f", "a bc d\ne\nf"),
    "lists": ("<ul><li>a<ol start=3><li>b<li>c</ol><li>d</ul>", "- a\n  3. b\n  4. c\n- d"),
    "negative start": ("<ol start='-1'><li>a<li>b<li>c</ol>", "-1. a\n0. b\n1. c"),
    "large start": ("<ol start=100000><li>a</ol>", "100000. a"),
    "broken start": ("<ol start='x9'><li>a</ol><ol start=' +7px'><li>b</ol>", "1. a\n\n7. b"),
    "definitions": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\nd\nu\ne"),
    "pre": ("<p>x  y<pre>a  b\n  c</pre>", "x y\n\na  b\n  c"),
    "table": ("<table><caption>t<tr><th>aa<th>b<tr><td>c<td>dd</table>", "t\naa | b\nc  | dd"),
    "spans": ("<table><tr><td rowspan=2>a<td>b<td rowspan=0>c<tr><td>d<tr><td>e<td>f</table>", "a | b | c\n  | d\ne | f"),
    "wide span": ("<table><tr><td colspan=100000>a<td>b<tr><td>c<td>d</table>", "a     | b\nc | d"),
    "hidden": ("<p hidden>a<p style='display: none'>b<p style='visibility:hidden'>c<span style='visibility:visible'>d</span><style>.x{display:none}</style><p class=x>e<p>f", "d\n\nf"),
    "folded": ("<details><summary>s</summary>x</details><details open><summary>t</summary>y</details><dialog>z</dialog>", "s\nt\ny"),
    "code": ("a<script>var s = '<!-- <p>';</script><noscript>n</noscript><template>t</template>b", "ab"),
    "unfinished tag": ("shown <b>this</b> <a href='x > y", "shown this"),
    "unfinished comment": ("shown <!-- not > this", "shown"),
    "signs": ("1 < 2 <3 a<", "1 < 2 <3 a<"),
    "entities": ("&lt;b&gt; &amp;&nbsp;&copy; &unknown; &#x41;", "<b> &\xa0© &unknown; A"),
    "null": (None, ""),
}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_layout_rules(name):
    html, text = GOLDEN[name]
    assert page_text(html) == text


PAGES = {
    "tags": "<a " * 350_000,
    "comments": "<!--" * 250_000,
    "comments with ends of tags": "<!-- > " * 150_000,
    "declarations": "<!x " * 250_000,
    "divs": "<div>" * 200_000 + "x",
    "lists": "<ul><li>x" * 110_000,
    "alternating rowspans": "<table>" + "".join(f"<tr><td rowspan={60_000 if k % 2 else 1}>c" for k in range(40_000)),
    "unclosed style": "<style>" + "a{" * 400_000,
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_a_megabyte_takes_seconds(name):
    began = time.time()
    text = page_text(PAGES[name])
    assert time.time() - began < 60
    lines = text.split("\n")
    assert max(map(len, lines)) <= max(INDENT + 4, 4 * COLUMNS + 4) and len(text) < 25 * len(PAGES[name])
