from __future__ import annotations

import random
import time
from html import unescape

import pytest
from texts import SF, table

from cohortal.llm import html_text, registry

CASES = [
    (None, ""),
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("a<br>b<br/>c</br>d", "a\nb\nc\nd"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>e", "- a\n- b\n  3. c\n  4. d\n\ne"),
    ("<head><title>t</title></head><script>var x='</p>'</script>x<style>p{}</style>", "x"),
    ("x<!-- <p>no</p> -->y<!-- open", "xy"),
    ("<p hidden>a</p><p style='display: NONE'>b</p><p style='visibility:hidden'>c</p>d", "d"),
    ("<details><summary>s</summary>no<p>no</details><details open>yes</details>", "s\nyes"),
    ("<dialog>no</dialog><template>no</template><noscript>no</noscript>a", "a"),
    ("a &amp; b &lt;p&gt; &copy; &#65;", "a & b <p> © A"),
    ("3 < 4 and 5 > 2", "3 < 4 and 5 > 2"),
    ("<pre>  a\n    b</pre>", "  a\n    b"),
    ("<table><tr><th>Name<th>n<tr><td>long name<td>1<tr><td>x</table>",
     "Name       n\nlong name  1\nx"),
    ("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>", "a     d\n\nb  c"),
    ("<b>a<p>b</b>c", "a\n\nbc"),
    ("<p>a <b>b</b> <i>c</i>d</p>", "a b cd"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<a title='x>y'>z</a><a title=\"unclosed>q", "zq"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("</p></div>a</li>", "a"),
    ("<td>lone</td>", "lone"),
    ("<html><head><title>t</title><body><p>text", "text"),
    ("<head><meta charset=x><title>t</title><p>a<p>b", "a\n\nb"),
    ("<head/><title>t</title> <link rel=x>\n a &amp; <b>b</b>", "a & b"),
    ("<head><script>s</script><style>p{}</style><bgsound src=x><noscript><div>n</noscript>"
     "<template><div>m</template><body>a</body>", "a"),
    ("<HEAD><title>t</title><head><h1>a</h1></head><div>b", "a\n\nb"),
    ("<head><noscript><div>n</head><body>a", "a"),
    ("<noscript><div>no</noscript>a", "a"),
    ("<p>a<xmp>  <b>x</b> &amp;\n  y</xmp>b", "a\n\n  <b>x</b> &amp;\n  y\n\nb"),
    ("<div style='visibility:hidden'>no<p>no<b style='visibility: visible'>yes<i>too</b></div>z",
     "yestoo\n\nz"),
    ("<p style='visibility:hidden; visibility:visible'>a<p style='visibility:collapse'>no", "a"),
    ("<p style='visibility:hidden!important;visibility:visible'>no</p>"
     "<pre style='visibility:hidden'>no\nno<b style='visibility:inherit'>no</b></pre>a", "a"),
    ("<table><tr><td style='visibility:hidden'>no<td>b<tr><td>c<td>d</table>", "   b\nc  d"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_visible_text(html, text):
    assert html_text.visible_text(html) == text


def test_deep_and_long_pages():
    assert html_text.visible_text("<div>" * 50_000 + "x") == "x"
    assert html_text.visible_text("<p>ab" * 50_000).count("ab") == 50_000
    html_text.visible_text('<a b="' * 3000)
    html_text.visible_text("<" * 20_000 + "!--" * 2000)


def test_page_of_a_million_characters():
    for page in ("<p>x</p>" + "<div>" * 200_000, '<a "' * 250_000, "<p><button>" + "<div>" * 200_000,
                 "<!" * 500_000, "<td>" * 250_000 + "</td>" * 5, "<b><p>" * 170_000 + "</b>" * 20):
        start = time.process_time()
        html_text.visible_text(page)
        assert time.process_time() - start < 20, page[:20]
    start = time.process_time()
    html_text.build("<p>x</p>" + "<div>" * 200_000)
    html_text.build('<a "' * 250_000)
    assert time.process_time() - start < 5


class SlowOpen(html_text.Open):
    """The open elements as a plain list, searched from its end for every question."""

    def push(self, node):
        self.nodes.append(node)

    def close_from(self, place):
        del self.nodes[place:]

    def close_outermost(self, names, barrier):
        cut = None
        for i in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[i].name in barrier:
                break
            cut = i if self.nodes[i].name in names else cut
        if cut is not None:
            del self.nodes[cut:]

    def close_one(self, name, barrier):
        block = False
        for i in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[i].name == name:
                if block and name not in html_text.CLOSERS:
                    del self.nodes[i]
                else:
                    del self.nodes[i:]
                return
            block = block or self.nodes[i].name in html_text.BLOCKS
            if self.nodes[i].name in barrier:
                return


def test_generated_pages_against_a_slow_tree_builder(monkeypatch):
    rng = random.Random(5)
    names = "p div b i ul li table tr td th thead head body button select option dl dt dd a".split()
    pages = []
    for _ in range(1500):
        parts = [
            rng.choice(["x", " ", "<br>", "</br>", "<!-- c -->"]) if rng.random() < 0.3
            else f"<{rng.choice(['', '', '/'])}{rng.choice(names)}>"
            for _ in range(rng.randint(1, 40))
        ]
        pages.append("".join(parts))
    texts = [html_text.visible_text(page) for page in pages]
    monkeypatch.setattr(html_text, "Open", SlowOpen)
    for page, text in zip(pages, texts):
        assert html_text.visible_text(page) == text, page


def test_query_has_all_text_of_every_page(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, "pages").collect()}
    rows = registry.QUERIES["op5_html_layout_text"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        html = pages[r["page_id"]]
        body = html[html.index("<body>") :]
        assert "<p>" not in r["text"] and "track(" not in r["text"]
        heading = body.split("<h1>")[1].split("</h1>")[0]
        assert " ".join(unescape(heading).split()) in r["text"]


def test_edge_rows(spark):
    schema = "page_id bigint, html string, text string, url string"
    rows = [(1, None, "old", "u"), (1, "<p>a", None, None), (None, "b", "x", "y"), (1, "<p>a", None, None)]
    out = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in out) == [(0, "b"), (1, ""), (1, "a"), (1, "a")]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0
