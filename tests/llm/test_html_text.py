from __future__ import annotations

import random
import re
import time
from html.parser import HTMLParser

import pytest

from parcelake.llm import html_text, tables
from parcelake.llm.html_text import visible_text


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("a<br>b", "a\nb"), ("a &amp; b&nbsp;c", "a & b\xa0c"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>a</div><div>b</div>", "a\nb"), ("x<b> y </b>z", "x y z"),
    ("<h1>t</h1>text<p>p</p>", "t\n\ntext\n\np"), ("<ul><li>a<li>b</ul>", "- a\n- b"),
    ("<ol start=3><li>a</li><li>b</li></ol>", "3. a\n4. b"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "- a\n  - b\n- c"),
    ("<p>a<script>var x='</p>'</script>b<style>p{}</style></p>", "ab"),
    ("a<!-- b --><span hidden>c</span><i style='DISPLAY : none'>d</i><b aria-hidden=true>e</b>f", "aef"),
    ("<table><tr><td>a<td>b<tr><td>long<td>c</table>", "a     b\nlong  c"),
    ("<table><thead><tr><th>h</thead><tbody><tr><td>x<br>y<td>z</table>", "h\nx  z\ny"),
    ("<table><tr><td colspan=2>ab<td>c<tr><td>a<td>b<td>d</table>", "ab     c\na   b  d"),
    ("<pre> a\n  b</pre>", " a\n  b"), ("a</div></p>b", "a\n\nb"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<blockquote>q</blockquote>x", "  q\n\nx"), ("a < b > c", "a < b > c"), ("<head><title>t</title></head>x", "x"),
    ("<img alt='pic'> x", "pic x"), ("<p></p><p></p>x", "x"), ("<li>a", "- a"),
])
def test_layout(source, text):
    assert visible_text(source) == text


@pytest.mark.parametrize("source, text", [
    ("<html><head><title>t</title><p>Hello <b>you</b><p>there", "Hello you\n\nthere"),
    ("<head><meta charset=x>\n<link rel=a>\n<script>1</script> text <div>d</div>", "text\nd"),
    ("<head><template><p>no</p></template><style>p{}</style><h1>yes</h1>", "yes"),
    ("<head><title>t</title>&nbsp;a", "\xa0a"), ("<head><title>t</title><!-- c --> <body>b", "b"),
    ("<head>\n<head><title>t</title></head>x", "x"),
])
def test_head_may_be_left_open(source, text):
    assert visible_text(source) == text


@pytest.mark.parametrize("row, text", [
    ("<form><td>A</td><td>B</td></form>", "A  B"), ("<a href=x><td>A</td></a>", "A"),
    ("<center>text</center>", "text"), ("text", "text"), ("<td>A</td>x<form>y<i><td>B</i></form>", "x\ny\nA  B"),
    ("<div><table><tr><td>in</table></div><td>A<td>B", "in\nA  B"), ("<b hidden><td>A</td></b><td>B", "B"),
    ("<div>" * 5000 + "<td>A", "A"), ("<p>one<p>two", "one\ntwo"),
])
def test_all_of_a_row_is_kept(row, text):
    assert visible_text(f"<table><tr>{row}</tr></table>") == text


@pytest.mark.parametrize("source, text", [
    ("so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>x=1</annotation></semantics></math>.",
     "so x=1."),
    ("<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>", "1 2"),
    ("<math><mtable><mtr><mtd>a</mtd><mtd>b</mtd></mtr></mtable></math>", "a b"),
    ("see <svg><title>t</title><defs><text>no</text></defs><desc>d</desc><path d='m'/><text>A</text><text>B"
     "</text></svg>end", "see A B end"),
    ("<svg><foreignObject><p>in</p></foreignObject></svg>", "in"), ("<svg hidden><text>A</text></svg>x", "x"),
    ("<desc>shown</desc><text>as</text>is", "shownasis"),
    ("<span class=katex><math><mi>y</mi></math><span aria-hidden=true>y</span></span>", "yy"),
])
def test_formulas_and_labels_are_shown(source, text):
    assert visible_text(source) == text


@pytest.mark.parametrize("source, text", [
    ("<table><tr><td rowspan=2>A<td>B<td>C<tr><td>D<td>E</table>", "A  B  C\n   D  E"),
    ("<table><tr><td>A<td rowspan=9 colspan=2>B<tr><td>C<td>D</table>", "A  B\nC     D"),
    ("<div style='visibility:hidden'>a<b style='visibility: visible !important'>b</b>c</div>", "b"),
    ("<table><tr><td style=visibility:collapse>a<td>b<tr><td>c<td>d</table>", "   b\nc  d"),
    ("<i style='display:none;display:inline'>a</i>", "a"), ("<i style='x-display:none'>a</i>", "a"),
    ("a<textarea>b &amp; <i></textarea>c", "a b & <i> c"), ("<select><option>a<option selected>b</select>c", "b c"),
    ("<select><optgroup label=x><option>a<option>b</optgroup></select>", "a"),
    ("<select multiple><option>a<option>b</select>", "a b"), ("<p class=it's>a</p>'b", "a\n\n'b"),
    ("<a title='x > y' href=\"z>\">t</a>", "t"), ("a<!-->b<!--->c", "abc"), ("<p>a <b", "a <b"),
    ("<a b=\"c>d<i>e", "de"), ("a <! b", "a <! b"), ("<a b=\"c> d=\"<i>e", "e"),
])
def test_grid_visibility_fields_and_quotes(source, text):
    assert visible_text(source) == text


def test_cells_by_a_matrix_of_covered_places():
    rng = random.Random(9)
    for _ in range(300):
        covered, begins, source, number = set(), {}, "<table>", 0
        height = rng.randint(1, 6)
        for y in range(height):
            source += "<tr>"
            for _ in range(rng.randint(1 if y else 2, 5)):
                wide, high, word = rng.choice([1, 1, 2, 3]), rng.choice([1, 1, 2, 3]), f"{'w' * rng.randint(1, 9)}{number}"
                number += 1
                x = next(x for x in range(100) if (y, x) not in covered)
                # a cell may run into columns that are taken from above, as in browsers
                covered |= {(y + j, x + i) for j in range(high) for i in range(wide)}
                begins[y, x] = word
                source += f"<td colspan={wide} rowspan={high}>{word}"
        columns = sorted({x for _, x in begins})
        at = {}
        for x in columns:
            at[x] = sum(2 + max(len(w) for (_, c), w in begins.items() if c == b) for b in columns if b < x)
        want = []
        for y in range(height):
            line = ""
            for x in columns:
                if (y, x) in begins:
                    line = line.ljust(at[x]) + begins[y, x]
            want.append(line)
        assert visible_text(source + "</table>") == "\n".join(want).strip("\n"), source


GROWING = {
    "open quotes": lambda n: "<a \"" * n, "open tags": lambda n: "<a b='c" * n, "declarations": lambda n: "<! " * n,
    "values over tags": lambda n: "<a b=\"> c=\"" * n, "late value": lambda n: "<a " * n + "b=\">\"",
    "long cell": lambda n: "<table><tr><td>" + "x" * 6 * n + "<td>y" + "<tr><td>a<td>b" * n,
    "many columns": lambda n: "<table><tr>" + "<td>a" * n + "<tr><td colspan=1000><td>b" * n,
    "many lines": lambda n: "<table><tr>" + "<td>a" * n + "<td>" + "b<br>" * n,
    "reaching down": lambda n: "<table><tr><td>a<td rowspan=65534 colspan=1000>b" + "<tr><td>c<td>d" * n,
    "tables": lambda n: "<table><tr><td>" * n + "x", "columns in columns": lambda n: "<table><tr><td>a<td>" * n + "<p>x" * n,
    "walled end tags": lambda n: "<b><table><tr><td>" + "<i>" * n + "</b>" * n,
    "walled paragraphs": lambda n: "<p><button>" + "<i>" * n + "<div></div>" * n,
    "rows that reach down": lambda n: "<table>" + "<tr><td rowspan=65534>a<td>b" * n,
}


@pytest.mark.parametrize("name", GROWING)
def test_time_and_text_grow_with_the_page(name):
    took, size = [], []
    for n in (1000, 4000):
        source = GROWING[name](n)
        started = time.process_time()
        text = visible_text(source)
        took.append(time.process_time() - started)
        size.append(len(text) / len(source))
    assert took[1] < 10 * max(took[0], 0.05) and size[1] < 1.2 * size[0] + 1


class Words(HTMLParser):
    """All text outside script, style, head title and comments, without layout."""

    def __init__(self):
        super().__init__()
        self.out, self.inside = [], None

    def handle_starttag(self, tag, attributes):
        if tag in ("script", "style", "title"):
            self.inside = tag
        self.out.append(" ")

    def handle_endtag(self, tag):
        if tag == self.inside:
            self.inside = None
        self.out.append(" ")

    def handle_data(self, data):
        if self.inside is None:
            self.out.append(data)


def test_no_visible_word_is_lost(spark, by_id):
    pages = tables.read(spark, "/root/testdata/sf0.01", "pages")
    found = by_id(html_text.extract(pages), "page_id")
    rows = pages.select("page_id", "html").collect()
    assert len(found) == len(rows)
    for row in rows:
        words = Words()
        words.feed(row["html"])
        words.close()
        plain = re.sub(r"\s+", "", "".join(words.out))
        text = found[row["page_id"]]["text"]
        assert re.sub(r"\s+", "", re.sub(r"(?m)^ *- ", "", text)) == plain
        assert found[row["page_id"]]["n_chars"] == len(text)


def test_deep_nesting_and_long_pages():
    assert visible_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert visible_text("<table><tr><td>" * 300 + "x") == "x"
    assert visible_text("<p>word " * 50_000).count("word") == 50_000
    assert visible_text("<ul><li>" * 200 + "x").endswith("- x")
    assert visible_text("</b>" * 100_000 + "y") == "y"


def test_special_cases(spark):
    pages = spark.createDataFrame([(None, None, "t", 1), (1, "<p>a", "t", 1), (1, "<p>a", "t", 1), (2, "", "t", 1)],
                                  "page_id long, html string, text string, n_chars long")
    rows = html_text.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_lines"]) for r in rows) == [
        (0, "", 0), (1, "a", 1), (1, "a", 1), (2, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0
