"""Rendering, case by case, and over the page table."""

import random

import pytest

from monthglass.llm.pages import extract_text, render


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        (None, ""),
        ("just  text\n here", "just text here"),
        ("<p>one<p>two</p>three", "one\n\ntwo\n\nthree"),
        ("<div>a</div><div>b <b>c</b>d</div>", "a\nb cd"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<h1>T</h1>x &amp; y &lt;z&gt; &copy", "T\n\nx & y <z> ©"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
        ("<ol start=3><li>x</li><li value=7>y<p>z</li><li>w</ol>", "3. x\n7. y\n\n   z\n\n8. w"),
        ("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "k\n  v\nl\n  w"),
        ("<table><tr><th>name<th>n</tr><tr><td>a<td>10<tr><td>longer<td>2</table>", "name    n\na       10\nlonger  2"),
        ("<table><td>a<td>b</table>", "a  b"),
        ("<table><caption>C</caption><tr><td rowspan=2>r<td>1<tr><td>2</table>", "C\nr  1\n   2"),
        ("<table><tr><td colspan=2>wide one<td>z<tr><td>a<td>b<td>c</table>", "wide one  z\na  b  c"),
        ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
        ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
        ("x<script>var a='<p>no</p>'</script>y<style>p{}</style><!-- c -->z", "xyz"),
        ("<p hidden>no</p><p style='display: none'>no<b>no</b></p>yes", "yes"),
        ("<div style='visibility:hidden'>no <span style='visibility:visible'>yes</span></div>", "yes"),
        ("<details><summary>s</summary>no<p>no</p></details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
        ("<pre>\n a\n   b</pre>c", " a\n   b\n\nc"),
        ("<head><title>t</title></head><body>b", "b"),
        ("<title>t</title><p>b", "b"),
        ("a < b and c<d", "a < b and c"),
        ("cut <a href='x", "cut"),
        ("</p>a</div></b>b", "ab"),
        ("<p>a&nbsp;b", "a b"),
        ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
        ("<select><option>a<option>b</select>", "a\nb"),
    ],
)
def test_cases(page, text):
    assert render(page)[1] == text


def test_wide_tables_and_deep_nesting_stay_small():
    wide = "<table>" + "<tr><td>" + "x" * 50_000 + "<td>y" + "<tr><td>a<td>b" * 2000 + "</table>"
    assert len(render(wide)[1]) < 70_000
    assert render("<div>" * 20_000 + "deep")[1] == "deep"
    assert render("<table><tr><td>" * 300 + "deep")[1] == "deep"


def test_random_markup_never_fails():
    r = random.Random(6)
    bits = ["<p>", "</p>", "<table>", "</table>", "<tr>", "<td>", "</td>", "<li>", "<ul>", "</ul>", "<caption>", "</caption>", "<", ">", "&", "text", " ", "<!--", "-->", "<script>", "</script>", "<b hidden>", "</b>", "<td rowspan=3 colspan=2>", "<br>", "<pre>", "</pre>", "\n", "<a href=\"", "'", "<details>", "<dd>", "</x>", "<title>"]
    for _ in range(3000):
        title, text = render("".join(r.choice(bits) for _ in range(r.randint(0, 40))))
        assert isinstance(text, str) and not text.startswith("\n")


def test_frame(spark):
    rows = [(1, "u", "<title>T</title><p>a<p>b", "old"), (1, "u", None, "old"), (None, None, "x", "old")]
    out = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert out.columns == ["page_id", "url", "title", "text", "n_lines"]
    assert sorted((str(r.page_id), r.title, r.text, r.n_lines) for r in out.collect()) == [("1", "", "", 0), ("1", "T", "a\n\nb", 3), ("None", "", "x", 1)]
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_page_table(spark):
    out = extract_text(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    assert out and all(r.text and "<" + "p>" not in r.text and "track(" not in r.text and "margin:0" not in r.text for r in out)
    assert all(r.text.startswith("- ") for r in out)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("E = <math><mi>mc</mi><mn>2</mn></math> and <svg><text>label</text></svg>", "E = mc2 and\nlabel"),
        ("<math><semantics><mi>x</mi><annotation>\\\\x</annotation><annotation-xml><mi>y</mi></annotation-xml></semantics></math>", "x"),
        ("<svg><title>tip</title><defs><text>no</text></defs><desc>no</desc><metadata>no</metadata><text>a</text><text>b</text></svg>c", "a\nb\nc"),
        ("<desc>shown</desc> <defs>too</defs>", "shown too"),
        ("<object data=x><p>instead</p></object>", "instead"),
        ("<canvas>no</canvas><video>no</video>yes", "yes"),
    ],
)
def test_formulas_and_drawings(page, text):
    assert render(page)[1] == text


def test_a_drawing_does_not_name_the_page():
    assert render("<svg><title>tip</title></svg><title>page</title>")[0] == "page"


@pytest.mark.parametrize("n", [49, 60, 120, 200])
@pytest.mark.parametrize("rows", [1, 20, 3000])
def test_long_cells_keep_their_columns(n, rows):
    long = " ".join(["word"] * (n // 5)).ljust(n, "x")
    page = f"<table><tr><td>{long}<td>first<td>x" + "<tr><td>a<td>b<td>c" * rows + "</table>"
    lines = render(page)[1].split("\n")
    assert lines[0] == f"{long}  first  x"
    assert set(lines[1:]) == {"a".ljust(n + 2) + "b".ljust(7) + "c"}
