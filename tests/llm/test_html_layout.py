"""Spans, options, buttons, and pages made to be expensive."""

import time

import pytest

from tidepool.llm import html_render


@pytest.mark.parametrize("html,text", [
    ("<table><tr><th colspan=2>Head<th>C<tr><td>a<td>b<td>c</table>", "Head  C\na  b  c"),
    ("<table><tr><td colspan=2>x<td>C<tr><td>aaaa<td>bbbb<td>c</table>", "x           C\naaaa  bbbb  c"),
    ("<table><tr><td rowspan=2>one<td>two<tr><td>three<tr><td>a<td>b</table>", "one  two\n     three\na    b"),
    ("<table><tr><td rowspan=99>r<td>s</table><table><tr><td>t</table>", "r  s\n\nt"),
    ("<table><tr><td colspan=x>a<td colspan=0>b</table>", "a  b"),
    ("<select><option>A<option>B</select>c", "A\nB\nc"),
    ("go <input type=submit value='Send it'> or <input type=hidden value=h><input value=typed><input type=checkbox value=v>",
     "go Send it or typed"),
    ("<ul hidden><li>a</ul><input type=button value=x hidden>b", "b"),
])
def test_spans_options_and_buttons(html, text):
    assert html_render.render(html) == text


@pytest.mark.parametrize("shape", [
    lambda n: "<b><table><tr><td>" + "<span>" * n + "</b>" * n,
    lambda n: "<table><tr><td>" + "<span>" * n + "</p><p>" * n,
    lambda n: "<ul><li>word" * n,
    lambda n: "<blockquote>word" * n,
    lambda n: "<table><tr><td>word" * n,
    lambda n: "<table><tr>" + "<td rowspan=9999>w" * n + "<tr><td>word" * n,
    lambda n: "<table><tr>" + "<td>w" * n + "<tr><td colspan=1000><td>word" * n,
    lambda n: "<svg><g>" + "<a>" * n + "</g></svg>" * n,
])
def test_time_and_output_grow_with_the_page(shape):
    """Four times the elements: about four times the time (some slack for the machine), output in
    proportion to the page, every word there."""
    took, out = [], ""
    for n in (2000, 8000):
        page = shape(n)
        best = 1e9
        for _ in range(2):
            start = time.process_time()
            out = html_render.render(page)
            best = min(best, time.process_time() - start)
        took.append(best)
        assert len(out) <= 20 * len(page)
        assert out.count("word") == page.count("word")
    assert took[1] <= 8 * took[0] + .2


def test_deep_tables_keep_their_words():
    n = 3 * html_render.MAX_TABLES
    out = html_render.render("".join(f"<table><tr><td>a{i}<td>b{i}" for i in range(n)))
    assert all(f"a{i}" in out and f"b{i}" in out for i in range(n))


def test_columns_of_clashing_names(spark):
    df = spark.createDataFrame([(1, "<p>x", "old", "k")], "page_id bigint, HTML string, Text string, Kept string")
    rows = html_render.render_pages(df, html="HTML")
    assert rows.columns == ["page_id", "Kept", "text"] and rows.first().text == "x"
