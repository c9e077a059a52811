"""Toxicity, embeddings, URL filters and HTML rendering on small fixtures."""

import datetime as dt
import math
import random
import re
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest

from tidepool.llm import embeddings, html_render, toxicity, url_filters


# ---------------------------------------------------------------- toxicity

def brute_segments(s):
    """Maximal scoring segments by definition: recursively the best segment, then both sides."""
    def go(lo, hi):
        best = None
        for i in range(lo, hi):
            t = 0.0
            for j in range(i, hi):
                t += s[j]
                if t > 0 and (best is None or t > best[2] + 1e-12):
                    best = (i, j + 1, t)
        if best is None:
            return []
        return go(lo, best[0]) + [best] + go(best[1], hi)
    return go(0, len(s))


@pytest.mark.parametrize("seed", range(40))
def test_maximal_segments(seed):
    rng = random.Random(seed)
    s = [round(rng.uniform(-3, 2), 3) + rng.random() * 1e-6 for _ in range(rng.randrange(0, 30))]
    got = toxicity.maximal_segments(s)
    want = brute_segments(s)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([x for *_, x in got], [x for *_, x in want])


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ["ka", "lo", "mi", "ter", "son"] for b in ["ra", "ne", "ti", "po", "ul"]]
    bad = ["vileword", "nastyone", "grossly"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randrange(20, 120))
        toxic = i % 6 == 0
        if toxic:
            at = rng.randrange(len(words) - 3)
            words[at:at + 2] = [rng.choice(bad).title() + ",", rng.choice(bad)]
        rows.append((i, " ".join(words), "s", 0.5))
        if i % 4:
            labels.append((i, 1, int(toxic)))
    return rows, labels


SCHEMA = "doc_id bigint, text string, score string, predicted double"


def test_toxicity_held_out_accuracy_and_edges(spark):
    rows, labels = corpus()
    extra = [(None, "vileword nastyone", "", 0.0), (9001, None, "", 0.0), (9002, "", "", 0.0),
             (9003, " \n ", "", 0.0), (9004, "kara lora mira " * 20 + "vileword grossly vileword", "", 0.0),
             (9005, "kara " * 30000 + "vileword", "", 0.0), rows[0]]
    docs = spark.createDataFrame(rows + extra, SCHEMA)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, 0, None), labels[0]],
                                  "doc_id bigint, quality int, toxic int")
    model = toxicity.learn(docs, marks)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + len(extra)
    right = held = found = shown = 0
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 9000:
            truth = r.doc_id % 6 == 0
            if zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                held += 1
                right += truth == r.predicted
            if truth and r.passages:  # a word alone may be evidence enough without being significant
                found += any(w in p.text.lower() for p in r.passages for w in ("vile", "nasty", "gross"))
                shown += 1
            if r.passages:
                assert all(r.text[p.start:p.end] == p.text for p in r.passages)
    assert held > 80 and right >= 0.98 * held and shown and found == shown
    clean = {r.score for r in got if r.doc_id in (9001, 9002, 9003)}
    assert len(clean) == 1 and clean.pop() < 0.5
    assert next(r for r in got if r.doc_id == 9004).predicted == 1


@pytest.mark.parametrize("text,want", [
    ("well/toxicword you,toxicword <b>nice-toxicword</b>", "well toxicword you toxicword b nice toxicword b"),
    ("It's a_b  -- don’t!", "It's a b -- don’t"), ("x" * 70 + "y", "x" * 70 + "y"),
    ("毒词在这里 ok", "毒词 词在 在这 这里 ok"), ("字", "字"), ("ab字cd", "ab 字 cd"), ("कि से", "कि से"),
    ("you😀😀 😀", "you 😀😀 😀"), ("cafe\u0301s l’été", "cafe\u0301s l’été"), ("", ""), (" \n ", ""),
    ("a" * 50_000 + "," * 50_000 + "b", "a" * 50_000 + " b")])
def test_toxicity_reads_every_run(text, want):
    assert toxicity.words_of(text) == want.split()
    assert [text[a:b] for a, b in toxicity.spans_of(text)] == want.split()


def test_toxicity_counts_every_word_by_itself(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD_KEYS", 1 << 14)
    known = [f"w{i:x}q" for i in range(600_000)]  # more words than any table of fixed size had slots
    rows = [(" ".join(known[i::60]), int(i % 6 == 0)) for i in range(60)] * 3
    model = toxicity.count_model(spark.createDataFrame(rows, "text string, toxic int").repartition(4))
    words = np.array([toxicity.features(w)[-1] for w in known])
    assert len(np.unique(words)) == len(known)
    at = np.searchsorted(model.keys, words)
    assert (model.keys[at] == words).all() and (model.every[at] == 3).all()
    assert (model.toxic[at] == np.where(np.arange(len(known)) % 60 % 6 == 0, 3, 0)).all()
    assert math.isclose(model.share, 30.5 / 181)


def test_toxicity_in_joined_text(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(["kara", "lone", "miti", "terpo", "sonul"], k=40)
        glue = "/," if i % 2 else "的一是不了人我在有他"
        if i % 3 == 0:
            words[20:22] = ["vileword", "nastyone"] if i % 2 else ["毒词坏", "毒词坏"]
        rows.append((i, "".join(w + rng.choice(glue) for w in words)))
        labels.append((i, 1, int(i % 3 == 0)))
    rows += [(1001, "kara/lone,miti/vileword,nastyone/vileword,miti"), (1002, "的一是不了人毒词坏毒词坏我在有他")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1001].predicted == got[1002].predicted == 1
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0)


def test_toxicity_never_reads_held_out_labels(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    flip = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    scores = []
    for ls in (labels, flip):
        model = toxicity.learn(docs, spark.createDataFrame(ls, "doc_id bigint, quality int, toxic int"))
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.score(docs, model).collect()))
    assert scores[0] == scores[1]


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame(corpus(20)[0], SCHEMA)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = toxicity.learn(docs, none)
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}
    assert toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), none)).count() == 0


def test_scale_is_the_root():
    bins, counts = np.array([100, 260]), np.array([9, 1])
    k = toxicity.root_scale(bins, counts)
    s = toxicity.BIN_LOW + bins * toxicity.BIN
    assert math.isclose((counts / counts.sum() * np.exp(k * s)).sum(), 1, rel_tol=1e-6)


# ---------------------------------------------------------------- embeddings

def brute_links(x):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= 0.9
    np.fill_diagonal(hit, False)
    label = np.arange(len(x))
    changed = True
    while changed:
        new = np.array([min([label[i], *label[hit[i]]]) for i in range(len(x))])
        changed = (new != label).any()
        label = new
    return hit.sum(1), label


def clustered(n, dim=32, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for i in range(0, n // 3, 3):
        x[i + 1] = x[i] + 0.1 * rng.standard_normal(dim)
        x[i + 2] = x[i]
    x[-n // 5:] = x[-1] + 0.05 * rng.standard_normal((n // 5, dim))
    return x.astype(np.float32)


@pytest.mark.parametrize("n,leaf,block", [(300, 2048, 4096), (900, 60, 4096), (900, 100, 40)])
def test_near_vectors_match_brute_force(spark, monkeypatch, n, leaf, block):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block)
    x = clustered(n)
    df = spark.createDataFrame([(i, [float(v) for v in r], "c") for i, r in enumerate(x)],
                               "vec_id bigint, embedding array<float>, cid string")
    got = {r.vec_id: r for r in embeddings.near_vectors(df, leaf_rows=leaf).collect()}
    links, label = brute_links(x.astype(np.float64))
    found = sum(got[i].n_links for i in range(n))
    assert all(got[i].n_links <= links[i] for i in range(n))
    assert found >= 0.97 * links.sum()
    if leaf >= n:
        assert found == links.sum()
        assert all(got[i].component_id == label[i] for i in range(n))
    assert all(got[i].kept == (got[i].component_id == i) for i in range(n))


@pytest.mark.parametrize("leaf", [2048, 60])
def test_near_vectors_of_every_length(spark, leaf):
    sets = [clustered(n, dim, seed=dim) for n, dim in ((300, 32), (150, 24), (9, 16))]
    rows, want = [], {}
    for x in sets:
        links, label = brute_links(x.astype(np.float64))
        first = len(rows)
        want |= {first + i: (links[i], first + label[i]) for i in range(len(x))}
        rows += [(first + i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows.append((len(rows), [1.0]))
    want[len(rows) - 1] = (0, len(rows) - 1)
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    got = {r.vec_id: r for r in embeddings.near_vectors(df, leaf_rows=leaf).collect()}
    assert len(got) == len(rows)
    assert all(got[i].n_links <= want[i][0] for i in want)
    if leaf == 2048:
        assert all((got[i].n_links, got[i].component_id) == want[i] for i in want)
    for lo, hi in ((0, 300), (300, 450), (450, 459)):
        assert sum(got[i].n_links for i in range(lo, hi)) >= 0.97 * sum(want[i][0] for i in range(lo, hi)) > 0


def test_near_vectors_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0]), (9, []), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 0.01]),
            (11, [-1.0, 0.0]), (12, [1e-30, 0.0]), (13, [3e38, 1e30])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = embeddings.near_vectors(df).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    for i in (3, 4, 5, 6, 7, 8, 9, 11):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)
    for i in (1, 2, 10, 12, 13, None):
        assert (by[i].n_links, by[i].component_id) == (6, 1)
    assert sum(r.kept for r in got) == 9
    assert embeddings.near_vectors(df.limit(0)).count() == 0


# ---------------------------------------------------------------- URL filters

def test_url_filter_against_direct_evaluation(spark):
    rng = random.Random(2)
    hosts = ["a.com", "x.a.com", "b.org", "y.x.a.com", "xa.com"]
    day = lambda k: dt.date(2023, 1, 1) + dt.timedelta(days=k)
    entries = []
    for _ in range(60):
        kind = rng.choice(["host", "domain", "prefix"])
        pattern = rng.choice(hosts) + (rng.choice(["/", "/p/", "/p/q/"]) if kind == "prefix" else "")
        ls = rng.choice(["spam", "adult", "trusted"])
        entries.append((ls, "allow" if ls == "trusted" else "block", kind, pattern,
                        day(rng.randrange(300)), rng.choice(["add", "remove"])))
    entries += [(None, "block", "host", "a.com", day(0), "add"), ("spam", "block", "host", "b.org", None, "add"),
                ("spam", None, "host", "n.net", day(10), "add"), ("spam", "block", "host", "a.com", day(5), "huh")]
    urls = ["http://A.com/p/q/r?x=/z/", "https://x.a.com:8080/p/", "//b.org", "ftp://u:pw@y.x.a.com./p/q/r/s#f",
            "https://xa.com/pp/", None, "", "not a url", "http://", "http://n.net/"]
    caps = [(i, rng.choice(urls), day(rng.randrange(330)) if rng.random() > 0.05 else None, "x")
            for i in range(300)] + [(None, urls[0], day(3), "y")] * 2
    cdf = spark.createDataFrame(caps, "page_id bigint, url string, fetched_on date, kind string")
    edf = spark.createDataFrame(entries, "list string, mode string, kind string, pattern string, "
                                         "day date, action string")
    got = url_filters.filter_urls(cdf, edf, carry=["page_id", "kind"]).collect()
    assert len(got) == len(caps)
    state = {}
    for ls, mode, kind, pat, d, act in entries:
        if ls and d and act in ("add", "remove"):
            key = (ls, mode or "block", kind, pat)
            state.setdefault(key, {})
            state[key][d] = max(act, state[key].get(d, ""))

    def judge(url, f):
        m = re.match(url_filters.URL_PATTERN, url or "")
        host, path = (re.sub(r"\.$", "", m[1].lower()), m[2]) if m else ("", "")
        hits = []
        for (ls, mode, kind, pat), days in state.items():
            ok = host and ((kind == "host" and pat == host)
                           or (kind == "domain" and (pat == host or host.endswith("." + pat)))
                           or (kind == "prefix" and (host + path).startswith(pat)))
            past = [d for d in days if f and d <= f]
            if ok and past and days[max(past)] == "add":
                hits.append((ls, mode))
        modes = {m for _, m in hits}
        return "block" in modes and "allow" not in modes, len(hits), ",".join(sorted({x for x, _ in hits}))

    for r in got:
        assert (r.blocked, r.n_matches, r.lists) == judge(r.url, r.fetched_on)
        assert r.row.kind in "xy"
    assert any(r.blocked for r in got)
    assert not any(r.blocked for r in url_filters.filter_urls(cdf, edf.limit(0)).collect())
    assert url_filters.filter_urls(cdf.limit(0), edf).count() == 0


# ---------------------------------------------------------------- HTML

LAYOUT = [
    ("<p>One<p>Two <b>bold</b>  text", "One\n\nTwo bold text"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "* a\n* b\n  * c\n* d"),
    ("<ol start=9><li>nine<li>ten</ol>", "9. nine\n10. ten"),
    ("<table><tr><td>a<td>long cell<tr><td>bbb<td>c</table>", "a    long cell\nbbb  c"),
    ("<table><thead><tr><th>H<tbody><tr><td>x<br>y</table>after", "H\nx\ny\n\nafter"),
    ("<pre>\n a\n   b</pre>", " a\n   b"),
    ("<head><title>t</title></head><body>v<script>if(a<b){'</p>'}</script>w</body>", "vw"),
    ("a<span hidden>b</span><i style='DISPLAY : none'>c</i>d", "ad"),
    ("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b></div>", "b"),
    ("<details><summary>s</summary>t</details><details open><summary>s</summary>t</details>", "s\ns\nt"),
    ("&lt;a&gt; &amp; &eacute;&nbsp;&#x41;", "<a> & é\xa0A"),
    ("<!-- c --><!DOCTYPE html><p>x<!-- unfinished", "x"),
    ("</div></p>stray<blockquote>q</blockquote>", "stray\n\n  q"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<a href='x>y'>z</a> 1 < 2 <3", "z 1 < 2 <3"),
    ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", "a        b\n\nin  ner"),
    ("<script>never closed", ""),
    ("", ""), (None, None),
]


@pytest.mark.parametrize("html,text", LAYOUT)
def test_layout(html, text):
    assert html_render.render(html) == text


@pytest.mark.parametrize("html,text", [
    ("<!DOCTYPE html><head><title>t</title><p>Hello", "Hello"),
    ("<html><head><meta charset=x>\n<title>t</title>\nbare text <b>on</b>", "bare text on"),
    ("<head><style>a{}</style><noscript><link></noscript><script>x</script><div>a</div></head>b", "a\nb"),
    ("<head><template><p>no</p></template><title>t</title>\n</head>\n<p>yes", "yes")])
def test_head_ends_where_content_begins(html, text):
    assert html_render.render(html) == text


@pytest.mark.parametrize("html,text", [
    ("<p title=O'Brien>Hello world, this is text.</p><p>More text</p>", "Hello world, this is text.\n\nMore text"),
    ("<a href=x'>one</a> it's <img alt=it's> two", "one it's two"),
    ("<p 'stray\">a</p \"><p \"hidden'>b", "a\n\nb"),
    ("<p title=a=\"x>b</p>", "b"), ("<p title = 'x>y' hidden>b</p>c", "c"), ("<p title= >b</p>", "b"),
    ("<p title=\"a'b>c\" lang='\"'>d", "d"), ("<a title=\"never closed>x", "")])
def test_quotes_open_values_only_after_equals(html, text):
    assert html_render.render(html) == text


def test_quotes_and_equals_in_tags_are_linear():
    for part in ("a=", "'", "= ", "a = '", "a=\"\"", "/ "):
        html_render.render("<p " + part * 100_000)
        assert html_render.render("<p " + part * 100_000 + "\"'>x") is not None


@pytest.mark.parametrize("html,text", [
    ("a <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2 tex</annotation>"
     "<annotation-xml><ci>q</ci></annotation-xml></semantics></math> b", "a x=2 b"),
    ("<p>see<svg viewBox='0'><title/><style/>stray<defs><text>d</text></defs><g><path d='m'/>"
     "<text x=1>One <tspan>label</tspan></text><text>Two</text></g></svg>after", "see\nOne label\nTwo\nafter"),
    ("<svg><foreignObject><p>in <b>html</b></p></foreignObject><desc>no</desc></svg>", "in html"),
    ("<svg><g>no<p>out of it<svg><text>t</text>", "out of it\nt"),
    ("<textarea>\nline &amp; one\n  two</textarea>x", "line & one\n  two\nx"),
    ("<textarea><p>raw</textarea><defs>d</defs><text>e</text>", "<p>raw\nde"),
    ("<math><mi>x<div>y</div>z", "x\ny\nz")])
def test_formulas_drawings_and_text_areas_show(html, text):
    assert html_render.render(html) == text


class Visible(HTMLParser):
    """Visible words in order, for markup without layout subtleties."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.skip:
            self.words.append(data)


def test_words_of_real_pages_match_a_plain_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_render.render_pages(pages.withColumn("text", pages.url)).collect():
        assert r.text is not None
    for r in pages.collect():
        v = Visible()
        v.feed(r.html)
        want = "".join(" ".join(v.words).split())
        got = re.sub(r"(?m)^ *\* ", "", html_render.render(r.html))
        assert "".join(got.split()) == want


def test_hostile_markup_is_linear_and_safe(spark):
    assert html_render.render("<div>" * 50_000 + "x") == "x"
    assert html_render.render("<b>" * 20_000 + "x" + "</b>" * 20_000) == "x"
    assert html_render.render("<p " + "a=\"" * 5_000) is not None
    assert html_render.render("<" * 50_000) == "<" * 50_000
    big = "<table>" + "<tr><td>" + "w" * 20_000 + "<td>b" * 3 + "</table>"
    assert len(html_render.render(big)) < 25_000
    df = spark.createDataFrame([(1, None, "a"), (1, "<p>x", "b"), (1, "<p>x", "b")],
                               "page_id int, html string, _row string")
    got = html_render.render_pages(df).collect()
    assert sorted(map(str, got)) == sorted(["Row(page_id=1, _row='a', text=None)"]
                                           + ["Row(page_id=1, _row='b', text='x')"] * 2)
    assert html_render.render_pages(df.limit(0)).count() == 0
