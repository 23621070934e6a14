"""Rendering of pages; BM25 search against full scoring."""

import random
import time
from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from tramlag.llm import bm25_wand, html_layout, registry

PAGES = [
    ("<p>a<p>b<br>c<ul><li>x<li>y<ol><li>q</ol></ul>z", "a\n\nb\nc\n\n- x\n- y\n  1. q\n\nz"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>1<tr><td>kiwi fruit<td>20</table>after", "Name        Qty\napple       1\nkiwi fruit  20\n\nafter"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
    ("<div hidden>no</div><span style='color:red; display : none'>no</span>yes<script>var a='<p>'</script>!", "yes!"),
    ("<head><title>t</title><style>p{}</style></head><p style='visibility:hidden'>x</p>shown", "shown"),
    ("<pre>\n a\n   b\n</pre>x", " a\n   b\n\nx"),
    ("<b>bo<i>ld</b>x</i> <q>hi</q>", 'boldx "hi"'),
    ("one\n  two&nbsp;three &lt;b&gt; &copy;", "one two three <b> ©"),
    ("<ol start=3><li>a<li value=9>b<li>c</ol>", "3. a\n9. b\n10. c"),
    ("<blockquote>said<p>so</blockquote>end", "  said\n\n  so\n\nend"),
    ("a<!-- <p>no</p> -->b<img alt=' pic '>c", "ab pic c"),
    ("<td>stray</td></div></p>a < b <", "stray\n\na < b <"),
    ("x <a href='never ends", "x"),
    ("<select><option>no</select><noscript>no</noscript>", ""),
    ("", ""),
    ("<table><tr><td colspan='\u00b2'>a<td rowspan=x>b<td colspan=0>c<td colspan=-3>d</table>", "a  b  c  d"),
    ("<table><tr><td rowspan=0>A<td>B<tr><td>C<tr><td>D</table>", "A  B\n   C\n   D"),
    ("<textarea>in &lt;here</textarea> <dialog open>asks</dialog><dialog>not yet</dialog>", "in <here\n\nasks".replace("\n\n", " ")),
    ("<div style='visibility:hidden'>no<p style='visibility: visible'>yes <b style='visibility:hidden'>no</b>and</p><i hidden><b style='visibility:visible'>no</b></i></div>.", "yes and\n\n."),
    ("<a title='x>y' b=\"1>2\">in</a><b 'never>shown</b>", "in<b 'never>shown"),
    ("<!-- a --!>x<!-- b -->y<!doctype html>z<?xml?>!<!-- open", "xyz!"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_rendering(page, text):
    assert html_layout.text_of(page) == text


def test_deep_and_broken_pages_render():
    for open_, close in (("<div>", "</div>"), ("<ul><li>", "</ul>"), ("<table><tr><td>", "</table>"), ("<blockquote>", "")):
        assert "core" in html_layout.text_of(open_ * 3000 + "core" + close * 3000)
    random.seed(4)
    parts = ["<p>", "</p>", "<table>", "<tr>", "<td colspan=3>", "</table>", "<li>", "<ul>", "</ul>", "<", ">", "&amp", "x ", "<pre>", "<br/>", "<!--", "-->", "<script>"]
    for _ in range(400):
        html_layout.text_of("".join(random.choices(parts, k=30)))


@pytest.mark.parametrize(
    "unit",
    ["<a ", "<b \" ", "<a 'x ", "<a<", "<!-- -->", "<b '' ", "<", "</a ", "</", "<td colspan=1000>", "<p a=\"' ", "<i>", "&amp", "<!", "<a =", "<li>"],
)
@pytest.mark.parametrize("tail", ["", "'>", "\">end", "-->"])
def test_hostile_pages_take_linear_time(unit, tail):
    sizes = []
    for size in (60_000, 240_000):
        page = unit * (size // len(unit)) + tail
        begin = time.process_time()
        text = html_layout.text_of(page)
        sizes.append(time.process_time() - begin)
        assert len(text) <= 3 * len(page) + 1000
    assert sizes[1] < 0.5 or sizes[1] < 12 * sizes[0]


def test_tables_do_not_blow_up():
    long, wide = "x " * 20_000, "".join(f"<td>{'y' * 100}" for _ in range(400))
    for page in (
        f"<table><tr><td>{long}<td>z" + "<tr><td>a<td>b" * 4_000,
        f"<table><tr>{wide}" + "<tr><td colspan=390><td>b" * 4_000,
        "<table><tr><td rowspan=65534>" + "y" * 100 + "<td>a" + "<tr><td>b" * 9_000,
    ):
        text = html_layout.text_of(page)
        assert len(text) < 40 * len(page) and "b" in text
    assert html_layout.text_of(f"<table><tr><td>{'q' * 121}<td>z<tr><td>a<td>b</table>") == "q" * 121 + "  z\na  b"


def test_deep_elements_are_laid_out_and_hidden_as_others():
    rest = "<script>var a</script><style>p{}</style><template>t</template><i style='display:none'>no</i><b hidden>no<i>no</i></b>yes<ul><li>x<li>y</ul><pre>a  b</pre>"
    for tag in ("font", "span", "div"):
        for depth in (1, 160, 600, 20_000):
            assert html_layout.text_of(f"<{tag}>" * depth + rest) == "yes\n\n- x\n- y\n\na  b", (tag, depth)


def test_pages_keep_their_rows_and_columns(spark):
    rows = [(1, "u", p, "_") for p, _ in PAGES] + [(1, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = html_layout.extract(pages)
    assert got.columns == ["page_id", "url", "html", "text", "_text"]
    assert Counter(r._text for r in got.collect()) == Counter([t for _, t in PAGES] + [None])
    assert html_layout.extract(pages.limit(0)).count() == 0
    clash = pages.withColumn("_text", F.lit(7)).withColumn("_TEXT_", F.lit(8))
    assert html_layout.extract(clash).columns == [*clash.columns, "_text__"]


def slow_search(rows, queries, k):
    bags = [Counter(bm25_wand.terms_of(t)) for _, t in rows]
    lengths = [sum(b.values()) for b in bags]
    average = max(1e-9, sum(lengths) / max(1, len(rows)))
    out = []
    for query, text in queries:
        if query is None:
            continue
        asked = Counter(bm25_wand.terms_of(text))
        df = {t: sum(t in b for b in bags) for t in asked}
        scored = []
        for (name, _), bag, length in zip(rows, bags, lengths):
            hits = [t for t in asked if t in bag]
            norm = 1.2 * (0.25 + 0.75 * length / average)
            if hits:
                score = sum(asked[t] * log(1 + (len(rows) - df[t] + 0.5) / (df[t] + 0.5)) * bag[t] * 2.2 / (bag[t] + norm) for t in hits)
                scored.append((round(score, 9), name))
        scored.sort(key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
        out += [(query, i + 1, name, round(score, 6)) for i, (score, name) in enumerate(scored[:k])]
    return sorted(out)


def found(df):
    return sorted((r.item_id, r.rank, r.doc_id, round(r.score, 6)) for r in df.collect())


def test_search_equals_full_scoring(spark, monkeypatch):
    monkeypatch.setattr(bm25_wand, "SHARD_BYTES", 1500)
    monkeypatch.setattr(bm25_wand, "BLOCK", 4)
    monkeypatch.setattr(bm25_wand, "QUERIES", 5)
    random.seed(9)
    words = [f"t{int(random.paretovariate(0.6)) % 80}" for _ in range(20_000)]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 40)))) for i in range(300)]
    queries = [(i, " ".join(random.choices(words, k=random.randint(0, 6)))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame(queries, "item_id bigint, text string")
    for k in (1, 7):
        assert found(bm25_wand.search(docs, asked, k)) == slow_search(rows, queries, k)


def test_search_of_odd_rows(spark, odd, none):
    queries = [(1, "One THREE w5"), (2, None), (3, ""), (None, "one"), (4, "tail nothing"), (5, "one one text id")]
    asked = spark.createDataFrame(queries, "item_id bigint, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(bm25_wand.search(odd, asked, 20)) == slow_search(rows, queries, 20)
    assert bm25_wand.search(none, asked).count() == 0
    assert bm25_wand.search(odd, asked.limit(0)).count() == 0


def test_registered_queries():
    assert set(registry.ORACLE) <= set(registry.queries())
    assert [n.split("_")[0] for n in registry.queries()] == [f"op{i}" for i in range(1, 14)]
