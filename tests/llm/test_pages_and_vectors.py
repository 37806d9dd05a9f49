"""Web pages, archive records and vector search."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from slotledger.llm import catalog, html_text, top_k, warc
from slotledger.llm.html_text import render
from tests.conftest import SF_TINY

PAGES = [
    (1, "http://a.example/x", "<html><head><title>T</title></head><body><p>One &amp; two<p>Three</body></html>"),
    (2, None, None),
    (3, "http://a.example/y", ""),
    (3, "http://a.example/y", ""),
    (None, "http://b.example/", "no tags at all < 3 &am &copy;"),
    (4, "http://c.example/", "<div>" * 20_000 + "deep"),
    (5, "http://d.example/", "<!-- never closed <p>hidden"),
]


@pytest.fixture(scope="module")
def pages(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return frame.selectExpr("*", "'x' AS block", "'x' AS record", "'x' AS text", "'x' AS type").repartition(2)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a<p>b", "a\n\nb"),
        ("<p>a  \n b<br>c</p> d", "a b\nc\n\nd"),
        ("a<div>b</div>c", "a\nb\nc"),
        ("<b>a</b><i>b</i> <u>c</u>", "ab c"),
        ("<b>a </b>b", "a b"),
        ("<ul><li>x<li>y<ol start=4><li>p<li>q</ol></ul>z", "- x\n- y\n  4. p\n  5. q\n\nz"),
        ("<ul><li><p>one</p><p>two</p></ul>", "- one\n\n  two"),
        ("<table><tr><th>Name<th>n<tr><td>apple<td>10<tr><td>fig<td>2</table>", "Name   n\napple  10\nfig    2"),
        ("<table><tr><td colspan=2>wide cell<td>c<tr><td>a<td>b<td>d</table>", "wide cell  c\na  b  d"),
        ("<table><caption>Cap</caption><tr><td>a<br>b<td>c</table>", "Cap\na  c\nb"),
        ("<td>cell outside of a table", "cell outside of a table"),
        ("<pre>  x\n    y</pre>z", "  x\n    y\n\nz"),
        ("<p hidden>a</p><p style='color:red; DISPLAY : none'>b</p><p data-x='hidden'>c</p>", "c"),
        ("<p style='visibility:hidden'>a<b>b</b></p>c", "c"),
        ("<script>if (a<b) '</p>'</script>x<style>p{}</style>", "x"),
        ("<script>never closed <p>x", ""),
        ("<title>t</title>x", "x"),
        ("<head><meta charset=x>text moves to the body<p>y", "text moves to the body\n\ny"),
        ("&lt;p&gt; &eacute; &#233; &nbsp;x&am", "<p> é é  x&am"),
        ("a < b <c", "a < b"),
        ("</p>x</b></div>", "x"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
        ("<a title='x>y'>z</a>", "z"),
        ("<!-- a --><!doctype html><?php ?>b<!-- c", "b"),
        ("<p>a<table><tr><td><p>b</table>c", "a\n\nb\n\nc"),
        ("<textarea>a <b></textarea>c", "a <b>c"),
        ("", ""),
        ("   \n ", ""),
    ],
)
def test_rendering(page, text):
    assert render(page) == text


def test_tree_is_always_nested():
    rng = random.Random(1)
    tags = "p div b ul li table tr td th span h1 br hr a pre dl dt dd script option select caption".split()
    for _ in range(300):
        page = "".join(
            rng.choice(["<{}>", "</{}>", "<{} hidden>", "x<{}", "{} "]).format(rng.choice(tags)) for _ in range(rng.randint(0, 40))
        )
        stack = []
        for kind, name, _ in html_text.events(page):
            if kind == "open":
                stack.append(name)
            elif kind == "close":
                assert stack.pop() == name, page
        assert not stack
        render(page)


def test_all_visible_words_of_plain_pages_remain():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(50)]
    for _ in range(100):
        page, expected = "", []
        for _ in range(rng.randint(1, 30)):
            own = [rng.choice(words) for _ in range(rng.randint(1, 4))]
            tag = rng.choice("p div li td h2 span section b".split())
            page += f"<{tag}>{' '.join(own)}</{tag}> "
            expected += own
        assert sorted(re.findall(r"w\d+", render(page))) == sorted(expected)


def test_page_text_contract(spark, pages):
    found = html_text.page_text(pages)
    assert found.columns == ["page_id", "text"]
    rows = sorted(((r["page_id"], r["text"]) for r in found.collect()), key=str)
    expected = [(1, "One & two\n\nThree"), (2, ""), (3, ""), (3, ""), (None, "no tags at all < 3 &am ©"), (4, "deep"), (5, "")]
    assert rows == sorted(expected, key=str)
    assert html_text.page_text(pages.filter("false")).count() == 0


def test_derivatives_of_awkward_pages(pages):
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 2 * len(PAGES)
    by = {(r["page_id"], r["type"]): r for r in rows}
    meta, text = by[1, "metadata"], by[1, "conversion"]
    assert meta["refers_to"] == text["refers_to"] != meta["record_id"] != text["record_id"]
    assert text["record"].endswith("\r\n\r\nOne & two\nThree\r\n\r\n")
    assert "http-status-line: HTTP/1.1 200 OK\r\nhttp-header-Content-Type: text/html; charset=utf-8\r\n" in meta["record"]
    assert f"WARC-Source-Payload-Digest: {meta['payload_digest']}\r\n" in text["record"]
    assert by[2, "conversion"]["content_length"] == 0 and by[2, "conversion"]["target_uri"] == ""
    assert by[5, "conversion"]["content_length"] == 0
    assert by[4, "conversion"]["record"].endswith("deep\r\n\r\n")
    for r in rows:
        head, _, rest = r["record"].partition("\r\n\r\n")
        assert head.startswith("WARC/1.1\r\n") and len(rest.encode()) == r["content_length"] + 4
        assert f"WARC-Refers-To: {r['refers_to']}" in head
    assert warc.derivatives(warc.responses(pages.filter("false"))).count() == 0


def test_derivatives_of_other_responses(spark):
    blocks = [
        ("<urn:uuid:1>", "HTTP/1.1 404 Not Found\r\nX-A: 1\r\nServer: s\r\n\r\n<p>gone</p>"),
        ("<urn:uuid:2>", "HTTP/1.1 204 No Content\r\nX-B: 2"),
        ("<urn:uuid:3>", None),
    ]
    rows = [(i, rid, "http://x", "2020-01-01T00:00:00Z", b and bytearray(b.encode()), "sha256:0") for i, (rid, b) in enumerate(blocks)]
    source = spark.createDataFrame(rows, "page_id long, record_id string, target_uri string, date string, block binary, payload_digest string")
    found = {(r["page_id"], r["type"]): r["record"].partition("\r\n\r\n")[2] for r in warc.derivatives(source).collect()}
    assert found[0, "metadata"] == "http-status-line: HTTP/1.1 404 Not Found\r\nhttp-header-X-A: 1\r\nhttp-header-Server: s\r\n\r\n\r\n"
    assert found[0, "conversion"] == "gone\r\n\r\n"
    assert found[1, "metadata"] == "http-status-line: HTTP/1.1 204 No Content\r\nhttp-header-X-B: 2\r\n\r\n\r\n"
    assert found[1, "conversion"] == found[2, "conversion"] == "\r\n\r\n"


def test_derivatives_search_a_text_no_more_often_than_needed(pages):
    plan = warc.derivatives(warc.responses(pages))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RLIKE") == 1  # two before: in the input of Python and beside its result
    assert plan.count("regexp_replace") == 5 and "|<title" not in plan


def test_shorter_patterns_mean_what_the_stated_ones_mean(spark):
    rng = random.Random(7)
    parts = ["<", "<!--", "-->", "<title", "</title >", "<SCRIPT", "</script>", "<style>", "</Style\n>", "<template ", "</template>", "<noscript>"]
    parts += ["</noscript>", "<titles>", ">", " ", "\n", "\n \n", "\t", "\x0b", "a", "é", "&amp;", "|", "\u00a0"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randint(0, 12))),) for _ in range(3000)]
    texts = spark.createDataFrame(rows, "text string")
    hidden, seen = (F.regexp_replace("text", pattern, " ") for pattern in (warc.HIDDEN, warc.UNSEEN))
    stated = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", warc.SPACES, " "), warc.LINES, "\n"), warc.ENDS, "")
    assert texts.filter((hidden != seen) | (warc.plain_text(F.col("text")) != stated)).count() == 0
    assert texts.filter(hidden != F.col("text")).count() > 1000


def brute(rows, k, every):
    """Every row but those of the query's id, whatever else it shares with others."""
    vectors = [
        (key, [math.floor(64 * v) for v in x])
        for key, x in rows
        if key is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)
    ]
    out = []
    for q in {key for key, _ in vectors if key % every == 0}:
        asked = {tuple(x) for key, x in vectors if key == q}
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), c) for x in asked for c, y in vectors if c != q)
        out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("block_rows", "query_rows"), [(4096, 2048), (16, 3)])
def test_top_k_equals_brute_force(spark, block_rows, query_rows):
    rng = random.Random(3)
    rows = [(i, [round(rng.gauss(0, 0.3), 1) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 420)]  # a very common vector: ties
    rows += [(420, None), (421, [0.1, None, 0.2, 0.1, 0.1, 0.1]), (422, [float("nan")] * 6), (423, [float("inf")] + [0.0] * 5)]
    rows += [(None, [0.1] * 6), (5, [9.0] * 6), (-20, [1.0] * 6), (426, [1e6] * 6), (440, [-3e5] * 6)]
    rows += [(40, [0.7, -0.2, 0.1, 0.9, 0.3, -0.5]), (60, [2.0] * 6), (60, [2.0] * 6), (301, [0.5] * 6), (5, [9.0] * 6)]  # repeated ids
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS cell", "2 AS score", "'x' AS far")
    rounded = [(key, x and [None if v is None else float(np.float32(v)) for v in x]) for key, x in rows]
    found = top_k.top_k(frame, 20, 64, 20, block_rows, query_rows)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rounded, 20, 20)


def test_top_k_of_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], schema)
    assert [tuple(r) for r in top_k.top_k(few).orderBy("rank").collect()] == [(0, 1, 1, 2048), (0, 2, 2, 2048)]
    assert top_k.top_k(few.filter("false")).count() == 0
    assert top_k.top_k(spark.createDataFrame([(0, None)], schema)).count() == 0
    assert top_k.top_k(few.filter("vec_id = 0")).count() == 0


def test_rows_that_share_an_id_are_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0])]
    found = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 12288), (0, 2, 1, 12288), (0, 3, 1, 8192)]


@pytest.mark.parametrize(("vector", "message"), [([1.0], "one length"), ([], "one length"), ([1e30, 1.0], "62 bits")])
def test_vectors_without_an_inner_product_are_refused(spark, vector, message):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, vector)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match=message):
        top_k.top_k(frame).collect()


def test_numbers_are_kept_as_small_as_is_exact():
    assert [top_k.smallest_kind(t) for t in (0, 127, 128, 40_000, 1 << 31)] == [np.int8, np.int8, np.int16, np.int32, np.int64]
    assert [top_k.exact_floats(t, 64) for t in (127, 511, 512, 1 << 23, 1 << 24)] == [np.float32, np.float32, np.float64, np.float64, None]


def test_highest_bounds_come_first():
    bounds = np.array([3.0, 9.0, 9.0, 1.0, 7.0, 2.0])
    first, rest = top_k.highest(np.array([0, 1, 2, 4, 5]), bounds, 3)
    assert sorted(first.tolist()) == [1, 2, 4] and sorted(rest.tolist()) == [0, 5]
    assert [len(r) for r in top_k.highest(np.arange(6), bounds, 6)] == [6, 0]


@pytest.mark.parametrize("scale", [1, 1000, 1 << 20])
def test_top_k_of_numbers_of_any_size(spark, scale):
    rng = random.Random(scale)
    rows = [(i, [float(rng.randint(-9, 9) * scale) for _ in range(5)]) for i in range(200)]
    found = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 20, 64, 20, 32, 4)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 20, 20)


def test_scores_beyond_doubles_stay_exact():
    rows = np.array([[1 << 40, 3], [-(1 << 40), 5]])
    query = np.array([(1 << 40) + 1, 7])
    assert top_k._exact_scores(rows, query).tolist() == [(1 << 63) - 1, -(1 << 63)]
    assert top_k._exact_scores(rows >> 12, query >> 8).tolist() == [(1 << 28) * ((1 << 32)), -(1 << 28) * (1 << 32)]


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_TINY}/{table}.parquet'")
    cursor = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    result = catalog.QUERIES[name](spark, SF_TINY)
    assert sorted(result.columns) == sorted(names)
    assert sorted(map(tuple, result.select(*names).collect()), key=str) == sorted(cursor.fetchall(), key=str)


def test_conversion_decodes_all_character_references(spark):
    shown = {
        "a&mdash;b &eacute;&hellip; &euro;5 &rsquo;": "a—b é… €5 ’",
        "&#8212;&#x2014;&#X41; &#128512;": "——A 😀",
        "&amp;mdash; &amp;amp; &amp;#65; &lt;b&gt; &mdash;": "&mdash; &amp; &#65; <b> —",
        "x&#160;y&nbsp;z &hearts;": "x y z ♥",
        "AT&T &unknown; & &; &#; &copy 2020": "AT&T &unknown; & &; &#; © 2020",
        "&copy; &middot; &quot;&#39;&apos;&amp;": "© · \"''&",
    }
    pages = spark.createDataFrame([(i, "u", f"<p>{t}</p>") for i, t in enumerate(shown)], "page_id long, url string, html string")
    rows = warc.derivatives(warc.responses(pages)).filter("type = 'conversion'").orderBy("page_id").collect()
    assert [r["record"].partition("\r\n\r\n")[2][:-4] for r in rows] == list(shown.values())
    for r, text in zip(rows, shown.values(), strict=True):
        assert r["content_length"] == len(text.encode()) and r["block_digest"] == "sha256:" + hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>Area <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>tex</annotation></math> end", "Area x=1 2 end"),
        ("<p>a<svg viewBox='0 0'><title>icon</title><path d='M0'/></svg>b", "ab"),
        ("<svg><defs><text>no</text></defs><title/><text x=1>North</text><text>South <tspan>pole</tspan></text></svg>", "North\nSouth pole"),
        ("<svg><text display='none'>z</text><style>s > t</style><desc>d</desc><text><![CDATA[a<b]]></text></svg>", "a<b"),
        ("<svg><text>open <p>para <b>bold</b></p>", "open\n\npara bold"),
        ("<svg><foreignObject><p>one</foreignObject><text>two</text></svg>three", "one\n\ntwo\nthree"),
        ("<div>a</div><svg><a><text>link</text></a></svg><li>x", "a\nlink\n- x"),
        ("<table><tr><th rowspan=2>Region<th>Q1<th>Q2<tr><td>10<td>20<tr><td>North long<td>3<td>4</table>",
         "Region      Q1  Q2\n            10  20\nNorth long  3   4"),
        ("<table><tbody><tr><td rowspan=0>A<td>b<tr><td>c</tbody><tbody><tr><td>d<td>e</table>", "A  b\n   c\nd  e"),
        ("<table><tr><td rowspan=3>A<td>b</tbody><tbody><tr><td>c<td>d</table>", "A  b\nc  d"),
        ("<table><tr><td>a<td rowspan=2>b<td>c<tr><td>d<td>e</table>", "a  b  c\nd     e"),
    ],
)
def test_drawings_formulas_and_cells_over_several_rows(page, text):
    assert render(page) == text


def test_wide_cells_are_wrapped_and_columns_stay_in_line():
    words = [f"w{i}" for i in range(60)]
    page = f"<table><tr><td>x<td>{' '.join(words)}<td>z<tr><td>longer<td>s<td>t<tr><td>{'u' * 200}<td>v<td>y</table>"
    lines = render(page).split("\n")
    assert lines[0].startswith("x       w0 ") and lines[0].endswith("  z") and max(map(len, lines[:-1])) <= 8 + html_text.WRAP_AT + 3
    assert [w for w in " ".join(lines).split() if w[0] == "w"] == words
    at = lines[0].index("  z") + 2
    assert [line[at:] for line in lines if line.startswith(("x ", "longer"))] == ["z", "t"]
    assert lines[-1] == "u" * 200 + "  v  " + " " * (at - 205) + "y" if at > 205 else lines[-1].split() == ["u" * 200, "v", "y"]


def test_tables_against_a_grid():
    """Cells at random, without line breaks: each is found where a grid that is filled cell by cell has it."""
    dealt = random.Random(5)
    for _ in range(200):
        height, taken, cells, source = dealt.randint(1, 6), set(), {}, []
        for r in range(height):
            source.append("<tr>")
            column = 0
            for k in range(dealt.randint(1, 5)):
                while (r, column) in taken:
                    column += 1
                across, down, name = dealt.choice((1, 1, 1, 2)), dealt.choice((1, 1, 2, 3)), f"c{r}_{k}" + "x" * dealt.randint(0, 6)
                if any((r, column + j) in taken for j in range(across)):
                    across = 1
                cells[name] = (r, column)
                taken |= {(r + i, column + j) for i in range(down) for j in range(across)}
                source.append(f"<td colspan={across} rowspan={down}>{name}")
                column += across
        lines = render("<table>" + "".join(source) + "</table>").split("\n")
        starts = {}
        for name, (r, column) in cells.items():
            place = re.search(rf"(?<!\S){name}(?!\S)", lines[r])
            starts.setdefault(column, {})[name] = place.start()
        for column, found in starts.items():
            # a cell over several columns may push what follows it in its row to the right
            plain = {at for name, at in found.items() if not _pushed(lines[cells[name][0]], at)}
            assert len(plain) <= 1, (source, lines)


def test_rows_without_end_tags_do_not_nest():
    page = "<table><tr><td>a<tr><td>b<tbody><tr><th>c<td>d</table>"
    depth = deepest = 0
    for kind, _, _ in html_text.events(page):
        depth += (kind == "open") - (kind == "close")
        deepest = max(deepest, depth)
    assert (depth, deepest) == (0, 4) and render(page) == "a\nb\nc  d"


def _pushed(line, at):
    """Whether only the least gap parts a cell from the one before."""
    return at >= 2 and line[at - 2 : at] == "  " and line[at - 3 : at - 2] not in ("", " ")
