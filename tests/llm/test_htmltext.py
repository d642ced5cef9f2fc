import random
import re
from html import escape, unescape

import pytest

from pyspark.sql import functions as F

from acuity.llm import htmltext


def one(html):
    page = htmltext.read(html)
    return htmltext.extract([page], htmltext.deduce([page]))[0]


@pytest.mark.parametrize("html, text", [
    ("<article><h1>T &amp; t</h1><p>a\n  b<p>c <b>d</b>e</article>", "T & t\na b\nc de"),
    ("<body><nav><a href=x>m</a></nav><article><p>x</p><aside>s</aside><div class='social-share'>f</div><p>y</article><footer>z", "x\ny"),
    ("<body><div id=sidebar><p>s</p></div><div class=content><p>one</p><p>two</div><div class='comments'><p>c</p></div>", "one\ntwo"),
    ("<p>a<script>var x = '<p>no</p>';</script>b<style>p{}</style> c", "ab c"),
    ("<p title='a > b' data-x=\"</p>\">q</p><!-- <p>no</p> --><p>r", "q\nr"),
    ("a < b &lt;p&gt; &#233; &nbsp;x", "a < b <p> é x"),
    ("<ul><li>one<li>two</ul>tail", "one\ntwo\ntail"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<article><header><h1>T</h1></header><p>x</p><form>f<input></form></article>", "T\nx"),
    ("<main><p>x<br>y</p><div style='display: none'>h</div><div hidden>h</div></main><p>out", "x y"),
    ("<p>x<span class='advert'>buy</span>y</p>", "x\ny"),
    ("<div class='cookie-notice'>c</div><p>load download shadow</p>", "load download shadow"),
    ("", ""), (None, ""), ("plain", "plain"), ("<", "<"), ("<p", ""), ("</p>x", "x"), ("<!-- open", ""), ("<script>open", ""), ("<p>a</b></i>b", "ab"),
])
def test_pages_by_themselves(html, text):
    assert one(html) == text


def site(rng, n, shell):
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    out = []
    for i in range(n):
        blocks = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) + f" {i}" for _ in range(rng.randint(1, 6))]
        out.append((shell("".join(f"<p>{escape(b)}</p>" for b in blocks), i), "\n".join(blocks)))
    return out


def test_constant_lines_and_link_lists_are_the_template():
    rng = random.Random(1)

    def shell(body, i):
        links = "".join(f"<li><a href=/{k}>{k} {i}</a>" for k in range(8))
        return f"<html><body><div class=x1><ul>{links}</ul></div><div class=x2><p>Welcome to this place</p>{body}</div><p>All of it is ours</p></body></html>"

    pages = site(rng, 20, shell)
    read = [htmltext.read(h) for h, _ in pages]
    assert htmltext.extract(read, htmltext.deduce(read)) == [t for _, t in pages]


def test_classes_make_the_template_and_nest():
    rng = random.Random(2)
    pages = [htmltext.read(h) for h, _ in site(rng, 12, lambda b, i: f"<html><body><nav><ul><li>a<li>b</ul></nav><article>{b}</article></body></html>")]
    found = htmltext.deduce(pages)
    names = [t[1][-1] for t in sorted(found.order, key=found.order.get) if t[0] == ""]
    assert names == ["html", "body", "nav", "ul", "article"]
    inner = {t[1][-1]: gap for t, gap in found.repeats.items()}
    assert set(inner) == {"li", "p"} and inner["li"] != inner["p"]


def test_copies_of_an_article_are_no_template():
    html = "<body><nav>m</nav><article><p>same words on each page</p></article></body>"
    read = [htmltext.read(html) for _ in range(30)]
    assert set(htmltext.extract(read, htmltext.deduce(read))) == {"same words on each page"}


def test_long_and_broken_pages_take_linear_time():
    for html in ("<p a=\"" * 100_000, "<" * 300_000, "<b>" * 20_000 + "x", "<p>x" * 50_000, "<!--" * 100_000, "<script>" * 20_000, "&" * 100_000):
        one(html)


def test_null_empty_repeated_rows_and_clashing_columns(spark):
    rows = [(1, None, None, "h", 1), (2, "", "", "h", 1), (3, "not a url%%", "<p>x", "h", 1), (3, "not a url%%", "<p>x", "h", 1), (None, "http://a.b/c", "<p>y", "h", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, part int")
    got = sorted((r.id or 0, r.url, r.text) for r in htmltext.main_text(df).collect())
    assert got == [(0, "http://a.b/c", "y"), (1, None, ""), (2, "", ""), (3, "not a url%%", "x"), (3, "not a url%%", "x")]
    assert htmltext.main_text(df.limit(0)).count() == 0


def test_the_query_equals_a_plain_reading_of_the_articles(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = htmltext.op9(spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search("<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1|li|td|tr|table|ul|div)\\b[^>]*>", inner)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "no-sidebar", "has-header", "page-with-comments", "widget"])
def test_an_article_is_whole_whatever_its_wrappers_are_called(name):
    assert one(f"<body><div class='{name}'><article><p>x</p><p>y</p></article></div>") == "x\ny"
    assert one(f"<form><div id='{name}'><main><p>x</p><nav>n</nav></main></div></form>") == "x"
    assert one(f"<body><div class='{name}'><p>x</p></div>") == "x"


def test_a_hinted_element_goes_only_as_a_slot_of_its_own():
    rng = random.Random(3)

    def shell(body, i):
        odd = "<p class='share-price'>up 3</p><div class='legal-text'>the law</div>" if i == 4 else ""
        return f"<body><div class='has-header'><article><div class='legal-body'>{body}{odd}</div><div class='post-share-row'>on {i} sites</div></article></div>"

    pages = site(rng, 12, shell)
    read = [htmltext.read(h) for h, _ in pages]
    want = [t + ("\nup 3\nthe law" if i == 4 else "") for i, (_, t) in enumerate(pages)]
    assert htmltext.extract(read, htmltext.deduce(read)) == want


def test_repeated_lines_and_link_lists_inside_the_article_are_the_template():
    rng = random.Random(4)

    def shell(body, i):
        links = "".join(f"<li><a href=/{k}>story {k} of {i}</a>" for k in range(3))
        note = "<p>Sign up for our letter</p>"
        return f"<body><article><h1><a href=/{i}>Title {i}</a></h1><p>Read this first</p>{note}<div class=b>{body}</div>{note}<ul class=x3>{links}</ul></article></body>"

    pages = site(rng, 14, shell)
    read = [htmltext.read(h) for h, _ in pages]
    want = [f"Title {i}\n{t}" for i, (_, t) in enumerate(pages)]
    assert htmltext.extract(read, htmltext.deduce(read)) == want
    # copies of one article and two others show no template
    few = [read[0]] * 20 + read[1:2]
    assert "Read this first" in htmltext.extract(few, htmltext.deduce(few))[0]


def test_a_hot_host_is_spread_over_tasks_whatever_the_files(spark):
    """A host with nearly all pages: its groups go to many tasks; the text doesn't depend on where rows lie."""
    body = "<html><body><nav><a href='/'>Home</a></nav><article><p>Story {0} is told here, with {1} words of its own.</p></article><footer>All rights {2}</footer></body></html>"
    rows = [(i, "http://hot.example/%d" % i if i % 20 else f"http://h{i}.example/", body.format(i, i * 7, "reserved")) for i in range(1200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        found = htmltext.main_text(pages, group=16)
        text = found._jdf.queryExecution().executedPlan().toString()
        at = text.index("FlatMapGroupsInPandas")
        assert "hashpartitioning(host" in text[at:] and ", part" in text[at:].split("REPARTITION_BY_COL")[0]
        per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) >= 12 and max(per_task) < 1200 / 3
        one = {r.id: r.text for r in found.collect()}
        other = {r.id: r.text for r in htmltext.main_text(pages.repartition(7).orderBy(F.desc("page_id")), group=16).collect()}
        assert one == other and one[5] == "Story 5 is told here, with 35 words of its own."
    finally:
        for key in keys:
            spark.conf.unset(key) if key != "spark.sql.shuffle.partitions" else spark.conf.set(key, "4")
