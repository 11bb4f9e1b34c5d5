"""Main text of single pages, style trees of hosts, the given pages."""

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from orderledger.llm import html_extraction as he
from tests.llm.conftest import SF_DIR


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain  text", "plain text"),
        ("<p>a<p>b <b>c</b>d<br>e", "a b cd e"),
        ("<article>x &amp; y&nbsp;z &lt;p&gt; &amp;amp;</article>", "x & y z <p> &amp;"),
        ("<body><nav>n</nav><div>main</div><footer>f</footer><aside>s</aside>", "main"),
        ("<div class='ad box'>buy</div><p>text</p><div id=cookie-notice>ok?</div>", "text"),
        ("<p>t</p><section class='comments'><p>first!</p></section>", "t"),
        ("<script>var a='<p>no</p>';</script><style>p{}</style><p>yes</p><!-- <p>no</p> -->", "yes"),
        ("<form><p>f</p><input value='x'></form><p>t</p><button>b</button>", "t"),
        ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a b 1 2 3"),
        ("<article><header><h1>T</h1></header><p>B</p><aside>x</aside></article>after", "T B"),
        ("<main>m<div class=share>s</div></main><p>other</p>", "m"),
        ("<p title='a>b'>q</p><p>a < b</p></nonsense>", "q a < b"),
        ("<article><p>open", "open"),
        ("<h1>&am</h1>&copy &am<b>p;</b>", "&am © &amp;"),
        ("<textarea><p>x</p></textarea><title>t</title><p>y", "y"),
    ],
)
def test_single_pages(page, text):
    assert he.main_text(he.parse(page)) == text


def test_deep_pages_end():
    assert he.main_text(he.parse("<div>" * 20000 + "x")) == "x"
    assert len(he.node_features("<div>" * 2000 + "x")) <= he.MOST_DEPTH + 2


def page(body, n):
    return f"<html><body><div class='top'>Our site</div><div class='c'>{body}</div>" + (
        f"<div class='x{n % 2}'>Contact us</div></body></html>"
    )


def test_template_goes_by_entropy(spark):
    rows = [(n, f"http://a.b/{n}", page(f"<p>Story {n} of it</p>", n)) for n in range(20)]
    rows += [(100, "http://few.b/", page("<p>Story</p>", 0)), (101, None, page("<p>S</p>", 0))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in he.extract_text(df).collect()}
    assert all(got[n] == f"Story {n} of it" for n in range(20))
    assert got[100] == "Our site Story Contact us" and got[101] == "Our site S Contact us"
    trees = {(r.host, r.path): r for r in he.style_trees(df).collect()}
    key = he._path_key
    assert trees["a.b", key("//html/body/div.top")].importance == 0
    assert trees["a.b", key("//html/body/div.c/p")].importance == pytest.approx(1)


def test_copies_of_an_article_stay(spark):
    rows = [(n, "http://a.b/", "<nav>m</nav><article><p>Same</p></article>") for n in range(30)]
    rows += [(n, "http://c.d/", "<div><p>Same</p></div>") for n in range(30, 60)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.text for r in he.extract_text(df).collect()} == {"Same"}


@pytest.mark.parametrize(
    "page, text",
    [
        ("<body class='single right-sidebar'><p>s</p>", "s"),
        ("<body class='no-sidebar'><main class='cookies-not-set'><p>s</p></main>", "s"),
        ("<article class='comment'><p>s</p></article>", "s"),
        ("<article><h2 id='related-work'>R</h2><section id='side-effects'>E</section></article>",
         "R E"),
        ("<article><h2 id=legal>L</h2><section class='comments'>C</section></article>", "L C"),
        ("<div id='legal-status'>l</div><div class='nav item'>n</div><p>s</p>", "l s"),
        ("<form><nav>n</nav><div class=share>f</div><p>the story</p></form><footer>f</footer>",
         "the story"),
        ("<script>no</script><div class='menu'><div class='nav'><p>all</p></div></div>", "all"),
        ("<script>no</script><noscript><p>no</p></noscript><nav></nav>", ""),
        ("<nav>" * 20000 + "x", "x"),
    ],
)
def test_names_do_not_empty_pages(page, text):
    assert he.main_text(he.parse(page)) == text


STORY = "a story of many words in a block that no tag tells from others"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class=content>{STORY}</div><article class=card>One teaser</article>",
         f"{STORY} One teaser"),
        (f"<main></main><div>{STORY}</div>", STORY),
        (f"<main><nav>m</nav></main><div>{STORY}</div>", STORY),
        (f"<main>{STORY}</main><div>Other <article>text</article></div>", f"{STORY} text"),
        (f"<div>x<span role=main>{STORY}</span>y</div>", STORY),
    ],
)
def test_articles_need_their_share(page, text):
    assert he.main_text(he.parse(page)) == text


def test_template_inside_articles_goes(spark):
    more = "<p class='app'>Read more in our <b>app</b></p>"
    rows = [
        (n, "http://a.b/", f"<article><h1>T{n}</h1><p>Story {n} of <i>it</i></p>{more}</article>")
        for n in range(20)
    ]
    # Copies of one article, with a counter in it that differs.
    rows += [
        (n, "http://c.d/", f"<main><p>One and the same long story</p><div class='n'>{n}</div></main>")
        for n in range(20, 40)
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in he.extract_text(df).collect()}
    assert all(got[n] == f"T{n} Story {n} of it" for n in range(20))
    assert all(got[n] == f"One and the same long story {n}" for n in range(20, 40))


def test_what_meets_a_page_is_bounded_by_the_page(spark):
    # Each page has paths of its own, and every ten share others, so the host's tree has many.
    rows = [
        (n, "http://a.b/", f"<div class=t{n // 10}><p>Menu</p></div><div id=post-{n}><p>Story {n}</p>")
        for n in range(400)
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert he.style_trees(df).count() > 800
    sizes = [len(r.template) for r in he.page_templates(df).collect()]
    assert len(sizes) == 400 and set(sizes) == {2}
    assert {r.text for r in he.extract_text(df).collect()} == {f"Story {n}" for n in range(400)}


def test_branches_equal_their_most_important_nodes(spark):
    rows = [(n, "http://a.b/", f"<div class=x><div><p>{n if n < 5 else 'Same'}</p></div><b>S</b></div>")
            for n in range(12)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    variants = he.node_variants(df)
    own = {r.path: r.importance for r in he.importances(variants).collect()}
    got = {r.path: r.importance for r in he.branches(variants).collect()}
    key = he._path_key
    least = own[key("//div.x/div/p")]
    assert 0.5 < least < 1 and own[key("//div.x")] == 0
    for path in ("/", "//div.x", "//div.x/div", "//div.x/div/p"):
        assert got[key(path)] == least
    assert got[key("//div.x/b")] == 0


@pytest.mark.parametrize("pages", [2, 3, 7, 8, 30])
def test_small_hosts_are_cleaned_like_large_ones(spark, pages):
    rows = [(n, f"http://a.b/{n}", page(f"<p>Story {n} of it</p>", 0)) for n in range(pages)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in he.extract_text(df).collect()}
    assert got == {n: f"Story {n} of it" for n in range(pages)}


@pytest.mark.parametrize("pages", [2, 7, 8, 30])
def test_blocks_that_articles_share_stay_whatever_their_number(spark, pages):
    """A correction inside some of a host's articles, an author's line in those of a small host."""
    note = "<p class=correction>The price in this story was wrong.</p>"
    rows = [
        (n, f"http://a.b/{n}", f"<article><h1>T{n}</h1><p>Story {n} of it</p>"
                               f"{note if n < pages else ''}</article>")
        for n in range(40)
    ]
    rows += [
        (n, "http://c.d/", f"<article><i>By</i><p class=by>Ann Lee</p><p id=s>Story {n}</p></article>")
        for n in (40, 41)
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in he.extract_text(df).collect()}
    for n in range(40):
        end = " The price in this story was wrong." if n < pages else ""
        assert got[n] == f"T{n} Story {n} of it{end}"
    assert got[40] == "By Ann Lee Story 40" and got[41] == "By Ann Lee Story 41"


@pytest.mark.parametrize(
    "page",
    [
        "<a \"" * 250_000,
        "<a \">\" " * 125_000 + "\"",
        "</a \">\" " * 125_000 + "\"",
        "<div>" * 90_000 + "<li></li>" * 60_000,
        "<li><ul>" + "<div>" * 90_000 + "<li></li>" * 60_000,
        "<div>" * 90_000 + "<b></i>" * 70_000,
    ],
)
def test_hostile_pages_take_linear_time(page):
    begin = time.process_time()
    he.parse(page)
    assert time.process_time() - begin < 5


def test_tags_whose_quotes_do_not_close():
    assert he.main_text(he.parse("<p title='x>a</p><p>it\"s</p>b <i")) == "a it\"s b <i"
    assert he.main_text(he.parse("<p title='a>b'>c</p><p class=\">d</p>e")) == "c d e"


def test_pages_without_the_article_tag(spark):
    """The given pages with their articles renamed have the same text, by the entropies alone."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html")
    tags = "(?i)(</?)article"
    renamed = pages.select("page_id", "url", F.regexp_replace("html", tags, "$1div").alias("html"))
    want = {r.page_id: r.text for r in he.extract_text(pages).collect()}
    got = {r.page_id: r.text for r in he.extract_text(renamed).collect()}
    assert got == want


def test_other_hosts_tell_about_single_pages(spark):
    def html_of(host, n):
        return f"<div class=top>{host}</div><div class=c><p>Story {n}</p></div><b class=x>{n}</b>"

    rows = [(n, f"http://h{n % 4}.b/{n}", html_of(n % 4, n)) for n in range(20)]
    rows += [(20, "http://one.b/", html_of("one", 20)), (21, None, html_of("none", 21)),
             (22, None, html_of("none", 21)), (23, "http://two.b/", "<div class=top>All</div>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in he.extract_text(df).collect()}
    assert all(got[n] == f"Story {n} {n}" for n in range(22))
    assert got[22] == "Story 21 21" and got[23] == "All"


def test_copies_among_other_pages_stay(spark):
    rows = [(n, "http://a.b/", f"<div class=top>T</div><div id=p{n}><p>Story {n}</p></div><i>{n}</i>")
            for n in range(30)]
    copy = "<div class=top>T</div><div id=q><p>Twice the same</p></div>"
    rows += [(n, f"http://a.b/?{n}", f"{copy}<i>{n}</i>") for n in (30, 31)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in he.extract_text(df).collect()}
    assert got[30] == "Twice the same 30" and got[0] == "Story 0 0"


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "http://a.b", "<p>x"), (3, "http://a.b", "<p>y"),
            (3, "http://a.b", "<p>y"), (4, "HTTPS://u@A.B:80/p?q#f", "<p>" + "z " * 100_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    clashing = df.selectExpr("*", "1 AS id", "2 AS host", "3 AS salt", "4 AS text")
    got = he.extract_text(clashing)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(len(r.text) for r in got.collect()) == [0, 0, 1, 1, 1, 199_999]
    assert he.extract_text(df.limit(0)).collect() == []
    assert [he.host_of(u) for _, u, _ in rows] == ["", "", "a.b", "a.b", "a.b", "a.b"]


def test_given_pages(spark):
    from orderledger.llm.queries import QUERIES

    got = {r.page_id: r for r in QUERIES["op7_html_extraction"](spark, SF_DIR).collect()}
    for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect():
        body = re.search("<article>(.*)</article>", r.html, re.DOTALL)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", body.replace("<b>", "").replace("</b>", ""))
        text = " ".join(html.unescape(" ".join(blocks)).split())
        assert got[r.page_id].text == text and got[r.page_id].n_chars == len(text)
