import pytest
from pyspark.sql import functions as F

from tables import SMALL
from tidemark.llm import base, html_text as q

PAGES = [
    ("<html><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>One <b>t</b>wo.</p>"
     "<aside>more</aside><p>Three&nbsp;&amp; four</p><form>Mail <input></form></article><footer>(c)</footer></body></html>",
     "Title One two. Three & four"),
    ("<div class='cookie-notice'>We use cookies</div><div id=content><h2>News</h2><p>It rained a lot today.</p>"
     "<p>More rain is to come.</p></div><div class=\"side sidebar\"><ul><li><a href=x>Old news</a></li></ul></div>"
     "<section id=comments><p>First! I have a lot to say about this, and I say it at length here.</p></section>",
     "News It rained a lot today. More rain is to come."),
    ("<article>a<br>b<script>var x = '</p>';</script><style>p{}</style><!-- no --><p hidden>no</p><p>c &lt;d&gt; &quot;e&quot;",
     'a b c <d> "e"'),
    ("<article><p>cut in a tag</p><p>and &amp in a reference &am</p><a href=\"/x", "cut in a tag and & in a reference &am"),
    ("<main><p>x < y and 3 > 2</p></main>", "x < y and 3 > 2"),
    ("<body class='has-sidebar'><div class='main-banner-page'><article><p>still here</p></article></div></body>", "still here"),
    ("<article><p>text</p><div class='comments'><article class='comment'><p>not this</p></article></div></article>", "text"),
    ("<article>  spaced \n\t out  <p>\n</p> </article>", "spaced out"),
    (None, ""), ("", ""), ("   ", ""), ("<nav>only</nav>", ""), ("<", "<"), ("plain words", "plain words"),
]


@pytest.fixture(scope="module")
def weights(spark):
    return q.fit(base.table(spark, SMALL, "pages"))


@pytest.mark.parametrize("page,text", PAGES)
def test_pages(weights, page, text):
    assert q.main_text(page, weights) == text


def test_table_gives_the_article(spark, weights):
    import html
    import re

    pages = base.table(spark, SMALL, "pages")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in q.extract(pages, weights).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S).group(1)
        inner = re.sub(r"</?b>|<[^>]*$", "", re.sub(r"</?(?:p|h1|br)>", "\0", inner))
        want = " ".join(" ".join(html.unescape(x).split()) for x in inner.split("\0") if x.split())
        assert got[r["page_id"]] == (want, len(want))


def test_edges(spark, weights):
    pages = spark.createDataFrame([(1, "u", None, 1), (1, "u", "", 2), (None, None, "<article>é \U0001f600</article>", 3),
                                   (2, "v", "<article>" + "<p>w</p>" * 30000, 4)], "page_id bigint, url string, html string, text int")
    got = q.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = {(r["page_id"], r["n_chars"]) for r in got.collect()}
    assert rows == {(1, 0), (None, 3), (2, 59999)}
    assert q.extract(pages.limit(0)).count() == 0
    assert q.extract(pages.where(F.col("html") == "")).count() == 1


TEXT = "<h1>Title</h1><p>It rained a lot today and more rain is to come.</p><p>The river rose by a foot.</p>"
WHOLE = "Title It rained a lot today and more rain is to come. The river rose by a foot."


@pytest.mark.parametrize("page", [
    *(f"<body><{e}>{TEXT}</{e}></body>" for e in ("svg-icon", "title-bar", "select-box", "template-x")),
    f"<body><svg class='a>b' viewBox=\"0 0 1 1\"/>{TEXT}<svg><text>no</text></svg></body>",
    *(f"<body><nav>Home</nav><div {a}>{TEXT}<div class=sidebar>Old news</div></div></body>"
      for a in ("class='container with-sidebar'", "id='page-header-layout'", "class=no-comments")),
    f"<body><form action=/x>{TEXT}</form></body>",
    f"<body><div id=top><h1>T</h1></div><form><div class=banner-page>{TEXT * 4}</div></form></body>",
    f"<article><div class=with-sidebar>{TEXT}</div></article>",
])
def test_frames_and_longer_names_keep_the_page(weights, page):
    got = q.main_text(page, weights)
    assert WHOLE in got and "no" not in got.split() and "Old" not in got


def test_comments_larger_than_the_text_go(weights):
    talk = "<p>I have a lot to say about this and say it at length.</p>" * 5
    assert q.main_text(f"<div id=content>{TEXT}</div><section id=comments><h2>5 comments</h2>{talk}</section>", weights) == WHOLE
