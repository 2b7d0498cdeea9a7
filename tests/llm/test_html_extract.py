import html
import random

import pytest

from starmill.llm import html_extract as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style></head>
<body class="wide"><!-- <p>comment</p> --><header><h1>Site name</h1></header>
<nav><ul><li><a href="/a">Menu a</a></li></ul></nav><div class="ad">Buy this now, really now</div>
<div id="main-%d" class="story col%d"><h2>Title &amp; <i>more</i></h2><p>One &lt;two&gt;
  three<br>four<p>Five<ul><li>six<li>seven</ul>
<script>if (a < b) { "</p>" }</script><form><input value="x">Name</form>
<div class="share-bar">Share it</div></div>
<div class="comments"><p>%s</p></div><footer>&copy; us</footer></body></html>"""
TEXT = "Title & more One <two> three four Five six seven"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def found(df):
    return {r.page_id: r.text for r in H.extract(df).collect()}


def test_consensus_overrules_a_long_comment_section(spark):
    """On one page the readers wrote more than the author; the other pages outvote it."""
    rows = [(i, f"https://Host.example/{i}", PAGE % (i, i, "short")) for i in range(6)]
    rows.append((6, "https://user@host.example:8080/x", PAGE % (6, 6, "word " * 500)))
    assert set(found(pages(spark, rows)).values()) == {TEXT}


def test_articles_between_boilerplate_equal_their_paragraphs(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(40):
        parts = [" ".join(rng.choice(["thou", "Zeit &", "<x>", "é", "a"]) for _ in range(rng.randint(1, 60)))
                 for _ in range(rng.randint(1, 6))]
        want[i] = " ".join(" ".join(p.split()) for p in parts)
        body = "".join(f"<p>{html.escape(p)}</p>" for p in parts)
        rows.append((i, f"http://h{i % 3}.example/{i}?q=1", (
            "<!DOCTYPE html><html><head><title>t</title></head><body><nav><a href='/x'>x</a></nav>"
            f"<div class='ad'>advert</div><article>{body}</article><footer>foot</footer>")))
    assert found(pages(spark, rows)) == want


NESTED = {
    "sections": ("<h1>Title</h1><p>Lead text</p><section><h2>One</h2><p>{0}</p></section>"
                 "<section class='b'><h2>Two</h2><p>{1}</p></section>", "Title Lead text One {0} Two {1}"),
    "table": ("<h1>T</h1><p>lead</p><table><tr><td>{0}</td><td>{1}</td></tr></table>", "T lead {0} {1}"),
    "quote": ("<p>lead</p><blockquote><p>{0}</p></blockquote><p>{1}</p>", "lead {0} {1}"),
    "divs": ("<h2>Head</h2><div>{0}</div><div class='x'>{1}</div>", "Head {0} {1}"),
    "slugs": ("<h2 id='related-work'>Related</h2><section id='search-algorithms'><p>{0}</p></section>"
              "<p class='notice_period'>{1}</p><div id='social-history'>end</div>", "Related {0} {1} end"),
    "figure": ("<p>{0}</p><figure><img src=x><figcaption>{1}</figcaption></figure>", "{0} {1}"),
}


@pytest.mark.parametrize("wrapper", ["article", "main", "div class='story s12'"])
@pytest.mark.parametrize("kind", NESTED)
def test_nested_articles_are_whole(spark, kind, wrapper):
    """Every part of an article comes out, in order, and nothing beside it does."""
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(12):
        texts = [" ".join(rng.choice(["un", "deux", "trois"]) for _ in range(rng.randint(5, 80)))
                 for _ in range(2)]
        body, text = (part.format(*texts) for part in NESTED[kind])
        end = wrapper.split()[0]
        rows.append((i, f"http://{kind}.example/{i}", (
            f"<html><body><nav><a href=x>menu</a></nav><{wrapper}>{body}</{end}>"
            "<ul><li><a href=y>another page here</a></li></ul>"
            "<div id='comments'><p>a reader's long comment</p></div><footer>end</footer></body></html>")))
        want[i] = text
    got = found(pages(spark, rows))
    if wrapper.startswith("div"):  # a list of links beside it is not part of the winning container
        assert {k: v.removesuffix(" another page here") for k, v in got.items()} == want
    else:
        assert got == want


def test_random_pages_equal_a_plain_walk():
    """Nested containers at random: the text of the article's tree, whatever its shape."""
    rng = random.Random(12)

    def grow(depth):
        if depth == 0 or rng.random() < 0.3:
            text = " ".join(rng.choice(["aa", "bb", "cc"]) for _ in range(rng.randint(1, 30)))
            return f"<p>{text}</p>", [text]
        tag = rng.choice(["div", "section", "blockquote", "div class='c1'", "section id='share-price'"])
        made = [grow(depth - 1) for _ in range(rng.randint(1, 4))]
        return (f"<{tag}>{''.join(m[0] for m in made)}</{tag.split()[0]}>", [t for m in made for t in m[1]])

    for _ in range(300):
        body, texts = grow(5)
        page = f"<body><header>h</header><article><h1>T</h1>{body}</article><aside><p>x</p></aside></body>"
        assert H.main_text(page, None) == " ".join(["T", *texts])


def test_odd_pages(spark):
    df = pages(spark, [
        (1, None, None), (2, "not a url", ""), (3, "http://a.example/", "plain < text & more"),
        (4, "http://a.example/", "<p>one<p>two <a hr"), (None, None, "<article>x</article>"),
        (5, "http://b.example", "<nav>only a menu</nav>"), (5, "http://b.example", "<nav>only a menu</nav>"),
        (6, "http://c.example", "<article>" + "<p>long</p>" * 20_000 + "</article>"),
        (7, "http://d.example", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (8, "http://e.example", "<p>&#65;&nbsp;&eacute;&bogus; &amp;amp;</p>"),
    ])
    rows = H.extract(df).collect()
    got = {r.page_id: r.text for r in rows}
    assert len(rows) == 10 and all(r.n_chars == len(r.text) for r in rows)
    assert (got[1], got[2], got[3], got[4]) == ("", "", "plain < text & more", "one two")
    assert (got[5], got[None], got[7]) == ("", "x", "deep")
    assert got[6] == " ".join(["long"] * 20_000) and got[8] == "A é&bogus; &amp;"
    clash = df.selectExpr("*", "'x' AS host", "'y' AS path", "'z' AS text")
    assert found(clash) == got
    assert H.extract(df.filter("false")).count() == 0


@pytest.mark.parametrize("name,dropped", [
    ("ad", True), ("ads-top", True), ("comment_list", True), ("sidebar", True), ("cookie-note", True),
    ("address", False), ("commentary", False), ("story", False), ("adventure", False),
])
def test_names_of_boilerplate(name, dropped):
    page = f"<body><div class='story'><p>kept kept kept kept</p><div class='{name}'><p>inner</p></div></div>"
    assert ("inner" not in H.main_text(page, "html>body>div.story")) is dropped
