"""Main text against hand-made pages and a plain reading of the given ones."""

import html
import re

import pytest

from lamella.llm import html_text, queries


def plain(page: str) -> str:
    """The article of a given page by its known markup."""
    body = re.search(r"(?s)<article>(.*?)(</article>|$)", page or "")
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body[1]).replace("<br>", " ")) if body else []
    lines = (" ".join(html.unescape(x).split()) for x in parts)
    return "\n".join(x for x in lines if x)


def test_query(spark, sf):
    want = {r.page_id: plain(r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op12_main_text(spark, sf).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("wrapped", ["<article>", "<main>", '<div class="post-content">', '<div id="articleBody">', "<div>"])
def test_everything_around_goes(wrapped):
    weights = html_text.Weights({})
    end = f"</{re.match('<([a-z]+)', wrapped)[1]}>"
    page = (
        '<html><head><title>T &amp; x</title></head><body class="single-post"><header><h1>Site</h1></header><nav><a href=x>menu</a></nav>'
        '<div class="cookie-notice"><p>We use cookies on this page, many of them indeed.</p></div>'
        f'{wrapped}<h1>Caf&eacute; &#8211; title</h1><p>First <b>bo</b>ld&nbsp;  words\n here<br>and here</p>'
        '<aside class="ad"><p>Buy this now, buy this now, buy it.</p><ul><li>one<li>two</ul></aside><script>var t = "</p><p>no";</script>'
        "<p>Second a < b, <a href='y>z'>link text</a> end.<p>Third<ul><li>item one<li>item two</ul>"
        '<form><label>Mail</label><input value="q"><button>Go</button></form><!-- <p>gone</p> --><p>Last one.</p>'
        f'{end}<section id="comments"><article class="comment"><p>Reader says a lot of things here.</p></article></section>'
        "<div role=complementary><p>Side things that are long enough to matter.</p></div><footer>&copy; foot</footer></body></html>")
    assert html_text.main_text(page, weights) == (
        "Café – title\nFirst bold words here and here\nSecond a < b, link text end.\nThird\nitem one\nitem two\nLast one.")


@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("<p>", ""), ("plain words only", "plain words only"), ("<article></article><p>outside</p>", ""),
    ("<article><p>never closed", "never closed"), ("<article><p>a</p></div></section><p>b</article>", "a\nb"),
    ("<p>cut in a tag <a href='", "cut in a tag"), ("<p>x<!-- open comment <p>y", "x"), ("<p>x<script>if (a < b) '</p>'", "x"),
    ("<article><p title=\"a > b\">ok &am &amp &lt;b&gt;</p></article>", "ok &am & <b>"),
    ("<article><header><h1>Head</h1><p>by line</p></header><p>body</p></article>", "Head\nbody"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"), ("<article><pre>a\n  b</pre><table><tr><td>c<td>d</table></article>", "a b\nc\nd"),
])
def test_odd_markup(page, want):
    assert html_text.main_text(page, html_text.Weights({})) == want


def test_long_pages_are_read_whole():
    weights = html_text.Weights({})
    text = "\n".join(f"paragraph {i}" for i in range(20_000))
    page = "<nav><a>x</a></nav><article><p>" + text.replace("\n", "</p><p>") + "</p></article><footer>f</footer>"
    assert html_text.main_text(page, weights) == text
    assert html_text.main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000, weights) == "deep"
    assert html_text.main_text("<article><p>ok</p></article>" + "<a href=\"" * 5000, weights) == "ok"


def test_region_is_the_best_stretch():
    """Scores of the chosen stretch beat those of every other one."""
    weights = html_text.Weights({})
    page = html_text.Page("<div>a b</div><ul><li><a>m</a><li><a>n</a></ul><p>one two three</p><ul><li><a>k</a></ul><p>four five</p><td>x</td>")
    scores = [weights(f) * (1 if t is None else len(t.split())) for (f, _), t in zip(page.features(), page.text, strict=True)]
    best = max(sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))
    begin, end = html_text.region(page, weights)
    assert sum(scores[begin:end]) == pytest.approx(best)


def test_weights_come_from_labelled_pages(spark):
    """Pages of this site put their text into plain cells and menus into paragraphs; the labels tell."""
    rows = [(i, f"<p>menu words that are not content {i}</p><article><td>cell text of page {i} goes on</td></article>", "t") for i in range(30)]
    rows += [(None, None, "t"), (99, "<p>no mark</p>", "t")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    counts = html_text.learn_weights(df)
    unmarked = "<p>menu words that are not content</p><td>cell text of page goes on</td>"
    assert html_text.main_text(unmarked, html_text.Weights(counts)) == "cell text of page goes on"
    out = html_text.extract(df, counts)
    assert out.columns == ["page_id", "html", "text", "text_"] and out.where("page_id IS NULL").first()["text_"] == ""
    assert html_text.learn_weights(df.limit(0)) == {} and html_text.extract(df.limit(0), {}).count() == 0
