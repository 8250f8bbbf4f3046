"""Main text of hand-made and given pages."""

import html
import re

import __spark_entry__ as entry
from kartotek.llm import extraction as ext

PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-banner">We use cookies to help</div>
<div id=content><h2>A real &amp; proper title</h2><p>First paragraph with <b>bold</b>
   and <a href=x>a link</a> inside it<p>Second one has 1 &lt; 2 &#38; 3 &gt; 2 and caf&eacute;s<br>on two lines
<script>var t = "<p>no</p>";</script><div class="ad">Buy now</div>
<p>Third paragraph closes the whole long story here.</div>
<aside>Related stories</aside><form><label>Mail</label><input><button>Send</button></form>
<section class="comments"><p>First! Nice article, thank you so much for this.</p></section>
<footer>&copy; 2020 all rights</footer>"""
TEXT = ("A real & proper title\n\nFirst paragraph with bold and a link inside it\n\n"
        "Second one has 1 < 2 & 3 > 2 and cafés on two lines\n\nThird paragraph closes the whole long story here.")


def test_hand_made_page():
    assert ext.main_text(PAGE, {}) == TEXT


def test_odd_pages():
    for page, want in ((None, ""), ("", ""), ("   ", ""), ("just words here", "just words here"), ("<p>", ""), ("a < b", "a < b"),
                       ("<script>x", ""), ("<!-- open", ""), ("<nav>only menu</nav>", ""), ("<p>a&nbsp;b\t c</p>", "a b c"),
                       ("<p>one<p>two", "one\n\ntwo"), ("</div></p>end", "end"), ("<textarea>x</textarea>y", "y")):
        assert ext.main_text(page, {}) == want, page


def test_a_very_long_page():
    body = "".join(f"<p>para {k} with words</p>" for k in range(20_000))
    got = ext.main_text(f"<nav><a>m</a></nav>{body}<footer>f</footer>", {})
    assert got.count("\n\n") == 19_999 and got.endswith("para 19999 with words") and got.startswith("para 0 ")


def test_the_stretch_is_the_best_one():
    """Against all stretches: the sum over words and tags is the largest possible."""
    page = "<p>a b</p><div><div>" + "<p>c d e</p>" + "<br>" * 9 + "<p>f g</p></div></div>"
    row = ext.tokens(page)
    weigh = [0 if k == "space" else ext.prior(k) * max(1, len(t.split())) for k, t, _, _ in row]
    best = max((sum(weigh[i:j]), -i) for i in range(len(row)) for j in range(i + 1, len(row) + 1))
    assert abs(best[0] - 3) < 1e-9 and ext.main_text(page, {}) == "c d e"


def test_query_on_the_given_pages(spark, data_dir):
    got = {r.page_id: r for r in entry.queries()["op5_html_extraction"](spark, data_dir).collect()}
    pages = spark.read.parquet(f"{data_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    right = 0
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = (html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n\n".join(t for t in (re.sub(r"\s+", " ", b).strip() for b in blocks) if t)
        right += got[p.page_id].text == want
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url
    assert right >= 0.98 * len(pages)


def test_nulls_repeats_empty_table_and_other_columns(spark):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (None, None, None, 5), (3, "v", "", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted((r.page_id or 0, r.text) for r in ext.extract(df).collect())
    assert got == [(0, ""), (1, TEXT), (1, TEXT), (3, "")]
    assert ext.extract(df.limit(0)).collect() == []


def test_weights_keep_their_side(spark):
    rows = [(k, f"<nav><a>m{k}</a></nav><article><h1>t</h1><p>some words here</p></article><footer>f</footer>") for k in range(40)]
    weights = ext.fit(spark.createDataFrame(rows, "page_id long, html string"))
    assert weights["word"] > 0 > weights["part:menu"] and weights["tag:p"] < 0 and "tag:article" not in weights


def test_layout_names_of_bodies_articles_and_wrappers_leave_nothing_out():
    text = "<h1>Title here</h1><p>The first part of a long story.</p><p>And the second one.</p>"
    want = "Title here\n\nThe first part of a long story.\n\nAnd the second one."
    side = '<div class="sidebar"><p>Other things to see here today and tomorrow.</p></div>'
    for page in (
        f'<html class="no-js cookies"><body class="right-sidebar">{text}{side}</body></html>',
        f'<body class="sidebar"><main id="menu" class="banner">{text}</main>{side}</body>',
        f'<body class="single comments-open"><div class="content-with-sidebar">{text}</div>{side}',
        f'<div class="layout sidebar"><article class="post comments-open">{text}</article></div>{side}',
        f'<article class="post tag-popular">{text}</article>{side}',
        f'<article class="post popular related">{text}</article>{side}',
        f'<div class="post comments-open tag-popular">{text}</div>{side}',
        f'<div data-id="comments" data-class="popular">{text}</div>{side}',
        f'<article>{text}<section class="comments"><article class="comment"><p>Nice!</p></article></section></article>{side}',
        f'<article>{text}<ol><li><article class="comment-body"><p>Nice one!</p></article></ol></article>{side}',
        f'<div class="related_posts"><article class="teaser">See this.</article></div><div class="sidebar"><article>{text}</article></div>',
        f'<main>{text}<div class="comments"><article class="comment"><p>I do not think so at all.</p></article></div></main>{side}',
    ):
        assert ext.main_text(page, {}) == want, page
