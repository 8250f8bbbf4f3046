"""Main text of web pages as a maximum-scoring subsequence.

A page is a row of tokens: tags and words. Words score above zero and tags below; words in links
score a little below zero, and so does all in parts whose tag or class names menus, adverts, forms,
comments and the like; whole names count, and never those of html, body, main, article or what holds the
labelled article. One linear scan finds the contiguous stretch with the largest sum; parts of
the named kinds inside it are left out.

The weights come from labelled pages: on pages with exactly one ``article`` or ``main`` element its
inside is right and the rest wrong. A weight is the log odds of a token's kind inside and outside,
drawn to a prior and kept on its side of zero; the labelling elements themselves never score. The
fit takes a bounded sample of about FIT_PAGES pages; without labelled pages the priors hold.

Defined results: null or empty html: empty text; no words that score: empty text; text outside any
element counts; unclosed comments, scripts and tags run to the end; a ``<`` that opens no tag is
text; of equally good stretches the first, longest one; repeated rows give repeated rows; an empty
table gives an empty result; further columns are ignored; pages of any length are read whole.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages of the sample that the weights are fitted on, about.
FIT_PAGES = 500
#: Tokens' worth of the priors.
PRIOR_COUNT = 20.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|head|title)\b[^>]*>"
    r".*?(?:</\1\s*>|\Z)|<[/!?a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|<[/!?a-zA-Z][^>]*(?:>|\Z)|[^<]+|<",
    re.S | re.I)
_NAME = re.compile(r"</?\s*([a-zA-Z][a-zA-Z0-9]*)")
_HINT = re.compile(r"""(?<![\w:-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split())
#: Blocks of running text.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
#: Elements whose words are not main text, by the kind they stand for.
LEFT_OUT = {
    "nav": "menu", "menu": "menu", "footer": "footer", "aside": "side", "form": "form", "button": "form",
    "select": "form", "textarea": "form", "input": "form", "dialog": "notice", "header": "header",
}
#: Whole names in class, id or role that stand for such parts; ``_`` counts as ``-``.
HINTS = {name: kind for kind, names in (
    ("menu", "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc main-nav main-menu main-navigation "
             "nav-menu nav-bar navbar-nav nav-links nav-list nav-wrapper nav-container top-nav top-menu site-nav site-navigation "
             "primary-nav primary-menu primary-navigation secondary-nav secondary-menu secondary-navigation mobile-nav "
             "mobile-menu side-nav side-menu sidenav footer-nav footer-menu menu-item menu-container menu-wrapper sub-menu "
             "submenu dropdown-menu post-navigation posts-navigation page-navigation page-numbers table-of-contents skip-link"),
    ("footer", "footer foot colophon copyright contentinfo site-footer page-footer main-footer footer-wrapper footer-container "
               "footer-widgets footer-bottom footer-top footer-inner footer-content footer-links post-footer entry-footer "
               "article-footer"),
    ("header", "header masthead topbar banner site-title site-header page-header main-header header-wrapper header-container "
               "header-inner header-top top-bar site-branding site-description top-banner header-banner"),
    ("side", "sidebar side aside related recommended widget widgets complementary trending popular left-sidebar right-sidebar "
             "sidebar-left sidebar-right sidebar-primary sidebar-secondary primary-sidebar secondary-sidebar main-sidebar "
             "site-sidebar page-sidebar blog-sidebar sidebar-widget sidebar-widgets sidebar-inner sidebar-content "
             "sidebar-wrapper sidebar-container side-bar widget-area widget-container related-posts related-articles "
             "related-stories related-content related-links related-items recommended-posts recommended-articles "
             "popular-posts popular-articles most-popular most-read trending-posts trending-now"),
    ("notice", "cookie cookies consent notice alert popup modal overlay gdpr newsletter subscribe signup promo cookie-banner "
               "cookie-notice cookie-consent cookie-bar cookie-law cookie-policy cookie-message cookies-banner cookies-notice "
               "consent-banner consent-popup gdpr-banner gdpr-notice newsletter-signup newsletter-form newsletter-box "
               "newsletter-popup email-signup signup-form subscribe-form subscribe-box promo-box promo-banner modal-dialog "
               "modal-content modal-body popup-content popup-overlay alert-box alert-banner site-notice"),
    ("advert", "ad ads advert adverts advertisement advertisements sponsor sponsored sponsors banner-ad adsense ad-banner "
               "ad-box ad-container ad-wrapper ad-slot ad-unit ad-block ad-space ad-label ad-top ad-sidebar ads-container "
               "ads-wrapper sidebar-ad top-ad google-ad google-ads advert-box advertisement-label sponsored-content "
               "sponsored-post sponsored-links"),
    ("comment", "comment comments disqus reply replies respond discussion disqus-thread comments-area comments-section "
                "comments-list comments-wrapper comments-container comments-title comment-list commentlist comment-section "
                "comment-body comment-content comment-text comment-thread comment-form comment-respond comment-reply "
                "comment-author comment-meta comment-metadata post-comments article-comments user-comments discussion-thread "
                "reply-form"),
    ("share", "share sharing social tags byline-links social-share social-links social-icons social-media social-sharing "
              "social-buttons social-bar share-buttons share-links share-bar share-this sharing-buttons sharedaddy post-share "
              "article-share post-tags entry-tags article-tags tag-list tags-links tag-links"),
) for name in names.split()}
#: Elements that names never turn into such parts: they stand for the page or its text.
UNHINTED = frozenset("html body main article".split())
_CLOSED_BY = {"p": frozenset("p div ul ol table h1 h2 h3 h4 h5 h6 section article blockquote pre form nav footer header aside main figure dl hr".split()),
              "li": frozenset(["li"]), "option": frozenset(["option"]), "tr": frozenset(["tr"]),
              "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"])}
_LABELS = ("article", "main")


def hint_of(markup: str) -> str | None:
    """The left-out kind that an element's class, id or role names."""
    for groups in _HINT.findall(markup):
        for name in "".join(groups).lower().replace("_", "-").split():
            if name in HINTS:
                return HINTS[name]
    return None


class _Element:
    """An open element; ``kind``: the left-out part that it is. A ``hinted`` one is so by its names
    only, which do not count if the labelled article turns out to stand in it."""

    __slots__ = ("tag", "kind", "hinted", "up", "begun", "words")

    def __init__(self, tag: str, markup: str, up: _Element | None, inside: str | None, begun: int):
        self.tag, self.up, self.begun, self.words = tag, up, begun, 0
        hint = hint_of(markup)
        # an article in another one that is named a comment is one; no other article is left out
        if tag in UNHINTED and not (tag == inside == "article" and hint == "comment"):
            hint = None
        self.hinted = hint is not None and tag not in LEFT_OUT
        # a header or footer of the article is its own
        self.kind = hint or (None if tag == "header" and inside else LEFT_OUT.get(tag))


def _part(element: _Element | None) -> str | None:
    """The innermost left-out part around a place."""
    while element is not None:
        if element.kind:
            return element.kind
        element = element.up
    return None


def _free_holders(labels: list[tuple[_Element, str | None]]) -> None:
    """No name makes a part of what holds a ``main`` or the labelled article: the one with the most
    words, of those not named a part themselves if there are others."""
    held = [e for e, _ in labels if e.tag == "main"]
    articles = [(e, hint) for e, hint in labels if e.tag == "article"]
    if held or any(not hint for _, hint in articles):
        articles = [(e, hint) for e, hint in articles if not hint]
    if articles:
        held.append(max((e for e, _ in articles), key=lambda e: e.words))
    done: set[int] = set()
    for e in held:
        while e is not None and id(e) not in done:
            done.add(id(e))
            if e.hinted:
                e.kind = None
            e = e.up


def tokens(page: str) -> list[tuple[str, str, int, bool]]:
    """(kind, text, block, labelled) in page order. Kinds: ``tag:name``, ``word``, ``word:link`` in a
    link, ``part:`` with the left-out part that a tag or word stands in; block numbers change where
    a block ends."""
    out: list[tuple[str, str, int, bool, _Element | None]] = []
    stack: list[_Element] = []
    labels: list[tuple[_Element, str | None]] = []
    block = words = 0

    def close(n: int) -> None:
        for e in stack[n:]:
            e.words = words - e.begun
        del stack[n:]

    for m in _TOKEN.finditer(page):
        piece = m[0]
        if piece[0] != "<" or piece == "<":
            text = entities.unescape(piece)
            if text.strip():
                link = any(e.tag == "a" for e in stack)
                words += len(text.split())
                out.append(("word:link" if link else "word", text, block, any(e.tag in _LABELS for e in stack),
                            stack[-1] if stack else None))
            elif out and text:
                out.append(("space", " ", block, False, None))
            continue
        name = _NAME.match(piece)
        if piece.startswith("<!") or m[1] or not name:
            continue
        tag = name[1].lower()
        if tag not in INLINE:
            block += 1
        if piece[1] == "/":
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)
            if at is not None:
                close(at)
        else:
            while stack and tag in _CLOSED_BY.get(stack[-1].tag, ()):
                close(len(stack) - 1)
            if tag == "li" and any(e.tag == "li" for e in stack):
                depth = max(i for i, e in enumerate(stack) if e.tag == "li")
                if not any(e.tag in ("ul", "ol") for e in stack[depth:]):
                    close(depth)
            if tag not in VOID and not piece.endswith("/>"):
                inside = next((e.tag for e in reversed(stack) if e.tag in _LABELS), None)
                stack.append(_Element(tag, piece, stack[-1] if stack else None, inside, words))
                if tag in _LABELS:
                    labels.append((stack[-1], hint_of(piece)))
        if tag == "br":
            out.append(("space", " ", block, False, None))
        out.append((f"tag:{tag}", "", block, any(e.tag in _LABELS for e in stack), stack[-1] if stack else None))
    close(0)
    _free_holders(labels)
    parts: dict[int, str | None] = {}

    def kind_at(kind: str, element: _Element | None) -> str:
        if kind == "space" or element is None:
            return kind
        if id(element) not in parts:
            parts[id(element)] = _part(element)
        part = parts[id(element)]
        return f"part:{part}" if part else kind

    return [(kind_at(kind, e), text, block, labelled) for kind, text, block, labelled, e in out]


def prior(kind: str) -> float:
    if kind == "word":
        return 1.0
    if kind == "word:link":
        return -0.5
    if kind.startswith("part:"):
        return -0.2
    return -0.3 if kind[4:] in INLINE or kind[4:] in TEXTUAL else -1.0


def weight_of(kind: str, inside: float, outside: float, total_in: float, total_out: float) -> float:
    """Log odds of a kind inside and outside, drawn to the prior, on the prior's side of zero."""
    odds = math.log((inside + 1) / (total_in + 1)) - math.log((outside + 1) / (total_out + 1))
    n = inside + outside
    blended = (PRIOR_COUNT * prior(kind) + n * odds) / (PRIOR_COUNT + n)
    if prior(kind) > 0:
        return max(0.1, min(blended, 2.0))
    return min(-0.1, max(blended, -0.5 if kind.startswith("part:") else -2.0))


def counts_of(page: str) -> tuple[Counter, Counter] | None:
    """Tokens of each kind inside and outside the one labelling element; None without one."""
    openings = len(re.findall(r"<(?:article|main)\b", page, re.I))
    if openings != 1:
        return None
    inside, outside = Counter(), Counter()
    for kind, text, _, labelled in tokens(page):
        if kind != "space" and kind not in ("tag:article", "tag:main"):
            (inside if labelled else outside)[kind] += max(1, len(text.split()))
    return inside, outside


def fit(pages: DataFrame) -> dict[str, float]:
    """Weights from a sample of labelled pages; counted on the executors, summed by Spark."""
    labelled = pages.where("html RLIKE '(?i)<(article|main)[ >]'").select("page_id", "html")
    total = labelled.count()
    if not total:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside, outside = Counter(), Counter()
            for page in batch.column(0).to_pylist():
                found = counts_of(page)
                if found:
                    inside.update(found[0])
                    outside.update(found[1])
            kinds = sorted(inside.keys() | outside.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), *(pa.array([c[k] for k in kinds], pa.int64()) for c in (inside, outside))],
                ["kind", "inside", "outside"])

    rows = (
        labelled.where(F.pmod(F.xxhash64("page_id", "html"), F.lit(total)) < FIT_PAGES).select("html")
        .mapInArrow(count, "kind string, inside long, outside long")
        .groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .orderBy(F.desc(F.col("inside") + F.col("outside")), "kind").limit(500).collect()  # kinds of tags, few
    )
    total_in, total_out = (sum(r[c] for r in rows) for c in ("inside", "outside"))
    return {r["kind"]: weight_of(r["kind"], r["inside"], r["outside"], total_in, total_out) for r in rows}


def main_text(page: str | None, weights: dict[str, float]) -> str:
    row = tokens(page or "")
    best, best_at = 0.0, (0, 0)
    run, start = 0.0, 0
    for i, (kind, text, _, _) in enumerate(row):
        if kind == "space" or kind in ("tag:article", "tag:main"):
            continue
        w = weights.get(kind)
        if w is None:
            w = prior(kind)
        w *= max(1, len(text.split()))
        if run <= 0:
            run, start = 0.0, i
        run += w
        if run > best:
            best, best_at = run, (start, i + 1)
    blocks: list[str] = []
    at = None
    for kind, text, block, _ in row[best_at[0]:best_at[1]]:
        if kind in ("word", "word:link", "space"):
            if block != at:
                blocks.append("")
                at = block
            blocks[-1] += text
    clean = (_SPACE.sub(" ", b).strip() for b in blocks)
    return "\n\n".join(b for b in clean if b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    weights = pages.sparkSession.sparkContext.broadcast(fit(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, weights.value) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
