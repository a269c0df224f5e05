"""Main-text extraction from HTML pages.

A page becomes a flat list of text blocks, cut at block-level tags. Every block gets its
word count and link density, those of the blocks before and after it, and what its open
containers say (main or boilerplate by tag; what words in class, id and role hint at, and how much of the
page stands under such a name). A decision tree, trained when first used on the small labelled table
below, keeps or drops the block. Inside an article everything stays that no tag or name takes out. A name that only says what a
wrapper has (has-sidebar, with-nav) is no hint, and an article inside a named wrapper, or inside a menu or the like
that was never closed, is not taken out by it, unless the page has another one outside. Reader comments go however much
of the page they are. Without names and articles, length, links and neighbours of a block decide.

Defined results: null, empty or text-less html gives an empty text; comments, scripts, styles and the
head never count; unclosed tags end with their container, an unclosed comment or script at the
page's end; elements hidden by attribute or style (block-level ones) never count; a <br> is white space; repeated rows and null ids keep their row; an empty table stays
empty; other columns are ignored.
"""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kestrel.llm.common import map_arrow, strings

_TAG = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*+>?|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?)", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")

RAW = {"script", "style", "title", "textarea", "xmp", "noframes"}
HIDDEN = {"head", "script", "style", "template", "svg", "math", "select", "button", "object", "iframe", "canvas", "audio", "video", "datalist"}
BOILERPLATE = {"nav", "aside", "footer", "form", "noscript", "menu", "dialog", "fieldset"}
MAIN = {"article", "main"}
CONTAINERS = (HIDDEN | BOILERPLATE | MAIN | {"header", "div", "section", "ul", "ol", "dl", "table", "blockquote", "figure", "details"}) - RAW
BLOCKS = CONTAINERS | {"p", "li", "dt", "dd", "tr", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "hr", "address", "figcaption",
                       "caption", "body", "html", "option", "summary", "center", "hgroup"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words of class, id and role names that tell what a container holds.
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs cookie cookies consent copyright disclaimer "
    "footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notification popup promo promotion "
    "overlay recommended related share sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets "
    "comment comments commentlist disqus reply replies respond responses thread discussion search alert complementary contentinfo pagination pager".split())
#: Those that name reader comments: no share of the page makes them its text.
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond responses thread".split())
#: A name that starts with one of these tells what stands beside or inside, not what the element is.
STATE_WORDS = frozenset("has have with without no is show hide".split())
#: Words that name a part of the text when they stand inside an article.
SECTION_WORDS = frozenset({"discussion"})
MAIN_WORDS = frozenset("article content entry main post story body text maincontent articlebody".split())

FEATURES = ("boilerplate", "main", "page_has_main", "heading", "list", "words", "link_density", "words_before", "link_density_before",
            "words_after", "link_density_after", "hinted", "named", "named_share")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_UNSEEN = re.compile(r"style\s*=\s*[\"']?[^\"']*display\s*:\s*none", re.I)


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    boilerplate: bool
    main: bool
    heading: bool
    listed: bool
    hinted: bool
    at: int  # where it starts in the page
    named: int = 0  # the outermost container whose name hints at boilerplate, 0 without one
    cleared: bool = False  # an article or main element stands between that container and the block
    boxed: bool = False  # boilerplate only by a container outside of an article or main element
    comment: bool = False  # stands in reader comments

    @property
    def density(self) -> float:
        return self.link_words / max(1, self.words)


def _unseen(attributes: str) -> bool:
    """Is the element hidden by its attributes?"""
    return "hidden" in _QUOTED.sub("", attributes).lower().replace("=", " ").split() or bool(_UNSEEN.search(attributes))


def _hints(attributes: str, in_main: bool = False) -> tuple[bool, bool, bool]:
    """(boilerplate, main, comment) by the words of the element's names."""
    words = set()
    if "=" in attributes:
        for m in _ATTR.finditer(attributes):
            for name in (m[2] or m[3] or m[4] or "").lower().split():
                own = _WORD.findall(name)
                if len(own) < 2 or own[0] not in STATE_WORDS:
                    words.update(own)
    return bool(words & (BOILERPLATE_WORDS - SECTION_WORDS if in_main else BOILERPLATE_WORDS)), bool(words & MAIN_WORDS), bool(words & COMMENT_WORDS)


def blocks(page: str | None) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    # (tag, hidden, boilerplate, main, listed, only a form makes it boilerplate, named, cleared, boxed, comment)
    stack = [("", False, False, False, False, False, 0, False, False, False)]
    names = 0
    parts: list[str] = []
    links = begin = pos = 0
    in_link, tag_of, hinted, unseen = False, "", False, False
    page = page or ""

    def flush():
        nonlocal parts, links
        text = " ".join("".join(parts).split())
        if text:
            _, _, boilerplate, main, listed, _, named, cleared, boxed, comment = stack[-1]
            n = len(text.split(" "))
            out.append(Block(text, n, min(links, n), boilerplate, main, tag_of in HEADINGS, listed or tag_of in ("li", "dt", "dd"), hinted, begin,
                             named, cleared, boxed, comment))
        parts, links = [], 0

    def add(raw: str):
        nonlocal links, begin
        if raw and not stack[-1][1] and not unseen:
            if not parts:
                begin = pos
            text = html.unescape(raw)
            parts.append(text)
            if in_link:
                links += len(text.split())

    while True:
        m = _TAG.search(page, pos)
        add(page[pos:m.start() if m else len(page)])
        if not m:
            break
        pos = m.end()
        if not m[2]:
            continue
        closing, tag = bool(m[1]), m[2].lower()
        if not closing and tag in RAW and not m[3].endswith("/"):
            end = re.compile(f"</{tag}", re.I).search(page, pos)
            pos = end.start() if end else len(page)
            if not end:
                break
            continue
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCKS:
            flush()
            in_link, tag_of, hinted, unseen = False, "" if closing else tag, False, False
            if tag == "body":
                del stack[1:]
            elif closing and tag in CONTAINERS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            elif not closing:
                if stack[-1][0] == "head" and tag != "head":
                    stack.pop()
                boiler, main, talk = _hints(m[3], stack[-1][3] and not stack[-1][6])
                gone = _unseen(m[3])
                if tag in CONTAINERS and not m[3].endswith("/"):
                    _, hidden, b, mm, listed, formed, named, cleared, boxed, comment = stack[-1]
                    own_main = tag in MAIN or main and not boiler
                    own = tag in BOILERPLATE or tag == "header" and not mm
                    only_form = tag == "form" and not b or formed and not own
                    if tag in MAIN and b and formed:
                        b = only_form = False
                    boxed = not own and b and (boxed or tag in MAIN)
                    if boiler and tag not in MAIN and (not named or cleared):
                        names += 1
                        named, cleared = names, False
                    elif tag in MAIN and named and not boiler:
                        cleared = True
                    stack.append((tag, hidden or tag in HIDDEN or gone, b or own, mm or own_main, listed or tag in ("ul", "ol", "menu"), only_form,
                                  named, cleared, boxed, comment or talk and boiler and tag not in MAIN))
                else:
                    hinted, unseen = boiler, gone
        elif tag in CONTAINERS and not closing:
            stack.append((tag, True, True, False, False, False, 0, False, False, False))
    flush()
    return out


def features(page: list[Block]) -> np.ndarray:
    """[blocks, FEATURES]."""
    if not page:
        return np.empty((0, len(FEATURES)))
    words, density = np.array([b.words for b in page], float), np.array([b.density for b in page])
    # an article outside of all menus and named containers is the page's: those inside are comments or teasers
    outside = any(b.main and not b.boilerplate and not b.named for b in page)
    boilerplate = [b.boilerplate and (outside or not b.boxed) for b in page]
    named = [b.named if not b.cleared or outside else 0 for b in page]
    # how much of the page stands under a name: a page without an article may be named as a whole
    under = np.bincount(named, words)
    share = np.array([0.0 if outside or b.comment or not n else under[n] / words.sum() for b, n in zip(page, named)])
    has_main = any(b.main and not x and not n for b, x, n in zip(page, boilerplate, named))
    shift = lambda x: (np.r_[0.0, x[:-1]], np.r_[x[1:], 0.0])
    (wb, wa), (db, da) = shift(words), shift(density)
    flags = np.array([[x, b.main, has_main, b.heading, b.listed] for b, x in zip(page, boilerplate)], float)
    return np.c_[flags, words, density, wb, db, wa, da, [float(b.hinted) for b in page], [float(n > 0) for n in named], share]


_LONG = "the council said on monday that the old bridge will be closed for repairs until the end of the summer because of the flood damage "
_FERRY, _NEXT = "the ferry did not leave the harbour today because of the strong wind", "nobody knows when the next one will leave again"
#: The labelled table: pages as (keep, html) pieces; every block takes the label of the piece it starts in.
TABLE = (
    # an article element after menu, advert and before the footer; short paragraphs and headings belong to it
    ((0, '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">World news</a></li></ul></nav>'), (0, '<div class="ad">Buy our new phone today and save.</div>'),
     (1, "<article><h1>Bridge closed</h1>"), (1, f"<p>{_LONG}</p>"), (1, "<p>Yes.</p>"), (1, f'<p>{_LONG * 2} see <a href="/x">the report</a></p>'),
     (1, "<h2>What next</h2>"), (1, "<ul><li>One lane opens in June</li><li>Both in July</li></ul>"), (1, "<p>Works go on.</p></article>"),
     (0, "<footer>&copy; The Gazette, all rights reserved by the publisher.</footer>")),
    # notices and asides inside an article; reader comments after it
    ((0, "<header><h1>The Gazette</h1><p>News since 1901</p></header>"), (0, '<div id="cookie-notice"><p>We use cookies to improve the site for all readers of it.</p></div>'),
     (1, "<main><article><header><h1>River rises</h1></header>"), (1, f"<p>{_LONG * 3}</p>"), (0, f'<aside><p>{_LONG}</p><a href="/1">Related story</a></aside>'),
     (1, "<p>So it goes.</p>"), (0, '<p class="advert">Cheap boats for sale here.</p>'), (1, "<blockquote><p>A quoted sentence of a few words.</p></blockquote></article>"),
     (0, f'<section class="comments"><h3>2 comments</h3><p>{_LONG * 2}</p><p>I agree.</p></section></main>'), (0, "<footer><p>Contact</p></footer>")),
    # no main element and no names: long blocks of few links, and what stands between them
    ((0, '<div><a href="/">Home</a> <a href="/n">News</a> <a href="/s">Sport</a></div>'), (0, '<div><a href="/l">Log in</a></div>'), (1, "<div><h1>A long walk</h1>"),
     (1, f"<p>{_LONG}</p>"), (1, f"<p>{_LONG * 2}</p>"), (1, f'<p>{_LONG} <a href="/y">more on this</a></p></div>'),
     (0, '<div><a href="/1">First other story of the day</a> <a href="/2">Second other story</a></div>'), (0, "<div>Copyright 2020</div>")),
    ((0, '<div class="menu"><a href="/">Start</a> | <a href="/c">Contact us</a></div>'), (1, f'<div class="content"><p>{_LONG * 2}</p>'), (1, "<p>It rained.</p>"),
     (1, f"<p>{_LONG}</p></div>"), (0, f'<div class="sidebar"><h3>Popular</h3><ul><li><a href="/p">The best soups</a></li></ul><p>{_LONG}</p></div>'),
     (0, '<form><label>Search</label><p>Type a word to search our archive of old news.</p></form>'), (0, '<div class="footer">Imprint and terms of use</div>')),
    ((0, '<ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul>'), (1, f"<p>{_LONG * 2}</p>"), (1, f"<p>{_LONG}</p>"), (1, "<p>The end of a short line.</p>"),
     (1, f"<p>{_LONG}</p>"), (0, '<p><a href="/next">Next page</a></p>')),
    # an article in pieces with a promotion between them
    ((0, "<header><p>The daily news of the whole region</p></header>"), (1, "<article><p>Short first line.</p>"), (0, '<div class="promo"><p>Subscribe now for a month of free news at home.</p></div>'),
     (1, "<p>Then another.</p>"), (1, f'<p><a href="/all">The whole of this line is one link to the source of the story</a></p>'), (1, f"<p>{_LONG}</p></article>"),
     (0, '<div id="related"><p>Read also this other story of ours.</p></div>')),
    # pages that break off inside the article
    ((0, '<nav><a href="/a">Home</a></nav>'), (1, "<article><h1>Snow</h1>"), (1, f"<p>{_LONG}</p>"), (1, "<p>It melts.</p>"), (1, f"<p>{_LONG}")),
    ((0, '<div class="banner">Big sale of shoes this week only.</div>'), (1, "<article><h1>Rain again today</h1>"), (1, "<p>Wet.</p>")),
    ((0, "<header><a href='/'>Start</a></header>"), (1, f"<main><p>{_LONG}</p>"), (1, "<p>And so on.</p>"), (1, f"<p>{_LONG * 2}</p>"), (1, "<p>The end</p></main>")),
    ((1, "<article><h1>Only a title</h1></article>"), (0, "<footer>Imprint</footer>")),
    ((1, "<article><p>One line of text without any title here.</p></article>"), (0, '<div class="share">Share this with all of your friends today</div>')),
    # no names, the text last; headings and short lines between long ones
    ((0, '<div><a href="/">Front page</a></div>'), (0, '<div><a href="/w">Weather</a> <a href="/t">Traffic</a></div>'), (1, "<h1>The new road is open</h1>"), (1, f"<p>{_LONG}</p>"),
     (1, "<p>Nobody complained.</p>"), (1, f"<p>{_LONG * 2}</p>"), (1, f"<p>{_LONG}</p>")),
    ((0, '<ul><li><a href="/1">First</a></li><li><a href="/2">Second</a></li><li><a href="/3">Third</a></li></ul>'), (1, f"<p>{_LONG}</p>"), (1, "<h2>Second part</h2>"),
     (1, f"<p>{_LONG}</p>"), (1, f"<p>{_LONG}</p>"), (0, '<p><a href="/back">Back to the list of all stories</a></p>')),
    # text in sections and tables, menus that are lists of short links
    ((0, '<div id="menu"><p>Welcome to this site of many stories</p></div>'), (1, f"<section><h2>First part</h2><p>{_LONG}</p></section>"),
     (1, f"<section><h2>Last part</h2><p>{_LONG}</p><p>{_LONG}</p></section>"), (0, "<div role='contentinfo'>All rights reserved by the house</div>")),
    ((0, '<table><tr><td><a href="/1">News</a></td><td><a href="/2">Mail</a></td></tr></table>'), (1, f"<table><tr><td><p>{_LONG}</p><p>{_LONG * 2}</p></td></tr></table>"),
     (0, '<table><tr><td><a href="/3">Terms of use</a></td><td><a href="/4">Help</a></td></tr></table>')),
    # wrappers named after what they also hold: the text inside is the page's
    ((1, f'<div class="page has-sidebar"><article><h1>Roads</h1><p>{_LONG * 2}</p><p>Yes.</p>'), (0, '<p class="advert">Cheap cars for sale here.</p>'),
     (0, '<aside><p><a href="/1">Related roads</a></p><p><a href="/2">Other roads</a></p></aside></article>'), (0, '<div class="sidebar"><p>Popular soups of the week</p></div></div>'),
     (0, "<footer>Imprint</footer>")),
    ((0, '<div class="with-nav"><nav><a href="/a">Home</a></nav>'), (1, f"<h1>Snow</h1><p>{_LONG}</p>"), (0, '<p class="promo">Subscribe now for more of it.</p>'), (1, f"<p>{_LONG * 2}</p></div>"), (0, '<div class="footer">Imprint and terms of use</div>')),
    ((1, f'<article><h1>Study</h1><p>{_LONG}</p><section class="discussion"><h2>Discussion</h2><p>{_LONG}</p><p>So it is.</p></section></article>'),
     (0, f'<section class="comments"><p>{_LONG}</p></section>')),
    ((1, f'<div class="sidebar-layout"><main><p>{_LONG * 2}</p><p>The end.</p></main></div>'), (0, '<div class="banner">Big sale of boats this week.</div>')),
    ((0, '<div class="menu"><a href="/">Start</a></div>'), (1, f'<div id="navbar-page"><h1>Rain</h1><p>{_LONG * 3}</p><p>{_LONG * 3}</p><p>It stops.</p></div>'), (0, "<footer>Imprint</footer>")),
    ((1, f'<div class="sidebar-right"><p>{_LONG * 2}</p><p>{_LONG * 3}</p><p>Yes.</p></div>'), (0, '<div class="footer">Imprint</div>')),
    # links that are all of a paragraph or a list item of the article
    ((0, '<nav><a href="/a">Home</a></nav>'), (1, f'<article><p>{_LONG}</p><p><a href="/s">Read the source here</a></p><ul><li><a href="/1">First report</a></li><li><a href="/2">Second</a></li></ul>'),
     (1, '<p><a href="/3">Map</a> <a href="/4">Photos</a></p><p>Ends.</p></article>'), (0, '<div><a href="/5">Imprint</a></div>')),
    ((0, '<div><a href="/a">Home</a></div>'), (1, f'<div class="content"><p><a href="/s">Report of the council</a></p><p>{_LONG}</p><p><a href="/t">Table</a></p></div>'), (0, "<footer>Imprint</footer>")),
    # reader comments longer than the article, and a page of nothing else
    ((1, f"<article><p>{_LONG}</p></article>"), (0, f'<section id="comments"><h3>Comments</h3><p>{_LONG * 2}</p><p>{_LONG * 3}</p><p>I agree.</p><p>{_LONG}</p><p>{_LONG * 2}</p><p>No.</p></section>')),
    ((1, f"<div><h1>Hail</h1><p>{_LONG}</p></div>"), (0, f'<div class="comments"><p>{_LONG}</p><p>{_LONG * 2}</p><p>Yes.</p><p>{_LONG * 2}</p><p>{_LONG}</p></div>'), (0, "<footer>Imprint</footer>")),
    # a menu that is never closed before the article
    ((0, '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul>'), (1, f"<article><h1>Fog</h1><p>{_LONG}</p><p>Thick.</p>"), (0, "<aside><p>Other fog stories of the week</p></aside></article>")),
    # what a tag makes boilerplate is none of the text, whatever its length and place
    ((0, f"<nav><p>{_FERRY}</p></nav>"), (1, f"<div><p>{_LONG}</p><p>{_NEXT}</p></div>"), (0, f"<footer><p>{_FERRY} {_NEXT}</p></footer>")),
    ((0, f"<aside><p>{_LONG * 2}</p></aside>"), (1, f"<p>{_LONG}</p><p>{_FERRY}</p>"), (0, f"<form><p>{_LONG}</p></form>"), (0, f"<footer>{_NEXT}</footer>")),
    ((1, f"<article><p>{_LONG * 2}</p><p>{_FERRY}</p></article>"), (0, f"<footer>{_FERRY}</footer>")), ((1, f"<main><p>{_FERRY}</p></main>"), (0, f"<aside><p>{_LONG}</p></aside>"), (0, f"<footer>{_LONG}</footer>")),
    ((0, f"<header><p>{_FERRY}</p></header>"), (1, f"<div><p>{_LONG}</p><p>{_LONG}</p></div>"), (0, f"<footer><p>{_LONG}</p><p>{_FERRY}</p><p>{_NEXT}</p></footer>")),
    # the last line of an article, however short
    ((1, "<article><p>Only this</p></article>"),), ((1, "<main><p>So be it</p></main>"), (0, "<footer>Imprint</footer>")),
    ((1, f"<article><p>{_FERRY}</p><p>Again.</p></article>"),), ((1, f"<article><h1>Ice</h1><p>{_NEXT}</p><p>Perhaps.</p></article>"), (0, "<footer>Imprint</footer>")),
    ((1, f'<div id="content"><h2>Wind</h2><p>{_FERRY}</p><p>It blew</p></div>'), (0, "<footer>Imprint</footer>")), ((1, "<article><h2>Two</h2><p>Or three.</p></article>"),),
    # no names and no long block: sentences are text
    ((0, '<div><a href="/a">Start here</a></div>'), (1, f"<h1>Wind</h1><p>{_FERRY}</p>")),
    ((0, '<p><a href="/a">Home</a> <a href="/b">Mail</a></p>'), (1, f"<h1>Harbour</h1><p>{_FERRY}</p><p>{_NEXT}</p><p>{_NEXT} said the captain</p>"), (0, '<p><a href="/c">Next</a></p>')),
    ((0, '<div><a href="/a">Top</a></div>'), (1, f"<div>{_NEXT}</div><div>{_FERRY} {_NEXT}</div>"), (0, '<div><a href="/c">Help</a></div>'), (0, "<div>Terms of use</div>")),
    ((1, f"<h1>Ferry</h1><p>{_FERRY}</p><p>{_FERRY}</p>"), (0, '<p><a href="/c">Back</a></p>')),
    # no names: the same short lines are text between long blocks and not beside menus
    ((0, "<div>Today is Monday</div>"), (0, '<div><a href="/">Home</a> <a href="/n">News</a></div>'), (0, "<div>All about cities</div>"), (0, '<div><a href="/s">Sport</a></div>'),
     (1, f"<div>{_LONG}</div>"), (1, "<div>It was cold.</div>"), (1, f"<div>{_LONG * 2}</div>"), (1, "<div>Nobody came.</div>"), (1, f"<div>{_LONG}</div>"),
     (0, '<div><a href="/i">Imprint</a></div>'), (0, "<div>All rights reserved</div>")),
    ((0, "<p>Welcome back here</p>"), (0, '<p><a href="/1">Top</a> <a href="/2">New</a></p>'), (0, "<p>The city paper</p>"), (0, '<p><a href="/3">Mail</a></p>'), (1, f"<p>{_LONG}</p>"), (1, "<p>We waited.</p>"),
     (1, f"<p>{_LONG}</p>"), (1, "<p>All was still.</p>"), (1, f"<p>{_LONG * 3}</p>"), (0, '<p><a href="/4">Terms</a></p>'), (0, "<p>Printed in town</p>"), (0, '<p><a href="/5">Help</a></p>')),
    ((0, f'<div class="comment"><p>{_LONG}</p></div>'), (0, f'<div id="replies"><p>{_LONG * 2}</p><p>No.</p></div>'), (0, "<footer><p>Contact the office by mail.</p></footer>")),
)


class Tree:
    """A binary decision tree grown by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 9, least: int = 2):
        self.share = float(y.mean()) if len(y) else 0.0
        self.feature = None
        if depth == 0 or len(y) < 2 * least or self.share in (0.0, 1.0):
            return
        best = self._impurity(y) * len(y) - 1e-9
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                n = int(left.sum())
                if min(n, len(y) - n) < least:
                    continue
                score = self._impurity(y[left]) * n + self._impurity(y[~left]) * (len(y) - n)
                if score < best - 1e-9:
                    best, self.feature, self.cut = score, f, float(cut)
        if self.feature is not None:
            left = x[:, self.feature] <= self.cut
            self.low, self.high = Tree(x[left], y[left], depth - 1, least), Tree(x[~left], y[~left], depth - 1, least)

    @staticmethod
    def _impurity(y: np.ndarray) -> float:
        p = y.mean()
        return 2 * p * (1 - p)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature is None:
            return np.full(len(x), self.share >= 0.5)
        out, left = np.empty(len(x), bool), x[:, self.feature] <= self.cut
        out[left], out[~left] = self.low.predict(x[left]), self.high.predict(x[~left])
        return out


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of TABLE."""
    xs, ys = [], []
    for pieces in TABLE:
        starts = np.cumsum([0, *(len(h) for _, h in pieces)])
        page = blocks("<body>" + "".join(h for _, h in pieces) + "</body>")
        xs.append(features(page))
        ys += [pieces[int(np.searchsorted(starts, b.at - len("<body>"), side="right")) - 1][0] for b in page]
    return np.concatenate(xs), np.array(ys, float)


@functools.cache
def block_tree() -> Tree:
    return Tree(*labelled())


def main_text(page: str | None) -> str:
    """The kept blocks, one line each."""
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, block_tree().predict(features(found))) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, without a shuffle."""
    src = pages.select("page_id", "url", "html")
    kinds = dict(src.dtypes)

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in strings(batch, "html")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_arrow(src, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
