"""Main text of web pages from flat text blocks, classified by a decision tree.

A page is read once, tag by tag, into blocks of text between block-level tags. Each has its words and link density, those of the blocks before and
after it, its tag, and where it stands: in an article, outside the page's article, or on a page without one; before or after the title; in an element that is furniture by its tag or
role; in one of several entries alike that begin or end with a short line, as readers' comments do. Names (classes and ids) are evidence of two kinds, of furniture that is
prose (adverts, comments) and of furniture that is links or a line or two (menus, shares, notices): all of a name's words or some of them, and together with the words and link density
of the element that has the name. Names of an element that holds the page's article or title and half of its words say nothing: it wraps the page.
A decision tree, grown from the labelled pages below, weighs these and tells which blocks are the main text; they are joined in page order, whole. Several of the labelled pages have such
names around text, so that no name decides alone.

Nulls: a null or empty page gives an empty text. Broken markup (unclosed or stray tags, comments, scripts) is read as far as it goes. Rows that
repeat a page_id are each extracted. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_columns

# HTML elements by what they do to a text.
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
HIDDEN = "script|style|noscript|template|head|title|textarea|select|svg|iframe|object|button|annotation|annotation-xml|canvas|audio|video"
FURNITURE = frozenset("nav footer aside form menu dialog fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINER = BLOCK - frozenset("p h1 h2 h3 h4 h5 h6 dd dt hr td th tr tbody thead tfoot option".split())
KIND = {"p": 2, "pre": 2, "blockquote": 2, **{f"h{i}": 3 for i in range(1, 7)}, "li": 1, "dd": 1, "dt": 1, "td": 1, "th": 1}
# Words in names of elements that hold prose beside the text, of elements that hold links or a line or two beside it, and of elements that hold anything.
PROSE = frozenset(
    "ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promoted comment comments commentlist respond disqus reply replies cookie cookies consent gdpr popup modal newsletter subscribe subscription signup".split()
)
BESIDE = frozenset(
    "nav navbar navigation menu menus masthead topbar toolbar breadcrumb breadcrumbs share sharing social related recommended recommendations login pagination pager tags skip search byline meta footer sidebar widget widgets "
    "notice notices alert banner overlay disclaimer copyright legal".split()
)
HOLDERS = frozenset("area bar block body box buttons btn container content div form group holder icons inner item items left links list main outer panel post posts right section site slot text thread top unit wrap wrapper".split())
ROLES = re.compile(r"^(?:navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu)$", re.I)
_PARTS = re.compile(r"[-_\s]+|(?<=[a-z])(?=[A-Z])")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][\w:-]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_HIDDEN_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in HIDDEN.split("|")}

#: Labelled pages: {+n} stands for n words of main text, {-n} for n words of anything else.
PAGES = (
    # an article element between menu, advert and footer
    "<body><nav><ul><li><a>{-1}</a></li><li><a>{-2}</a></li><li><a>{-1}</a></li></ul></nav><div class=ad>{-9}</div><article><h1>{+7}</h1><p>{+60}</p><p>{+8}</p><p>{+1}</p><p>{+35}</p></article><footer>{-12}</footer></body>",
    "<body><div class=ad>{-30}</div><article><h1>{+3}</h1><p>{+5}</p></article><footer>{-6} <a>{-2}</a></footer></body>",
    # furniture inside an article
    "<body><header><div class=logo><a>{-2}</a></div><nav><a>{-1}</a><a>{-1}</a></nav></header><main><article><header class=entry-header><h1>{+9}</h1><p class=byline>{+6}</p></header><p>{+45}</p><aside><p>{-25}</p></aside>"
    "<div class=ad-slot><p>{-14}</p></div><p>{+70}</p><ul><li>{+9}</li><li>{+4}</li><li>{+12}</li></ul><div class='share-buttons'><a>{-1}</a><a>{-1}</a></div><div class=related-posts><h3>{-2}</h3><a>{-8}</a></div>"
    "<form><p>{-5}</p></form><footer><a>{-1}</a><a>{-1}</a></footer></article></main><div id=comments><h2>{-2}</h2><p>{-40}</p><p>{-22}</p><p>{-7}</p></div><footer><p>{-15}</p></footer></body>",
    # names that say little, inside an article
    "<body><nav>{-2}</nav><article><div class=post-header><h1>{+8}</h1></div><div class=side-note><p>{+30}</p></div><div class=legal-text><p>{+55}</p><p>{+6}</p></div><div class=info><p>{+20}</p></div><p>{+18} <a>{+3}</a></p>"
    "<div class=search-results><p>{+28}</p></div><div class=meta>{+4}</div><p class=copyright>{+11}</p></article><div class=legal>{-14}</div></body>",
    # an element around the whole page with a name of furniture
    "<body class=has-sidebar><div class=tags-page><div class=header><a>{-3}</a></div><h1>{+6}</h1><p>{+50}</p><p>{+9}</p><p>{+33}</p><div class=footer>{-9}</div></div></body>",
    "<body><form><div class=menu><a>{-1}</a><a>{-1}</a><a>{-2}</a></div><h1>{+5}</h1><p>{+65}</p><p>{+40}</p><div class=footer><p>{-20}</p></div></form></body>",
    "<body><div class=widget-area><article class='post sponsored-free'><h1>{+6}</h1><p>{+80}</p><p>{+3}</p></article></div><div class=sidebar><h3>{-2}</h3><p>{-30}</p><li><a>{-4}</a></li></div></body>",
    # no article element
    "<body><div><a>{-1}</a> <a>{-1}</a> <a>{-2}</a></div><p>{+6}</p><p>{+60}</p><p>{+45}</p><div class=footer>{-8}</div></body>",
    "<body><div id=top><a>{-2}</a></div><ul><li><a>{-1}</a></li><li><a>{-1}</a></li><li><a>{-2}</a></li></ul><h1>{+5}</h1><p>{+4}</p><p>{+52}</p><h2>{+3}</h2><p>{+9}</p><p>{+31}</p><ul><li>{+6}</li><li>{+10}</li></ul><div>{-4} <a>{-5}</a></div></body>",
    "<body><table><tr><td><a>{-1}</a></td><td><a>{-2}</a></td></tr></table><div>{+75}</div><div>{+40} <a>{+4}</a></div><div>{+90}</div><div><a>{-3}</a> <a>{-2}</a></div></body>",
    "<body><div class=cookie-notice><p>{-35}</p></div><h1>{+8}</h1><p>{+28}</p><blockquote>{+15}</blockquote><pre>{+12}</pre><p>{+64}</p><div class=newsletter-signup><p>{-18}</p></div><section id=comments><p>{-33}</p><p>{-50}</p></section></body>",
    "<body><div>{-2}</div><div><a>{-1}</a></div><h1>{+4}</h1><p>{+7}</p><p>{+12}</p><p>{+5}</p><div><a>{-6}</a></div><div><a>{-5}</a></div><div>{-3}</div></body>",
    "<body><p>{+3}</p><p>{+50}</p></body>",
    "<body><p>{+70}</p></body>",
    "<p>{+12}</p><p>{+45}</p><p>{+20}</p>",
    "<body>{+120}</body>",
    "<body><h1>{+4}</h1><p>{+25}</p><p>{+2}</p></body>",
    "<body><div>{+60}</div><div>{+80}</div></body>",
    "<body><div>{-3}</div><div><a>{-2}</a></div><p>{+30}</p><p>{+4}</p></body>",
    "<body><p>{+40}</p><p>{+6}</p><div><a>{-1}</a> <a>{-1}</a></div></body>",
    "<body><div><p>{+9}</p><p>{+33}</p></div><div>{-5}</div></body>",
    "<body><div>{-4}</div><h1>{+6}</h1><p>{+19}</p><p><a>{-4}</a></p><div>{-6}</div></body>",
    "<body><ul><li><a>{-2}</a></li><li><a>{-1}</a></li></ul><h2>{+5}</h2><p>{+14}</p><p>{+36}</p><ul><li><a>{-4}</a></li><li><a>{-6}</a></li></ul></body>",
    "<body><article><p>{+6}</p></article></body>",
    "<body><article>{+22}</article><div>{-3}</div></body>",
    "<body><nav><a>{-1}</a></nav><article><p>{+4} <a>{+9}</a></p><p>{+2}</p></article></body>",
    # text in plain elements, and furniture in paragraphs: the blocks before and after tell
    "<body><div><a>{-2}</a></div><div>{-2}</div><div><a>{-1}</a></div><div>{+40}</div><div>{+7}</div><div>{+55}</div><div>{+5}</div><div>{+30}</div><div><a>{-3}</a></div><div>{-2}</div></body>",
    "<body><div>{+33}</div><div>{+3}</div><div>{+46}</div><div>{+9}</div><div>{+28}</div><div><a>{-2}</a></div><div>{-4}</div><div><a>{-1}</a></div></body>",
    "<body><p><a>{-2}</a></p><p>{-3}</p><p><a>{-3}</a></p><p>{-2}</p><p><a>{-1}</a></p><p>{+44}</p><p>{+6}</p><p>{+38}</p><p><a>{-2}</a></p><p>{-5}</p><p><a>{-4}</a></p></body>",
    "<body><ul><li><a>{-1}</a></li><li>{-2}</li><li><a>{-2}</a></li><li>{-1}</li><li><a>{-1}</a></li></ul><div>{+52}</div><ul><li>{+5}</li><li>{+8}</li><li>{+4}</li></ul><div>{+37}</div></body>",
    "<body><table><tr><td><a>{-2}</a></td><td>{-1}</td><td><a>{-1}</a></td></tr><tr><td>{+62}</td></tr><tr><td>{+8}</td></tr><tr><td>{+47}</td></tr></table><p><a>{-2}</a></p><p>{-4}</p></body>",
    # an article of many short blocks and links
    "<body><nav><a>{-1}</a></nav><article><h1>{+4}</h1><p>{+2}</p><p>{+50}</p><p><a>{+3}</a></p><p>{+1}</p><p><a>{+4}</a></p><p>{+30}</p><div>{+2}</div><div>{+12}</div><div><a>{+5}</a></div><div>{+1}</div><div>{+40}</div><p>{+3}</p></article><div><a>{-2}</a></div></body>",
    "<body><article><div><a>{+2}</a></div><div>{+3}</div><div><a>{+1}</a></div><p>{+1}</p><p><a>{+2}</a></p><p>{+6}</p><ul><li><a>{+2}</a></li><li>{+1}</li><li><a>{+1}</a></li><li>{+22}</li></ul><div>{+25}</div><div><a>{+7}</a></div></article><div>{-2}</div></body>",
    "<body><div><a>{-3}</a></div><main><div>{+2}</div><div>{+1}</div><p>{+5}</p><p>{+1}</p><p>{+3}</p><div>{+9}</div><div><a>{+2}</a></div><p>{+15}</p><p><a>{+6}</a></p></main><div><a>{-1}</a></div><div>{-3}</div></body>",
    "<body><article><div>{+5}</div><p>{+40}</p></article></body>",
    "<body><article>{+4}<p>{+30}</p><div>{+6}</div></article><div>{-5}</div></body>",
    "<body><main><ul><li>{+3}</li><li>{+9}</li></ul></main></body>",
    "<body><div>{-4}</div><p>{+21}</p></body>",
    # comments in elements of their own, longer than the text
    "<body><main><h1>{+6}</h1><p>{+30}</p><p>{+26}</p></main><div class=comments-area><article class=comment><p>{-60}</p></article><article class=comment><p>{-45}</p></article><article class=comment-body><p>{-8}</p></article></div></body>",
    "<body><article><h1>{+4}</h1><p>{+20}</p><section class=commentlist><div class=comment>{-38}</div><div class=comment><p>{-16}</p></div></section></article><div class=sidebar-left><p>{-24}</p><a>{-2}</a></div></body>",
    # columns, tables and lists of links that are the text
    "<body><nav><a>{-1}</a><a>{-1}</a></nav><article><h1>{+5}</h1><div class=columns><div class=col><p>{+24}</p><p>{+30}</p></div><div class=col><p>{+3}</p><p>{+27}</p></div></div><table><tr><th>{+1}</th><th>{+2}</th></tr><tr><td>{+3}</td><td>{+1}</td></tr></table>"
    "<ul><li><a>{+6}</a></li><li><a>{+3}</a> {+5}</li></ul><figure><figcaption>{+11}</figcaption></figure><dl><dt>{+1}</dt><dd>{+13}</dd></dl></article></body>",
    "<body><div role=banner>{-4}</div><div role=main><h1>{+3}</h1><p>{+38}</p><p>{+10}</p></div><div role=complementary><p>{-28}</p></div><div hidden><p>{-15}</p></div><div role=contentinfo>{-7}</div></body>",
    # names of furniture around text, in an article and on pages without one
    "<body><nav><a>{-1}</a><a>{-2}</a></nav><article><h1>{+5}</h1><div class=notice-period><p>{+24}</p><p>{+31}</p></div><div class=menu><p>{+18}</p><p>{+27}</p></div><section id=share><p>{+40}</p></section><div class='share-links'><a>{-1}</a> <a>{-1}</a></div></article><footer>{-9}</footer></body>",
    "<body><div class=topbar><a>{-2}</a></div><main><h1>{+4}</h1><p>{+15}</p><div class=banner-text><p>{+22}</p></div><section class=related-work><p>{+33}</p><p>{+12}</p></section><div id=navigation><p>{+29}</p></div><ul class=tags><li><a>{-1}</a></li><li><a>{-1}</a></li></ul></main><div class=ads>{-12}</div></body>",
    "<body><article><h1>{+6}</h1><div class=ad>{-11}</div><p>{+30}</p><div class='sponsored box'><p>{-24}</p></div><div class=comment-box><p>{-22}</p></div><p>{+26}</p><div class=comments><h3>{-2}</h3><div><p>{-31}</p></div></div></article></body>",
    "<body><article><h1>{+6}</h1><div class=search-method><p>{+14}</p></div><div class=cookie-dough><p>{+20}</p><p>{+9}</p></div><div class=social><p>{+21} {+14}</p></div><div class=search><a>{-1}</a></div></article></body>",
    "<body><div class=menu-bar><a>{-1}</a><a>{-1}</a></div><h1>{+4}</h1><div class=alert-levels><p>{+19}</p><p>{+28}</p></div><p>{+35}</p><div class=social-history><p>{+23}</p></div><div class=footer-links><a>{-1}</a><a>{-2}</a></div></body>",
    "<body><h1>{+3}</h1><div class=tags-explained><p>{+26}</p></div><p>{+13}</p><div class=advert><p>{-17}</p></div><p>{+41}</p><div class=newsletter-box><p>{-13}</p></div></body>",
    "<body><article><h1>{+4}</h1><div id=alert><p>{+30}</p><p>{+22}</p></div><div class=notice><p>{-9}</p></div><p>{+17}</p><div class=subscription-model><p>{+25}</p></div><div class=overlay-network><p>{+11}</p><p>{+16}</p></div></article><div class=modal><p>{-21}</p></div></body>",
    # adverts and notices without names, beside an article
    "<body><div><a>{-1}</a> <a>{-1}</a></div><div><p>{-24}</p></div><article><h1>{+5}</h1><p>{+37}</p><p>{+12}</p></article><div><p>{-18}</p><p>{-7}</p></div><p>{-31}</p><div>{-45}</div></body>",
    "<body><p>{-12}</p><main><h1>{+4}</h1><p>{+21}</p></main><section><h2>{-3}</h2><p>{-40}</p><p>{-52}</p></section><h3>{-2}</h3><ul><li>{-9}</li><li><a>{-4}</a></li></ul></body>",
    # entries alike after the text, with a line of a name and a day: comments
    "<body><article><h1>{+5}</h1><p>{+44}</p><p>{+30}</p></article><div><div class=c><b>{-2}</b><p>{-33}</p></div><div class=c><b>{-3}</b><p>{-12}</p><p>{-20}</p></div><div class=c><b>{-1}</b><p>{-6}</p></div></div></body>",
    "<body><div><a>{-1}</a> <a>{-1}</a></div><h1>{+6}</h1><p>{+40}</p><p>{+52}</p><div><div class=x><span>{-2}</span><p>{-25}</p></div><div class=x><span>{-2}</span><p>{-14}</p></div></div></body>",
    "<body><h1>{+4}</h1><p>{+31}</p><p>{+18}</p><ul><li><b>{-2}</b><p>{-22}</p></li><li><b>{-1}</b><p>{-9}</p></li><li><b>{-2}</b><p>{-41}</p></li></ul></body>",
    "<body><h1>{+7}</h1><p>{+55}</p><ol><li><div>{-3}</div><div>{-28}</div></li><li><div>{-2}</div><div>{-11}</div></li></ol><div>{-4}</div></body>",
    "<body><h1>{+3}</h1><p>{+26}</p><p>{+34}</p><section><div class=m><p>{-19}</p><i>{-3}</i></div><div class=m><p>{-27}</p><i>{-3}</i></div></section></body>",
    # steps and columns alike within an article are text
    "<body><article><h1>{+3}</h1><p>{+12}</p><div class=step><b>{+2}</b><p>{+15}</p></div><div class=step><b>{+2}</b><p>{+9}</p></div><div class=step><b>{+2}</b><p>{+21}</p></div></article></body>",
    "<body><main><h1>{+5}</h1><ul><li><b>{+1}</b><p>{+17}</p></li><li><b>{+2}</b><p>{+24}</p></li></ul><p>{+33}</p></main><div><div class=y>{-2}<p>{-15}</p></div><div class=y>{-2}<p>{-30}</p></div></div></body>",
    # short pages without an article
    "<body><h1>{+3}</h1><ol><li>{+5}</li><li>{+7}</li><li>{+4}</li></ol></body>",
    "<body><h1>{+4}</h1><p>{+6}</p><p>{+5}</p><p>{+8}</p></body>",
    "<body><h1>{+2}</h1><p>{+4}</p><p>{+3}</p></body>",
    "<body><h1>{+5}</h1><p>{+25}</p><p><a>{-5}</a></p><p><a>{-6}</a></p></body>",
    "<body><h1>{+4}</h1><p>{+17}</p><div><a>{-4}</a></div><div><a>{-7}</a></div><div><a>{-3}</a></div></body>",
    "<body><p>{+8}</p><p>{+6}</p><p>{+11}</p></body>",
    "<body><h2>{+3}</h2><p>{+9}</p><h2>{+2}</h2><p>{+7}</p><ul><li>{+3}</li><li>{+2}</li><li>{+5}</li></ul></body>",
    "<body><ul><li><a>{-1}</a></li><li><a>{-1}</a></li></ul><h1>{+3}</h1><ul><li>{+4}</li><li>{+6}</li><li>{+3}</li><li>{+8}</li></ul><p>{+5}</p></body>",
    "<body><h1>{+4}</h1><p>{+14}</p><dl><dt>{+1}</dt><dd>{+6}</dd><dt>{+2}</dt><dd>{+4}</dd></dl><table><tr><td>{+2}</td><td>{+1}</td></tr><tr><td>{+1}</td><td>{+3}</td></tr></table></body>",
    "<body><div><a>{-1}</a> <a>{-2}</a></div><div>{-3}</div><h1>{+5}</h1><p>{+7}</p><p>{+4}</p><div>{-5} <a>{-2}</a></div></body>",
    "<body><h1>{+4}</h1><p>{+2}</p><p>{+19}</p><p>{+3}</p><p>{+1}</p><p>{+2}</p></body>",
    "<body><ul><li><a>{-1}</a></li><li>{-2}</li><li><a>{-2}</a></li></ul><h1>{+2}</h1><p>{+3}</p><p>{+2}</p><h2>{+2}</h2><p>{+3}</p><ul><li>{+1}</li><li>{+2}</li><li>{+3}</li></ul><p>{+2}</p></body>",
    "<body><p>{-2}</p><p><a>{-1}</a></p><p>{-3}</p><h1>{+4}</h1><p>{+3}</p><p>{+22}</p><p>{+2}</p></body>",
    "<body><h2>{+4}</h2><p>{+3}</p><p>{+12}</p><p>{+2}</p><ol><li>{+3}</li><li>{+2}</li><li>{+3}</li></ol></body>",
    "<body><h1>{+5}</h1><div>{+14}</div><div>{+3}</div><div>{+30}</div><div>{+2}</div><div>{+17}</div></body>",
    "<body><div>{-2}</div><h1>{+3}</h1><div>{+4}</div><div>{+6}</div><div>{+9}</div></body>",
    "<body><div class=notice-box><p>{-16}</p></div><h1>{+4}</h1><p>{+20}</p><div class=alert>{-8}</div><p>{+26}</p><div class=copyright><p>{-10}</p></div></body>",
    "<body><article><h1>{+4}</h1><p>{+11}</p><div class=banner><p>{+34}</p><p>{+28}</p></div><div class=sidebar><p>{-12}</p><a>{-3}</a></div><div class=footer><p>{-7}</p></div></article></body>",
    "<body><article><h1>{+5}</h1><p>{+27}</p><div class=ad-unit><p>{-33}</p></div><div class=advertising-law><p>{+24}</p></div><div class=comment-threads><p>{+25}</p></div><div class=cookies><p>{-19}</p></div></article></body>",
    "<body><h1>{+3}</h1><p>{+21}</p><div class=subscription-prices><p>{+19}</p></div><div class=consent-forms><p>{+30}</p><p>{+11}</p></div><div class=consent><p>{-14}</p></div></body>",
)


@dataclass
class Node:
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None
    value: bool = False

    def __call__(self, x: tuple[float, ...]) -> bool:
        node = self
        while node.feature >= 0:
            node = node.low if x[node.feature] <= node.cut else node.high
        return node.value


def grow(table: np.ndarray, depth: int = 16) -> Node:
    """A tree by Gini impurity; the last column is the class. Ties go to the earlier feature and cut."""
    y = table[:, -1] > 0
    node = Node(value=bool(2 * y.sum() >= len(y)))
    if depth == 0 or y.all() or not y.any():
        return node
    best = 1e-9
    impurity = lambda k, n: k * (n - k) / n if n else 0.0
    whole = impurity(y.sum(), len(y))
    for f in FIRST:
        values = np.unique(table[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = table[:, f] <= cut
            gain = whole - impurity(y[low].sum(), low.sum()) - impurity(y[~low].sum(), (~low).sum())
            if gain > best + 1e-9:
                best, node.feature, node.cut = gain, f, float(cut)
    if node.feature >= 0:
        low = table[:, node.feature] <= node.cut
        node.low, node.high = grow(table[low], depth - 1), grow(table[~low], depth - 1)
    return node


def labelled(pages: tuple[str, ...] = PAGES) -> np.ndarray:
    """Features of all blocks of the labelled pages, and whether they are main text."""
    rows = []
    for page in pages:
        page = re.sub(r"\{([+-])(\d+)\}", lambda m: m[1] + " ".join(["word"] * int(m[2])), page)
        found = blocks(page)
        rows += [(*x, found[i].text.startswith("+")) for i, x in enumerate(features(found))]
    return np.array(rows, float)


def trained() -> Node:
    return grow(labelled())


def _name_says(value: str) -> tuple[int, int]:
    """How much a class or an id speaks for prose, and for anything else, beside the text: 2 if a word of it is made of such parts alone, 1 if one has such a part, else 0."""
    prose = links = 0
    for word in value.split():
        parts = [p.lower() for p in _PARTS.split(word) if p and not p.isdigit()]
        for kind, found in ((PROSE, 0), (BESIDE, 1)):
            if any(p in kind for p in parts):
                says = 2 if all(p in PROSE or p in BESIDE or p in HOLDERS for p in parts) else 1
                prose, links = (max(prose, says), links) if not found else (prose, max(links, says))
    return prose, links


@dataclass
class Element:
    """A container, or an element whose name speaks."""

    parent: int
    like: tuple[str, ...]  # its tag and classes
    furniture: bool = False
    prose: int = 0
    links: int = 0
    may_wrap: bool = False
    holds: bool = False  # the article or the title is in it
    heading: bool = False
    words: int = 0
    linked: float = 0.0

    @property
    def speaks(self) -> bool:
        return self.furniture or self.prose > 0 or self.links > 0


def _element(name: str, attributes: str, parent: int, in_article: bool) -> Element:
    out = Element(parent, (name,))
    if name in FURNITURE or (name == "header" and not in_article):
        out.furniture, out.may_wrap = True, name == "form"
        return out
    out.may_wrap = True
    if attributes and name != "html":
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").strip()
            if (key == "role" and ROLES.match(value)) or key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                out.furniture, out.may_wrap = True, False
                return out
            if key == "class":
                out.like += tuple(sorted(value.split()))
            if key in ("class", "id") and name != "body":
                prose, links = _name_says(value)
                out.prose, out.links = max(out.prose, prose), max(out.links, links)
    return out


@dataclass
class Block:
    """A block of text, and the numbers of the elements around it, the outermost first."""

    text: str
    words: int
    density: float
    kind: int
    article: int
    around: tuple[int, ...]
    titled: int = 0
    furniture: bool = False
    prose: int = 0
    links: int = 0
    named_words: int = 0
    named_density: float = 0.0
    alike: int = 0


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    elements: list[Element] = []
    stack: list[tuple[str, tuple[int, ...], bool]] = []  # open containers: name, elements around, article
    around: tuple[int, ...] = ()
    article, own, kind, in_link, titles = False, (), 0, 0, []
    parts: list[str] = []
    links: list[str] = []

    def close() -> None:
        nonlocal own, kind
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                n = text.count(" ") + 1
                linked = len(unescape(" ".join(links)).split()) if links else 0
                out.append(Block(text, n, min(1.0, linked / n), kind, 2 * article, (*around, *own)))
            parts.clear()
            links.clear()
        own, kind = (), 0

    def leave(name: str, until: tuple[str, ...] = ()) -> None:
        """Ends the innermost open container of a name, and all in it; not past one of the others."""
        nonlocal around, article, in_link
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                del stack[i:]
                around, article = (stack[-1][1], stack[-1][2]) if stack else ((), False)
                in_link = 0
                return
            if stack[i][0] in until:
                return

    def say(text: str) -> None:
        if text:
            parts.append(text)
            if in_link:
                links.append(text)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        if m[2] is not None and "<" in m[3] and (loose := _LOOSE.match(page, m.start())) and loose.end() < m.end():
            m = loose  # a quote that isn't closed in its tag
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if name == "a":
                in_link = max(0, in_link - 1)
            elif name in BLOCK:
                close()
                if name in CONTAINER:
                    leave(name)
            continue
        if name in _HIDDEN_END:
            if name in ("head", "svg") and m[3].endswith("/"):
                continue
            end = _HIDDEN_END[name].search(page, at)
            # a head's elements hide themselves; one that isn't closed must not hide the page
            at = end.end() if end else at if name == "head" else size
            if name != "head":
                parts.append(" ")
        elif name == "br":
            say(" ")
        elif name == "a":
            in_link = 1
        elif name in BLOCK:
            close()
            if name == "li":
                leave("li", ("ul", "ol", "menu"))  # one that wasn't closed
            e = _element(name, m[3], around[-1] if around else -1, article)
            container = name in CONTAINER and name not in VOID
            mine: tuple[int, ...] = ()
            if container or e.speaks:
                mine = (len(elements),)
                elements.append(e)
            if name in ("article", "main", "h1") and e.prose < 2:
                for i in (*around, *(mine if name != "h1" else ())):
                    elements[i].holds = True
            if name[0] == "h" and name[1:].isdigit():
                for i in around:
                    elements[i].heading = True
                if name == "h1":
                    titles.append(len(out))
            if container:
                around, article = (*around, *mine), article or name in ("article", "main") or bool(re.search(r"\brole\s*=\s*[\"']?main\b", m[3], re.I))
                stack.append((name, around, article))
                kind = KIND.get(name, 0)
            else:
                own, kind = mine, KIND.get(name, 0)
    close()
    _place(out, elements, titles)
    return out


def _place(out: list[Block], elements: list[Element], titles: list[int]) -> None:
    """Tells the blocks what their surroundings say."""
    total = 0
    within: dict[int, list[int]] = {}
    for k, b in enumerate(out):
        total += b.words
        for i in b.around:
            elements[i].words += b.words
            elements[i].linked += b.words * b.density
            within.setdefault(i, []).append(k)
    quiet = [e.may_wrap and e.holds and 2 * e.words >= total for e in elements]
    entries: dict[tuple, list[int]] = {}
    for i, held in within.items():
        e = elements[i]
        short = lambda b: b.words <= SHORT_LINE and b.text[-1] not in ".!?:;,"
        if e.like[0] in ENTRY and not e.heading and len(held) > 1 and (short(out[held[0]]) or short(out[held[-1]])) and max(out[k].words for k in held) > 2:
            entries.setdefault((e.parent, e.like), []).append(i)
    alike = {i: min(3, len(found)) for found in entries.values() if len(found) > 1 for i in found}
    somewhere = any(b.article for b in out)
    for k, b in enumerate(out):
        speaking = [elements[i] for i in b.around if elements[i].speaks and not quiet[i]]
        b.furniture = any(e.furniture for e in speaking)
        b.prose, b.links = max((e.prose for e in speaking), default=0), max((e.links for e in speaking), default=0)
        if named := [e for e in speaking if e.prose or e.links]:
            inner = max(named, key=lambda e: (max(e.prose, e.links), e.words))
            b.named_words, b.named_density = inner.words, inner.linked / max(1, inner.words)
        b.alike = max((alike.get(i, 0) for i in b.around), default=0)
        b.article = b.article if somewhere else 1
        b.titled = 1 if not titles else 2 if k >= titles[0] else 0


#: Containers that can be one of several entries alike; words that a line of a name and a day has at most.
ENTRY, SHORT_LINE = frozenset(("div", "li", "article", "section")), 6
#: What features() gives, by name; a split of equal gain goes to the one that comes first in FIRST.
NAMES = ("words", "density", "words before", "density before", "words after", "density after", "furniture", "article", "kind", "prose name", "beside name", "named words", "named density", "alike", "titled")
FIRST = (6, 7, 1, 13, 0, 12, 9, 10, 11, 8, 14, 3, 5, 2, 4)


def features(found: list[Block]) -> list[tuple[float, ...]]:
    """Per block: words and link density, those of the block before and after, and what its surroundings say."""
    ends = [(0, 0.0), *((b.words, b.density) for b in found), (0, 0.0)]
    return [(b.words, b.density, *ends[i], *ends[i + 2], b.furniture, b.article, b.kind, b.prose, b.links, b.named_words, b.named_density, b.alike, b.titled) for i, b in enumerate(found)]


def main_text(page: str | None, tree: Node) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, x in zip(found, features(found), strict=True) if tree(x))


def extract(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", *more: str) -> DataFrame:
    """Per row: the id, the further columns asked for, and text."""
    tree = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x, tree) for x in b.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*b.schema.names[:-1], "text"])

    rows = own_columns(pages, id_column, *more, html_column).withColumnRenamed(html_column, "_html").withColumn("_html", F.col("_html").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, schema + ", text string")
