"""Main text of web pages by classifying flat text blocks with a small decision tree.

A page is read into flat blocks: runs of text between block-level tags. Each block has its number of words, its link
density, the same of its two neighbours, and marks for its place: inside furniture (menus, headers, footers,
sidebars, notices, adverts, forms, reader comments, told from tags, roles and class names of any element), inside an
article, heading, end of sentence. A decision tree over these features, grown on the labelled table below, keeps or
drops each block. Kept blocks are joined in page order. Where marks tell nothing, words and link densities of a block
and of its neighbours decide.

A class name of several words is told by its last word that is not a mere box (`share-price-article` is an article,
`sidebar-content` a sidebar); a name that says what there is not, or what the page has beside (`no-sidebar`,
`has-sidebar`), tells nothing.

Defined cases: null or empty html gives an empty text; scripts, styles, comments and unfinished tags are markup and
give none; unknown or missing end tags end at the end of what encloses them; character references are decoded after
markup is taken out; white space in a block becomes one space. Rows are independent, so repeated ids, extra columns
and empty tables need no care; a page is read whole, whatever its length, in time that grows with it.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from locusweave.llm.common import runs_on_executors, small_batches

runs_on_executors(__name__)
#: Element names and class words.
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = set("article aside blockquote button details dialog div dl fieldset figure footer form header main menu nav noscript ol section select table ul".split())
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
#: Block elements that the start of another block, or of one of these, ends.
ENDED_BY = {
    **dict.fromkeys("p h1 h2 h3 h4 h5 h6 address caption summary figcaption legend pre center body head html option optgroup".split(), None),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
}
SILENT = ("script", "style", "title", "textarea", "template", "iframe", "svg", "object", "noframes")
FURNITURE_TAGS = set("nav header footer aside form button select dialog menu noscript fieldset".split())
#: Words that mark furniture wherever they stand in a name, and words that do so as its last word only.
FURNITURE_ANYWHERE = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent popup modal overlay nav navbar navigation menubar breadcrumb breadcrumbs "
    "sidebar comments commentlist related recommended newsletter pagination pager masthead topbar".split()
)
FURNITURE_LAST = FURNITURE_ANYWHERE | set(
    "banner notice notices alert navigational menu side aside widget widgets footer header comment respond reply replies discussion share sharing social subscribe signup login search toolbar "
    "copyright legal disclaimer complementary contentinfo form tags dialog alertdialog".split()
)
ARTICLE_TAGS = {"article", "main"}
ARTICLE_WORDS = set("article post entry story content main maincontent body text".split())
#: Words of names that tell only of a box, and words of names that tell of the page and not of the element.
BOXES = set(
    "container wrapper wrap inner outer box block area section list item items link links row col column holder group panel unit slot top bottom left right region module component bar buttons button icons icon "
    "content body text main page site global primary secondary".split()
)
ABOUT_PAGE = set("no not non has have with without is hide hidden show js".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROWS_AT_ONCE = 512

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    furniture: bool
    article: bool
    heading: bool


def _kind(name: str) -> tuple[bool, bool]:
    """Does a class name, id or role mean furniture, or an article?"""
    words = [w.lower() for w in _WORD.findall(name.split("--")[0])]
    if not words or ABOUT_PAGE & set(words[:-1]):
        return False, False
    last = [w for w in words if w not in BOXES and not w.isdigit()] or words[-1:]
    article = last[-1] in ARTICLE_WORDS
    furniture = last[-1] in FURNITURE_LAST or (not article and bool(FURNITURE_ANYWHERE & set(words)))
    if last[-1] in ("header", "tags") and ARTICLE_WORDS & set(words):
        furniture = False  # an article's own
    return furniture, article


def _place(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """Does this element start furniture, or an article?"""
    if tag in ("html", "body"):
        return False, False
    furniture, article, names = False, tag in ARTICLE_TAGS, []
    if attributes:
        names = [n for m in _NAMES.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").split()]
        furniture = bool(_HIDDEN.search(attributes))
    kinds = [_kind(n) for n in names]
    article = article or any(a for _, a in kinds)
    for name, (f, _) in zip(names, kinds):
        if f and not ((inside_article or article) and name.lower() in ("header", "tags")):
            furniture = True
    if tag in FURNITURE_TAGS and not (tag == "header" and inside_article):
        furniture = True
    return furniture, article


class _Open:
    """The open elements that matter, with the marks of all that encloses them."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool]] = []
        self.count: Counter = Counter()
        self.inside: list[Counter] = [Counter()]  # elements opened since each open container

    def marks(self) -> tuple[bool, bool]:
        return self.stack[-1][1:] if self.stack else (False, False)

    def push(self, tag: str, furniture: bool, article: bool) -> None:
        f, a = self.marks()
        self.stack.append((tag, f or furniture, a or article))
        self.count[tag] += 1
        if tag in CONTAINERS:
            self.inside.append(Counter())
        else:
            self.inside[-1][tag] += 1

    def pop(self) -> str:
        tag = self.stack.pop()[0]
        self.count[tag] -= 1
        if tag in CONTAINERS:
            self.inside.pop()
        else:
            self.inside[-1][tag] -= 1
        return tag

    def start(self, tag: str) -> None:
        """End what the start of this block ends: marked text elements, and blocks that hold no such block."""
        while self.stack:
            top = self.stack[-1][0]
            ended = ENDED_BY.get(top, ())
            if top in CONTAINERS or top == "a" or (top in BLOCKS and ended is not None and tag not in ended):
                return
            self.pop()

    def end(self, tag: str) -> None:
        if self.count[tag]:
            while self.pop() != tag:
                pass

    def end_inline(self, tag: str) -> None:
        """End a text element, unless a container has been opened in it since."""
        if self.inside[-1][tag]:
            self.end(tag)


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page in order."""
    out: list[Block] = []
    opened = _Open()
    parts: list[tuple[str, bool]] = []
    link, heading = False, False
    at, n = 0, len(page)

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(t for t, _ in parts)).split())
            if text:
                linked = sum(len(html.unescape(t).split()) for t, a in parts if a)
                out.append(Block(text, len(text.split()), linked, *opened.marks(), heading))
            parts.clear()

    while at < n:
        found = page.find("<", at)
        if found < 0:
            parts.append((page[at:], link))
            break
        if found > at:
            parts.append((page[at:found], link))
        m = _TOKEN.match(page, found)
        if not m:
            parts.append(("<", link))
            at = found + 1
            continue
        at = m.end()
        ending, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in SILENT and not ending:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else n
            if tag in BLOCKS:
                close()
            continue
        if tag == "a":
            link = not ending
        if tag == "br":
            parts.append((" ", link))
        elif tag in BLOCKS:
            close()
            link = False
            if tag in HEADINGS:
                heading = not ending
            elif not ending:
                heading = False
            if ending:
                opened.end(tag)
            elif tag not in VOID:
                opened.start(tag)
                f, a = _place(tag, attributes, opened.marks()[1])
                if tag in CONTAINERS or f or a:
                    opened.push(tag, f, a)
        elif tag in VOID:
            pass
        elif ending:
            if opened.count[tag]:
                close()
                opened.end_inline(tag)
        else:
            # A text element of its own kind, as an advert in a span, is a block of its own.
            f, a = _place(tag, attributes, opened.marks()[1]) if attributes else (False, False)
            if f or opened.count[tag]:
                close()
                opened.push(tag, f, False)
    close()
    return out


FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "furniture", "article", "heading", "sentence")


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block."""
    words = np.array([b.words for b in found], float)
    density = np.array([min(1.0, b.linked / b.words) for b in found], float)
    before = lambda x: np.concatenate([[0.0], x[:-1]])
    after = lambda x: np.concatenate([x[1:], [0.0]])
    marks = [[b.furniture, b.article, b.heading, b.text[-1] in ".!?:;\"'”»)…"] for b in found]
    return np.column_stack([words, density, before(words), before(density), after(words), after(density), np.array(marks, float)])


#: The labelled table: pages whose main blocks start with "+". First those that are told in full.
PAGES = (
    '<nav><ul><li><a href=/>Home</a><li><a href=/n>News from the city</a></ul></nav><article><h1>+River rises</h1><p>+The river rose again during the night and the lower streets were closed to all traffic.</p><p>+Rain is expected.</p><p>+No.</p></article><footer>All rights reserved by the paper, 2020.</footer>',
    '<div class="ad">Buy the best boots in town today and pay half the price.</div><article><p>+Short one</p><p>+She walked along the wall until the light was gone, then turned back to the gate.</p><ul><li>+first point of three</li><li>+second</li></ul></article><div id=footer>Contact us or read our terms.</div>',
    '<header>The Daily Page, your home for news and opinion since 1901.</header><div id="content"><h2>+On bread</h2><p>+Flour, water, salt and time are all that a good loaf needs, and time is the one most often missing.</p><p>+Try <a href=x>this recipe</a> first.</p></div><div class="sidebar"><p>Popular: ten loaves that you can bake this weekend without any trouble at all.</p></div>',
    '<article><p>+Results were announced on Monday after a long count in the old town hall.</p><div class="share">Share this story</div><p>+The winner thanked everyone.</p><form>Your mail address, so that we can send you our news each week.</form></article><div class="comments"><p>I was there and it was not like this at all, the count took an hour.</p><p>Nonsense!</p></div>',
    '<div class="cookie-notice">We use cookies to make this site better for you and for our partners.</div><main><h1>+Rules</h1><p>+Players take turns.</p><p>+A turn ends when no piece can move.</p><table><tr><td>+Piece</td><td>+Points</td></tr></table></main><aside>Related games and more offers from our shop.</aside>',
    '<p><a href=1>Home</a> <a href=2>About</a> <a href=3>Contact</a></p><p>+A page without any marks still has long blocks of plain text that hold what its author wanted to say.</p><p>+They come one after another, with few links, and so the words around a block tell what it is.</p><p><a href=4>Next page</a> <a href=5>Previous page</a></p><p>Copyright</p>',
    '<p><a href=1>All stories</a></p><h1>+The long way home from the station</h1><p>+It took them most of the day, since the bridge was down and the ferry had stopped for the winter months.</p><p>+They sang.</p><p>+By evening the village was in sight, and somebody had lit the lamps along the road for them.</p><p><a href=2>Log in</a></p><p>Powered by pages</p>',
    '<div><a href=1>Sport</a></div><div><a href=2>Weather and traffic</a></div><div>+The council has agreed to plant two hundred trees along the main road before the end of spring, it said.</div><div>+Work will begin next week near the school and move north, street by street, until the station is reached.</div><div><a href=3>More about trees</a></div><div>Imprint</div>',
    '<article><header><h1>+A small house</h1><p>+By the lake, in autumn.</p></header><p>+<a href=1>The house</a> stood empty.</p><p>+Nobody knew for how long it had stood there by the lake, with its door open to the wind.</p><aside>Read more houses like this one in our archive of houses.</aside><footer>Filed under houses.</footer></article>',
    '<div class=menu><p>Start here, then see the list of all our many pages and choose the one you like.</p></div><div class="post"><p>+One</p><p>+Two words</p><p>+And then a longer sentence that goes on for a while before it ends.</p></div><div role="contentinfo">Some address in some street of some town.</div>',
    '<nav><a href=1>Start</a></nav><article><h1>+Cut short</h1><p>+This page ends before its markup does, which happens when a download stops in the middle of a line.</p><p>+The last block counts</p>',
    '<article><p>+Only one block.</p></article>',
    '<p>+There is nothing here but a single paragraph of some length, and it is what the page is about, so it stays.</p>',
    '<h1>+Notes</h1><p>+The meeting began at nine and went on until the evening without a break for anybody who was there.</p><p>+It was decided to meet again, and that the notes would be sent to all members within the week.</p>',
    '<p>Skip</p><p><a href=1>Home</a></p><article><h2>+Tin</h2><p>+Tin</p><p>+melts</p></article><p>Terms</p><p>Privacy</p>',
    '<div><a href=1>Ten ways to make your garden ready for the winter months</a></div><div><a href=2>Why the price of bread went up again in the spring</a></div><div>+The garden needs less work in autumn than most people think, and what it needs is soon done.</div><div><a href=3>What to do when a tree has fallen over the road</a></div>',
    '<p><a href=1>Read the report of the council about the new bridge and its cost</a></p><p>+The bridge will be longer than the old one, and it will have a path for those who walk.</p><p>+It opens in May.</p>',
    '<footer>This site is run by a small group of friends who like old maps, and all texts in it may be copied for any use that earns no money, if the source is named.</footer>',
    '<div class="cookie-banner">We and our partners store small files on your device so that this page works, and so that we can count who reads it and show what may be of use to you.</div><div id="main"><p>+Maps lie.</p><p>+They have to, since the world is round and paper is flat, and something must give when one is laid on the other.</p></div><div class="newsletter">Once a week we send a letter with the newest maps, the best of the old ones and a riddle, and you can stop it at any time with one click.</div>',
    '<aside class="sidebar"><h3>About the author</h3><p>The author has drawn maps for thirty years and has lost his way in most of the towns of the country, which he says is the best way to learn how they are laid out.</p></aside><p>+A legend explains the signs of a map, and it should be read before anything else is believed about it.</p><div class="comments"><p>My father had a map with a legend as long as my arm, and I learned to read from it one winter when the snow lay so high that nobody could go out.</p></div><footer><p>Printed with care in the town where it was written, by people who are paid fairly for what they do and who own the press that they print it with.</p></footer>',
    '<div class="advertisement">Our folding maps of strong paper fit in each pocket, survive rain and coffee, and cost less than two cups of it, so order today and walk away with a free pencil.</div><p>+Scale is the other thing to look at first, because without it a brook and a river are the same blue line on the page.</p>',
    '<article><h1>+<a href=/p/1>Where the old road ends</a></h1><p>+It ends at the sea.</p><p>+<a href=2>A long walk</a></p></article><article><h1>+<a href=/p/2>What the tide brings</a></h1><p>+Mostly wood and shells.</p></article>',
    '<p>+things found in the attic after the family had moved out and the house was sold to the town</p><p><a href=1>What the town did with the house and with all that was found in it</a></p><p>+a clock without hands, two letters that were never sent, and a map of an island that nobody knows</p>',
    '<div>Menu</div><article><p>+<a href=1>Linked</a></p><p>+It is said that the tower leans because the ground under it is soft on one side only.</p></article><div>Top</div>',
)


#: Parts of the other pages: links, blocks that are neither linked nor main text, sentences and short main blocks.
LINKS = (
    "Home", "About us", "All stories", "Log in or sign up", "Weather and traffic", "What the town did with the house", "Ten ways to make your garden ready for the winter", "Read the report of the council about the bridge",
    "Why the price of bread went up again this spring", "How to mend a clock that nobody else wants to look at any more", "Our readers' favourite walks along the coast, with maps, inns and the times of the last bus home",
    "See all twelve of our folding maps and choose the one that fits your pocket, your walk and your purse, before they are gone",
)
ASIDES = ("Menu", "Imprint", "Share", "Top", "Popular now", "Follow us", "Page 1 of 9", "More from this site", "Powered by pages", "Text size")
SENTENCES = (
    "The council has agreed to plant two hundred trees along the main road before the end of spring.", "It took them most of the day, since the bridge was down and the ferry had stopped for the winter months.",
    "The garden needs less work in autumn than most people think, and what it needs is soon done, if one begins early enough and does not mind the rain.", "Flour, water, salt and time are all that a good loaf needs.",
    "She walked along the wall until the light was gone, then turned back to the gate, where the others were still waiting for her with the lamp.", "By evening the village was in sight, and somebody had lit the lamps along the road for them.",
    "Nobody knew for how long the house had stood there by the lake, with its door open to the wind and its clock still going.", "A legend explains the signs of a map, and it should be read before anything else is believed about it.",
)
SHORT = ("No.", "They sang.", "It was late", "Two words", "She did not answer.", "And then, nothing.", "The second day", "Rain is expected.")


def _made_pages() -> list[str]:
    """Pages in which words and link densities of a block and its neighbours tell what it is, with and without an article's mark."""
    link = lambda k: f"<a href=/{k}>{LINKS[k % len(LINKS)]}</a>"
    rng, out = random.Random(4), []
    for k in range(36):
        text, short, aside = (lambda _, x=x: rng.choice(x) for x in (SENTENCES, SHORT, ASIDES))
        tag = ("p", "div", "li")[k % 3]
        block = lambda t: f"<{tag}>{t}</{tag}>"  # noqa: B023, E731
        partly = f"{text(3)[:-1]}, as {link(k)} says, and it will stay so for a long time to come."
        menu = [block(link(k + j)) for j in range(2 + k % 4)]
        body = [block("+" + text(0)), block("+" + short(0)), block("+" + text(1)), block(f"<a href=/>{rng.choice(LINKS[4:])}{'.' * (k % 3 > 0)}</a>"), block("+" + text(2)), block("+" + partly), block("+" + short(1)), block("+" + short(2)), block("+" + text(4)[:-1]), block("+" + text(6))]
        end = [block(link(k + 6)), block(aside(0)), block(f"{link(k + 7)} {link(k + 8)}"), block(aside(1)), block(link(k + 9))]
        if k % 2:
            out.append("".join([*menu, f"<h2>+{short(5)}</h2>", *body, *end]))
        else:
            out.append("".join([*menu, block(aside(2)), block(link(k + 1)), *body, *end]))
        # In an article a long link between two texts is an advert; a list of links, or a short one, is the author's.
        promo = block(f"<a href=/>{rng.choice(LINKS[7:])}{'.' * (k % 3 > 0)}</a>")
        own = [block("+" + link(rng.randrange(12))) for _ in range(4)]
        said = lambda: block("+" + rng.choice((text(0), short(0), text(0)[:-1])))  # noqa: B023, E731
        inner = [said() for _ in range(8)]
        inner[6:6] = [f"<ol>{''.join(own)}</ol>"] * (k % 3 != 0)
        inner[4:4] = [block("+" + link(k % 4))]
        inner[2:2] = [promo]
        out.append(f"<article><h1>+{(short(3), text(1)[:-1])[k % 2]}</h1>{''.join(inner[k % 3:])}</article>")
        # Furniture of any length around an article, and in it.
        ad, share, side, foot = (f"<div class={c}>" for c in ("ad", "share-box", "sidebar", "site-footer"))
        around = f"<nav><ul><li>{link(k)}<li>{link(k + 3)}<li>{aside(3)}</ul></nav>{ad}{(text(1), short(6))[k % 2]}</div>"
        within = f"{share}{(aside(4), short(7), text(2), link(k + 2))[k % 4]}</div><aside>{(text(3), aside(5), short(2))[k % 3]}</aside>"
        after = f"<div class=comments><p>{text(4)}</p><p>{short(1)}</p></div>{side}<p>{link(k + 4)}</p><p>{text(5)}</p></div>{foot}{(text(6), aside(6))[k % 2]}</div><footer>{(text(7), short(3))[k % 2]}</footer>"
        told = [f"<h1>+{(short(0), text(0)[:-1])[k % 2]}</h1>", *(f"<p>+{x}</p>" for x in (text(0), text(1), short(1), text(2), partly, text(4), short(4)))]
        told[3 + k % 4 : 3 + k % 4] = [within]
        out.append(around + f"<article>{''.join(told)}</article>" + after)
    return out


LABELLED = (*PAGES, *_made_pages())


@dataclass
class Tree:
    feature: list[int]
    cut: list[float]
    low: list[int]
    high: list[int]
    keep: list[bool]

    def predict(self, rows: np.ndarray) -> list[bool]:
        out = []
        for row in rows.tolist():
            k = 0
            while self.feature[k] >= 0:
                k = self.low[k] if row[self.feature[k]] <= self.cut[k] else self.high[k]
            out.append(self.keep[k])
        return out


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2) -> Tree:
    """A classification tree by Gini impurity; of equal splits the first feature and the lowest cut."""
    tree = Tree([], [], [], [], [])

    def impurity(t: np.ndarray) -> float:
        p = t.mean() if len(t) else 0.0
        return len(t) * 2 * p * (1 - p)

    def node(rows: np.ndarray, left: int) -> int:
        k = len(tree.feature)
        for part, value in ((tree.feature, -1), (tree.cut, 0.0), (tree.low, -1), (tree.high, -1), (tree.keep, bool(y[rows].mean() >= 0.5))):
            part.append(value)
        best = (impurity(y[rows]) - 1e-9, -1, 0.0)
        for f in range(x.shape[1]) if left and best[0] > 0 else ():
            values = np.unique(x[rows, f])
            for cut in (values[1:] + values[:-1]) / 2:
                under = x[rows, f] <= cut
                if min(under.sum(), (~under).sum()) >= least:
                    cost = impurity(y[rows][under]) + impurity(y[rows][~under])
                    if cost < best[0] - 1e-12:
                        best = (cost, f, float(cut))
        if best[1] >= 0:
            under = x[rows, best[1]] <= best[2]
            tree.feature[k], tree.cut[k] = best[1], best[2]
            tree.low[k] = node(rows[under], left - 1)
            tree.high[k] = node(rows[~under], left - 1)
        return k

    node(np.arange(len(y)), depth)
    return tree


def trained(pages=LABELLED) -> Tree:
    """The tree grown on the labelled table."""
    rows, marks = [], []
    for page in pages:
        found = blocks(page)
        mine = [b.text.startswith("+") for b in found]
        for b, m in zip(found, mine):
            b.text = b.text[m:]
        rows.append(features(found))
        marks += mine
    return grow(np.concatenate(rows), np.array(marks, float))


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    return "\n\n".join(b.text for b, keep in zip(found, tree.predict(features(found))) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> page_id, url, text, n_chars; a row per page."""
    tree = trained()
    types = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(a, ROWS_AT_ONCE)
                texts = [main_text(page, tree) for page in batch.column(2).to_pylist()]
                columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return small_batches(pages).select("page_id", "url", "html").mapInArrow(run, f"{types}, text string, n_chars long")
