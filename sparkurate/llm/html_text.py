"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page is scanned into words and tags. Each has a score: the log odds of its kind inside and outside of
the article on labelled pages (TRAINING). A word's kind is the element it stands in, whether it is part
of a link, and whether it is the article's own: in the page's article element (main, if it has none), or
beside a title or a paragraph of some length. Words of a paragraph and an article's own links score
positive, other links and their tags negative. One linear scan finds the contiguous stretch with the
greatest sum. From it, elements that are never the article's text are left out (ASIDE, and elements whose
class, id or role as a whole says so: NOTES), and its blocks are written out.

Character references are decoded, white space in a block is one space, blocks are joined by an
empty line. A null or empty page, and one where nothing scores, gives the empty text. Unclosed
elements end with the page; a tag that the page's end cuts off is no text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, prepare

# A quote belongs to a value only behind "=". Nothing is tried twice: repeats are possessive, so a tag is read in one go.
_VALUE = r"\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>\"'][^\s>]*+))?+"
_ATTRIBUTE = re.compile(rf"([^\s/>=][^\s/>=]*+)(?:{_VALUE})?+")
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[^\s/>=][^\s/>=]*+(?:{_VALUE})?+|[\s/=])*+)(?P<closed>>?)")
RAW = frozenset("script style noscript template textarea title iframe svg".split())  # what they hold is no page text
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for tag in RAW}
_EMPTY = re.compile(r"(?:^|[\s\"'])/$")  # a slash that ends the tag, not the value before it
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)

# Elements of HTML by what they are for.
ASIDE = frozenset("nav header footer aside form button select option input label menu dialog head object embed canvas".split())
BLOCK = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html legend li main ol p pre section summary table tbody tfoot thead tr ul".split()) | ASIDE
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role that mark what is not the article.
NOTES = frozenset("ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs byline comment comments cookie cookies consent disqus footer header hidden masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promos promoted promotion recommended related replies reply respond share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags toc toolbar widget widgets complementary contentinfo search sitemap".split())

#: Words that say where or what part of a note something is: a name of these and NOTES alone is a note's, as main-nav or related-posts.
PLACES = frozenset("site page global main top bottom left right primary secondary sticky floating mobile desktop list box bar block area wrap wrapper container section item items link links icon icons button buttons form posts articles stories more slot unit cloud panel".split())
#: Words of NOTES that are no heading's: ids of sections are made from headings.
NO_TOPIC = frozenset("ad ads adv advert adverts breadcrumb breadcrumbs comments disqus masthead navbar newsletter pager popup promo promos replies respond sidebar sidebars signup".split())
#: What holds the page or names its parts is never left out for its names, and the page's frame for no reason.
FRAME = frozenset(["html", "body"])
HOLDERS = FRAME | frozenset(["main", "article"]) | HEADING
#: Elements whose id is the page's own and not an anchor.
CONTAINERS = frozenset("div ul ol dl table center fieldset details".split())
_SHOWN = re.compile(r":(?:block|flex|grid|inline|table|contents)")


class _Node:
    __slots__ = ("tag", "aside", "kind", "note", "own", "block", "prose", "barred")

    def __init__(self, tag: str, aside: bool, kind: str, note: str = "", own: bool = False, block: _Node | None = None, barred: bool = False):
        self.tag, self.aside, self.kind, self.note, self.own = tag, aside, kind, note, own
        self.barred = barred or note == "hidden" or tag in ASIDE  # no wrapper with a mistaken name, but left out for what it is
        self.block = block or self  # the block that text here stands in; a paragraph's and a title's is the one around it
        self.prose = 0  # words of its text and paragraphs, without links

    def holds(self, tag: str) -> bool:
        """Whether an element here is the article's: in its element, or beside the title or a paragraph of some length."""
        return self.own or (tag not in PARTS and self.prose >= PROSE)


#: Elements that are the article's only within its element, not for what stands beside them.
PARTS = frozenset("article body div html main section".split())
#: Blocks whose links stand in a text.
FLOW = frozenset("p blockquote pre dd figcaption h1 h2".split())
HEADS = ("h2", "heading", "h2 link")  # kinds of text that heads what follows, so nothing ends with it
HOLDING = frozenset(["article", "main", "body", "table"])
PROSE = 10  # words that make what stands beside them an article's


def _words(name: str) -> list[str]:
    return [w for w in re.split(r"[\s_-]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w]


def _names_note(words: list[str]) -> bool:
    """Whether a name is a note's as a whole: sidebar or main-nav, not has-sidebar, overflow-hidden or related-work."""
    return any(w in NOTES for w in words) and all(w in NOTES or w in PLACES for w in words)


def _is_note(tag: str, attributes: str) -> str:
    """Why an element is left out, if its attributes say so: hidden, header (it may hold the title) or note."""
    if not attributes or tag in FRAME:
        return ""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in reversed(list(_ATTRIBUTE.finditer(attributes)))}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(found.get("style", "")):
        return "hidden"
    if tag in HOLDERS:
        return ""
    classes = found.get("class", "")
    names = [_words(c) for c in classes.split() if not (c == "hidden" and _SHOWN.search(classes))]
    names += [_words(found.get(k, "")) for k in ("role", "aria-label")]
    own = _words(found.get("id", ""))
    if tag in CONTAINERS and ["section"] not in names or not NO_TOPIC.isdisjoint(own):
        names.append(own)
    notes = [n for n in names if _names_note(n)]
    return "" if not notes else "header" if all("header" in n for n in notes) else "note"


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of each tag, and of comments and elements that hold no page text (name "" and "raw").

    As browsers read them: "<" begins a tag before a letter only, and else is text; what the page's end cuts off is no text.
    """
    at = 0
    while (at := page.find("<", at)) >= 0:
        start, following = at, page[at + 1 : at + 2]
        m = _TAG.match(page, at)
        if m:
            at, name = m.end(), m[2].lower()
            if name in RAW and not m[1]:
                close = _RAW_END[name].search(page, at)
                at = close.end() if close and m["closed"] else len(page)
                yield start, at, "", "raw", ""
            else:
                yield start, at, m[1], name, m[3]
        elif following in ("!", "?", "/") and following and at + 2 < len(page):
            mark = "-->" if page.startswith("<!--", at) else ">"
            end = page.find(mark, at + 2)
            at = end + len(mark) if end >= 0 else len(page)
            yield start, at, "", "", ""
        else:
            at += 1


def scan(page: str) -> list[tuple[str, str, bool, bool, int]]:
    """Tokens (kind, text, whether a block begins, whether left out, words): tags have kind <tag> and no text."""
    out: list[tuple[str, str, bool, bool, int]] = []
    stack = [_Node("", False, "body")]
    opened: Counter[str] = Counter()  # elements on the stack, by tag
    scopes: list[Counter[str]] = [Counter()]  # and since each of HOLDING that is open
    at, broken, begun = 0, True, False
    whole = "article" if re.search(r"<article[\s>]", page, re.I) else "main"  # the element that is the article's, if there is one

    def text(part: str) -> None:
        nonlocal broken, begun
        if part:
            top = stack[-1]
            words = html.unescape(part)
            n = len(words.split())
            if not top.aside and "link" not in top.kind:
                top.block.prose += n + PROSE * (n > 0 and top.kind in ("h1", "own h1"))
                begun = begun or top.block.prose >= PROSE or n > 0 and top.kind.removeprefix("own ") in ("h1", "h2", "heading")
            out.append(("short div" if top.kind == "div" and n < PROSE else top.kind, words, broken, top.aside, n))
            broken = False

    def push(node: _Node) -> None:
        stack.append(node)
        opened[node.tag] += 1
        if node.tag in HOLDING:
            scopes.append(Counter())
        scopes[-1][node.tag] += 1

    def pop() -> str:
        tag = stack.pop().tag
        opened[tag] -= 1
        scopes[-1][tag] -= 1
        if tag in HOLDING:
            scopes.pop()
        return tag

    def close(tag: str) -> None:
        """An end tag ends what is open in it, but not beyond an article, main part, body or table, if it isn't one's own."""
        if (opened if tag in ("body", "html", "article", "main") else scopes[-1])[tag]:
            while pop() != tag:
                pass

    def sort(tag: str, up: _Node) -> str:
        return f"own {tag}" if own_in(tag, up) else f"flow {tag}" if tag == "a" and flows(up) else tag

    def flows(up: _Node) -> bool:
        return up.kind in FLOW or up.kind == "div" and up.block.prose >= 4

    def own_in(tag: str, up: _Node) -> bool:
        """Links in lists before any title or text are those of a menu."""
        return up.holds(tag) and (begun or tag != "a" or up.block.tag != "li")

    for start, end, slash, tag, attributes in tags(page):
        text(page[at:start])
        at = end
        if tag == "raw":
            out.append(("<raw>", "", False, True, 0))
            continue
        if not tag:
            continue
        if slash:
            close(tag)
            up = stack[-1]
            out.append((f"</{sort(tag, up)}>", "", False, up.aside, 0))
        else:
            if tag in BLOCK and stack[-1].tag == "p" or tag in ("li", "dt", "dd", "tr", "option") and stack[-1].tag == tag:
                pop()
            up = stack[-1]
            note = _is_note(tag, attributes)
            in_title = (up.tag == "header" or up.note == "header") and tag in HEADING and bool(opened["article"] or opened["main"])
            # the page's main part is that within a wrapper which is named as a note, too
            inherited = up.aside and not in_title and not (tag == "main" and not up.barred)
            aside = inherited or tag in ASIDE or note != ""
            own = tag == whole or own_in(tag, up)
            base = up.kind.removeprefix("own ")
            kind = "link" if tag == "a" or base == "link" else "heading" if tag in HEADING and tag not in ("h1", "h2") else tag if tag in BLOCK else base
            if tag == "a" and (base in FLOW or flows(up)):
                kind = "h2 link" if base == "h2" else "flow link"
            elif base in ("flow link", "h2 link") and tag not in BLOCK:
                kind = base
            kind = "aside" if aside else f"own {kind}" if own else kind
            sorted_tag = "aside" if aside else sort(tag, up)
            if tag not in VOID and not _EMPTY.search(attributes[-2:]):
                push(_Node(tag, aside, kind, note, own, None if tag in BLOCK and tag not in ("p", "h1") else up.block, up.barred))
            out.append((f"<{sorted_tag}>", "", False, aside, 0))
        if tag in BLOCK:
            broken = True
        elif tag in ("br", "td", "th", "img"):
            out.append(("<space>", " ", broken, stack[-1].aside, 0))
            broken = False
    text(page[at:])
    return out


#: Labelled pages; the article stands between the marks [[ and ]].
TRAINING = [
    '<html><head><title>A day out</title><style>p{}</style></head><body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy a new lamp today.</div>[[<article><h1>A day out</h1><p>We left early and came to the lake at noon.</p><p>It rained, but <b>nobody</b> minded.</p></article>]]<footer>&copy; A paper</footer></body></html>',
    '<html><body><header><a href="/">The Post</a></header><div id="menu"><a href="/x">Sport</a> <a href="/y">Arts</a></div><main>[[<h1>Bread</h1><p>Flour, water and salt are all that you need for a good loaf.</p><ul><li>Mix them well.</li><li>Leave the dough to rest.</li></ul><blockquote>Bread is life.</blockquote>]]</main><aside><p>Most read</p><ul><li><a href="/1">Ten hats</a></li></ul></aside><footer><p>Contact us</p></footer></body></html>',
    '<html><body><div class="cookie">We use cookies. <button>Fine</button></div>[[<div><h2>Tides</h2><p>The moon pulls the sea, and the sea follows twice each day.</p><p>Sailors learned this long before anyone wrote it down.</p><table><tr><td>High</td><td>6.10</td></tr></table></div>]]<form><label>Mail</label><input></form><div class="comments"><p>Great text!</p><p>First.</p></div></body></html>',
    '<body><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li><li><a href="/c">Three</a></li></ul>[[<section><h1>Maps</h1><p>A map leaves out almost everything.</p><pre>north is up</pre><p>That is why it is of use.</p></section>]]<div class="share"><a href="/f">Share</a></div></body>',
    '<body>[[<p>A short note without any frame.</p><p>It has two paragraphs.</p>]]<footer>2020</footer></body>',
    '<body><nav><a href="/">Start</a></nav>[[<article><h1>Title</h1></article>]]<footer>A long footer with many more words than the article has.</footer></body>',
    '<body><nav><a href="/">Home</a></nav>[[<article><h1>Sea salt</h1><p><a href="/jane">Jane Doe</a></p><p>Salt has been dried on <a href="/c">this coast</a> for two thousand years, in pans of clay.</p><p>The trade is told in <a href="/b">an old book</a> too.</p><h2>Sources</h2><ul><li><a href="/1">The salt pans of the coast</a></li><li><a href="/2">A history of the trade in salt</a></li></ul></article>]]<footer><a href="/t">Terms</a></footer></body>',
    '<body><div id="nav"><a href="/">Home</a></div><main>[[<h1>How to graft</h1><ul><li><a href="#a">Tools</a></li><li><a href="#b">The cut</a></li><li><a href="#c">Care</a></li></ul><h2 id="a">Tools</h2><p>A sharp knife and tape are enough.</p><h2 id="b">The cut</h2><p>Cut along, never across, and <a href="/wax">wax</a> the end.</p><h2 id="c">Care</h2><p>Water it.</p>]]</main><footer>Garden paper</footer></body>',
    '<body><ul><li><a href="/a">Start page</a></li><li><a href="/b">All news of the day</a></li><li><a href="/c">Weather</a></li></ul>[[<div><h1>Floods recede</h1><p>By <a href="/k">Kim Lee</a></p><p>The river has gone back to its bed after <a href="/r">a week of rain</a> and and the town counts the damage.</p><table><tr><th>Place</th><th>Metres</th></tr><tr><td>Bridge</td><td>4.1</td></tr><tr><td><a href="/m">Mill</a></td><td>3.8</td></tr></table><p>See also</p><ul><li><a href="/x">Floods of the last century</a></li></ul></div>]]<div><a href="/p">Privacy</a> <a href="/i">Imprint</a></div></body>',
    '<body><div><a href="/in">Log in</a> <a href="/up">Sign up</a></div>[[<div><h1>On clocks</h1><p>A clock counts what swings, and the rest is gears, as <a href="/h">Huygens</a> knew well.</p><blockquote>Time is what a <a href="/q">clock</a> reads.</blockquote><ol><li>Wind it.</li><li>Set it by <a href="/n">the noon sign</a> too.</li></ol></div>]]<div><h3>Latest</h3><ul><li><a href="/1">Ten hats to wear</a></li><li><a href="/2">Five pans</a></li></ul></div></body>',
    '<body><table><tr><td><a href="/">Home</a></td><td><a href="/n">News</a></td></tr></table>[[<h1>Moss</h1><p>Moss drinks through its leaves and has no root at all.</p><p><a href="/f">Ferns</a> came later.</p>]]<footer>2011</footer></body>',
    '<body><header><h1><a href="/">Daily</a></h1></header><main>[[<article><header><h1>Bees in town</h1></header><div><a href="/u">A. Writer</a> and <a href="/s">Science</a></div><div>Roofs hold more hives than farms do.</div><dl><dt>Hives</dt><dd>About <a href="/d">900</a></dd></dl></article>]]</main></body>',
    '<body><nav><a href="/">Home</a></nav><main>[[<article><h1>Glass</h1><p>Sand, soda and lime melt into <a href="/g">glass</a> too.</p><figure><img src="/i"><figcaption>A furnace in <a href="/m">Murano</a></figcaption></figure><section><h2>Notes</h2><ol><li><a href="/1">A note on sand</a></li><li><a href="/2">A note on lime</a></li></ol></section></article>]]<div><h2>More</h2><ul><li><a href="/3">Clay in five steps</a></li><li><a href="/4">Iron and coal</a></li></ul></div></main></body>',
    '<body><div><ul><li><a href="/a">Products</a></li><li><a href="/b">Prices</a></li><li><a href="/c">Contact us</a></li></ul></div>[[<section><h1>Wool</h1><p><a href="/w">Wool</a> is spun from the fleece of sheep, washed and carded.</p><pre>wash card spin</pre><p>It keeps warm when wet.</p></section>]]<div><ul><li><a href="/d">Imprint</a></li><li><a href="/e">Terms of use</a></li></ul></div></body>',
    '<body><div><a href="/x">Skip to the text</a></div><div>[[<h1>Ice</h1><p>Ice floats, as water grows when it freezes, by about a tenth.</p><h3>Further reading</h3><ul><li><a href="/1">Why ice floats on the sea</a></li><li><a href="/2">Ten kinds of ice</a></li><li><a href="/3">Snow</a></li></ul>]]</div><div><a href="/p">Older</a> <a href="/n">Newer</a></div></body>',
    '<body><div><span>Menu</span> <a href="/1">Arts</a> <a href="/2">Food</a></div><article>[[<h2>Stone walls</h2><div>Dry walls need no mortar.</div><div>They stand by <a href="/w">weight</a> alone.</div><ul><li>Large stones first</li><li><a href="/s">Small stones</a> last</li></ul>]]</article><div><p><a href="/t">Top</a></p></div></body>',
    '<body><div><ul><li><a href="/1">One day in the hills</a></li><li><a href="/2">Two weeks at sea</a></li></ul></div><div>[[<p>We sailed at dawn with a <a href="/f">fair wind</a> and saw no other ship all day.</p><p>At night the <a href="/l">light</a> of the cape came up.</p>]]</div><div><ul><li><a href="/3">Three ports</a></li></ul></div></body>',
    '<body><nav><a href="/">Home</a></nav><article>[[<h1>Linked list</h1><p><a href="/a">Ann</a> and <a href="/b">Bo</a></p><ul><li><a href="#1">Definition of the list</a></li><li><a href="#2">Uses of lists</a></li><li><a href="#3">History of the list</a></li></ul><p>A list is a chain.</p><table><tr><td><a href="/o">Order</a></td><td>n</td></tr></table>]]</article><footer>Wiki</footer></body>',
    '<body><div><a href="/">Home</a> <a href="/about">About</a></div>[[<div><h2>A walk along the northern canal</h2><p>The towpath begins behind the mill, and there is <a href="/map">a map</a> of it at the gate.</p><p>Allow two hours.</p><h2>How to get there</h2><p>Take the <a href="/bus">bus</a> too.</p></div>]]<div><h3>Archive</h3><ul><li><a href="/05">May</a></li><li><a href="/04">April</a></li></ul></div></body>',
    '<body><div>[[<h2>Letters of a lighthouse keeper</h2><p><a href="/ed">The editors</a></p><p>He wrote each week, though the boat that took his letters came but once a month.</p>]]</div><div><h4>Tags and topics</h4><a href="/s">Sea</a></div></body>',
    '<body><div><a href="/">Home</a> | <a href="/n">News</a></div>[[<div>The old pier was taken down last spring, plank by plank.<br><br>What is left of it stands in <a href="/m">the museum</a> by the harbour, and it smells of tar and salt.<br>Some of the planks became benches.</div>]]<div>All rights kept</div></body>',
    '<body><div><ul><li><a href="/a">Rain</a></li><li><a href="/b">Snow</a></li></ul></div>[[<div><div>Hail forms in tall clouds, where the wind lifts it again and again.</div><div>Each turn adds a coat of ice to the stone.</div></div>]]<div>Printed on paper</div></body>',
    '<body><div><a href="/">Site</a></div><ul><li><a href="/a">Rain</a></li><li><a href="/b">Snow and ice</a></li></ul>[[<div><h2><a href="/post">A post on the making of ink</a></h2><p>Ink was made of oak galls and iron, and it ate the paper in the end.</p></div>]]<div><h2><a href="/k">Next post</a></h2></div></body>',
    '<body><div><p><a href="/">Home</a></p></div>[[<div><h2>Four rules for a small boat</h2><p>Look at the sky before you look at the sail, and ask those who came in.</p></div>]]<div><p><a href="/t">Back to top</a></p><p><a href="/p">Privacy</a> <a href="/i">Imprint</a></p></div></body>',
]


def _scores() -> dict[str, float]:
    """Log odds of a token's kind in and out of the articles of TRAINING, with half a count added."""
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    for page in TRAINING:
        a, b = page.index("[["), page.index("]]")
        for t in scan(page[:a] + page[a + 2 : b] + page[b + 2 :]):
            counts = outside if t[3] else inside
            counts[t[0]] += max(t[4], t[0][0] == "<")
        for part in (page[:a], page[b + 2 :]):
            for t in scan(part):
                if not t[3]:
                    n = max(t[4], t[0][0] == "<")
                    outside[t[0]] += n
                    inside[t[0]] -= n
    return {k: max(-4.0, min(4.0, math.log((max(inside[k], 0) + 0.5) / (outside[k] + 0.5)))) for k in inside | outside}


def _of(kind: str, scores: dict[str, float]) -> float:
    """Score of a token: tags cost a little at least, words outside of any known element are worth a little."""
    s = scores.get(kind)
    if kind[0] == "<":
        return min(-0.05, s) if s is not None else -0.3
    return s if s is not None else 0.3


class _Model:
    scores: dict[str, float] | None = None

    @classmethod
    def get(cls) -> dict[str, float]:
        if cls.scores is None:
            cls.scores = _scores()
        return cls.scores


def main_text(page: str | None) -> str:
    """The article's text of a whole page."""
    if not page:
        return ""
    tokens, scores = scan(page), _Model.get()
    best, best_from, best_to, total, since = 0.0, 0, 0, 0.0, 0
    for i, (kind, _, _, aside, words) in enumerate(tokens):
        # what is left out in any case costs its tag only: an article goes on behind an advert
        total += (0.0 if kind[0] != "<" else -0.05) if aside else _of(kind, scores) * (words if kind[0] != "<" else 1)
        if total <= 0:
            total, since = 0.0, i + 1
        elif total > best and kind[0] != "<" and (kind not in HEADS or not best):
            best, best_from, best_to = total, since, i + 1
    # the best stretch begins and ends within blocks, which are whole
    while best_from > 0 and best_from < len(tokens) and not tokens[best_from][3] and tokens[best_from][0][0] != "<" and not tokens[best_from][2]:
        best_from -= 1
    while best_to < len(tokens) and (tokens[best_to][0][0] == "<" or not tokens[best_to][2]):
        best_to += 1
    blocks: list[list[str]] = []
    fresh = True
    for kind, text, begins, aside, _ in tokens[best_from:best_to]:
        if begins:
            fresh = True
        if aside or (kind[0] == "<" and kind != "<space>"):
            continue
        if fresh:
            blocks.append([])
            fresh = False
        blocks[-1].append(text)
    joined = (" ".join("".join(b).split()) for b in blocks)
    return "\n\n".join(b for b in joined if b)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with the main text of each and its length in code points instead of the page."""
    prepare(pages.sparkSession)
    keep = [f for f in pages.schema if f.name not in (html_col, "text", "n_chars")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "text string", "n_chars long"])
    names = [f.name for f in keep]

    def run(batches):
        for b in batches:
            texts = [main_text(h) for h in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    return pages.select(*[f"`{n}`" for n in names], f"`{html_col}`").transform(arrow_map, run, schema)
