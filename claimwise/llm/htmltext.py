"""Main text of web pages by tree scoring.

A page is read into a tree.  Parts that never belong to an article (menus, headers, footers, side bars, notices,
adverts, forms, comments, scripts) are left out by tag, role or class words.  Every paragraph then passes points
for its length and commas to its ancestors, half of them one level further up; a container's points are
discounted by the share of its text that stands in links.  The best container is kept, with those of its siblings
that score well or read like paragraphs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwise.llm.common import short_batches

MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"          # comment
    r"|<([/]?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"  # tag
    r"|<([/]?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"  # tag with a stray quote
    r"|<[!?/][^>]*(?:>|\Z)", re.S)           # declaration
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# fixed values of the HTML standard
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
             "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
             "tfoot th thead tr ul".split())
ENDS_P = BLOCKS - set("body caption head html legend option tbody td tfoot th thead tr".split())
CLOSES = {  # a start tag ends these open elements, looked for up to one of the second set
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}

#: Elements that are never part of an article.
DROPPED = set("head nav footer aside form script style noscript template iframe object embed svg canvas audio video button select "
              "textarea input label dialog menu noembed noframes map xmp applet".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist note".split())
#: Words of class and id that mark such parts, for certain or unless the part looks like the article.
SURE = re.compile(
    r"(?:^|[\s_-])(?<!has-)(?<!with-)(?<!no-)(?:ads?|adverts?|advert\w*|adsense|adslot|adbox|banners?|sponsor\w*|promos?|promotion\w*|sidebars?|"
    r"widgets?|menus?|nav|navbar|navigation|breadcrumbs?|crumbs?|footers?|masthead|topbar|toolbar|comments?|commentlist|respond|replies|disqus|"
    r"cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|newsletter|subscribe|subscription|signup|login|search|share|sharing|social|"
    r"related|recommend\w*|pagination|pager|tagcloud|hidden|paywall)(?=$|[\s_-]|\d)", re.I)
#: Those of them that mark such a part wherever they stand in a name; of the others one word in a longer name of the article's own is not enough.
STRONG = re.compile(
    r"(?:ads?|adverts?|advert\w*|adsense|adslot|adbox|sponsor\w*|sidebars?|navbar|breadcrumbs?|masthead|commentlist|disqus|cookies?|consent|gdpr|"
    r"popups?|newsletter|pagination|pager|tagcloud|paywall)\d*", re.I)
#: Words that add nothing to a name: with a word of SURE they make a part's whole name.
NEUTRAL = set(
    "area articles bar block body bottom box button buttons container content count entry form forms icon icons inner item items label left link links list "
    "main more news outer page pages panel post posts products reading right row section site slot small stories story text thread title top topics unit "
    "user users video videos wrap wrapper".split())
#: Names of whole blocks of readers' comments, which may be longer than the article.
READERS = re.compile(
    r"(?:^|\s)(?:(?:user|customer|reader|visitor|guest)s?[-_]?)?(?:comments?|commentlist|respond|replies|disqus|reviews|feedback|responses)"
    r"(?:[-_]?(?:lists?|body|section|area|thread|wrapper|container|content|block|box|item|entry|text|\d+))*(?=$|\s)", re.I)
#: Words of class on inline elements that are no part of the text.
INLINE_SURE = re.compile(r"(?:^|\s)(?:ads?|advert\w*|adslot|adbox|sponsor\w*|promos?|share|sharing|social|newsletter|subscribe|signup|login|hidden)"
                         r"(?:[-_](?:box|button|buttons|icon|icons|link|links|label|text|unit))*(?=$|\s)", re.I)
INLINE = set("a b i em strong span small u mark".split())
#: Elements in which an <article> is a teaser.
TEASERS = set("nav footer aside dialog menu".split())
LIKELY = re.compile(
    r"(?:^|[\s_-])(?:side|aside|headers?|foot|discussion|tags|skip|disclaimer|copyright|legal|meta|byline|toc|rss|shoutbox|tools)(?=$|[\s_-]|\d)", re.I)
FINE = re.compile(r"(?:^|[\s_-])(?:article|articlebody|body|content|entry|main|post|story|text|page|hentry)(?=$|[\s_-]|\d)", re.I)
INLINE_HOLDERS = set("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 dt figcaption caption th".split())
SCORED = set("p pre td blockquote dd li".split())


class Node:
    __slots__ = ("tag", "attrs", "up", "parts", "points", "chars", "linked", "odd", "holds", "apart", "titled", "paragraphs", "length", "links")

    def __init__(self, tag: str, attrs: str, up: Node | None):
        self.tag, self.attrs, self.up = tag, attrs, up
        self.parts: list[Node | str] = []
        self.points = self.chars = self.linked = 0.0
        self.odd = False
        self.holds = False  # it or one of its parts is the article by its tag
        self.apart = False  # it stands in a block of teasers or readers' comments
        self.titled = tag in ("h1", "h2", "h3")
        self.paragraphs = int(tag == "p")
        self.length = self.links = 0  # of its text and that of its parts, elements that are never part of an article aside; in links

    def named(self) -> str:
        """Its class and id."""
        if not self.attrs.strip():
            return ""
        attrs = self.attributes()
        return f"{attrs.get('class', '')} {attrs.get('id', '')}"

    def attributes(self) -> dict[str, str]:
        return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(self.attrs)}


def parse(html: str) -> list[Node]:
    """The page's elements in page order, the root first; open and crossed elements are closed as browsers do in the common cases."""
    root = here = Node("#page", "", None)
    order = [root]
    at, raw, search = 0, "", MARKUP.search
    while True:
        if raw:  # the text of a raw element ends at its own end tag alone
            m = re.compile(rf"</{re.escape(raw)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            here.parts.append(html[at:m.start() if m else len(html)])
            here, raw = here.up or root, ""
            if not m:
                return order
            at = m.end()
        m = search(html, at)
        if m is None:
            if at < len(html):
                here.parts.append(html[at:])
            return order
        if m.start() > at:
            here.parts.append(html[at:m.start()])
        at = m.end()
        close, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if close:
            node = here
            while node is not None and node.tag != tag:
                # an inline end tag doesn't reach beyond its block
                node = None if tag not in BLOCKS and node.tag in BLOCKS else node.up
            if node is not None and node.up is not None:
                here = node.up
            continue
        if tag in ENDS_P:
            node = here
            while node is not None and node.tag != "p" and node.tag not in BLOCKS:
                node = node.up
            if node is not None and node.tag == "p":
                here = node.up
        if tag in CLOSES:
            ended, until = CLOSES[tag]
            node, last = here, None
            while node is not None and node.tag not in until:
                last = node if node.tag in ended else last
                node = node.up
            here = last.up if last is not None else here
        child = Node(tag, attrs, here)
        here.parts.append(child)
        order.append(child)
        if tag in RAW:
            here, raw = child, tag
        elif tag not in VOID and not attrs.endswith("/"):
            here = child


def _wholly(named: str) -> bool:
    """Whether a class or id names a side part as a whole (``cookie-notice``, ``related-posts``), not by one word of a longer name (``related-work``)."""
    for token in named.split():
        words = [w for w in re.split(r"[-_]+", token) if w]
        side = [bool(SURE.fullmatch(w)) for w in words]
        if any(STRONG.fullmatch(w) for w in words) or any(side) and all(x or w.lower() in NEUTRAL or w.isdigit() for x, w in zip(side, words, strict=True)):
            return True
    return False


def _reads_like_side(node: Node) -> bool:
    """Mostly links, or a scrap without a sentence."""
    if node.length and node.links >= 0.4 * node.length:
        return True
    return node.length < 80 and not re.search(r"[.!?](?:\s|$)", _raw_text(node))


def _raw_text(node: Node) -> str:
    out, stack = [], list(reversed(node.parts))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            stack.extend(reversed(x.parts))
    return " ".join(out)


def _is_odd(node: Node, inside: bool, most: int, half: float) -> bool:
    """Whether an element is no part of an article; ``inside``: it stands in an <article> or <main>; ``most``: half of the page's paragraphs;
    ``half``: half of the page's text, on a page whose article no tag names: what holds more is a frame around it with a layout's words."""
    if node.tag == "header" and inside and node.titled:  # an article's own header holds its title
        return False
    if node.tag in DROPPED or node.tag == "header":
        return node.tag in TEASERS or not node.holds
    if not node.attrs.strip() or node.tag in ("html", "body"):
        return False
    attrs = node.attributes()
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    if node.holds:
        return False
    named = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    if node.tag in ("article", "main"):
        return bool(READERS.search(named))
    if attrs.get("role", "").lower() in ROLES:
        return True
    if node.tag in INLINE:
        return bool(INLINE_SURE.search(named))
    if node.tag == "h1":
        return False
    if READERS.search(named):
        return True
    if SURE.search(named) and node.length <= half and (not inside or _wholly(named) or _reads_like_side(node)):
        return True
    return bool(LIKELY.search(named)) and not FINE.search(named) and node.paragraphs <= most and (not inside or _reads_like_side(node) or node.tag != "section")


def _measure(nodes: list[Node]) -> list[Node]:
    """Marks the odd parts and sums text and link lengths without them; the other elements in page order."""
    for node in nodes[1:]:  # what holds parts before them
        node.apart = node.up.apart or node.tag in TEASERS or bool(node.attrs) and node.tag not in ("html", "body", *INLINE) and bool(READERS.search(node.named()))
        node.holds = node.tag in ("article", "main") and not node.apart
    for node in reversed(nodes[1:]):  # parts before what holds them
        node.up.holds |= node.holds
        node.up.titled |= node.titled
        node.up.paragraphs += node.paragraphs
        node.length += sum(len(x.strip()) for x in node.parts if isinstance(x, str))
        if node.tag == "a":
            node.links = node.length
        if node.tag not in DROPPED:
            node.up.length += node.length
            node.up.links += node.links
    order, stack, most = [], [(nodes[0], False)], nodes[0].paragraphs // 2
    page = nodes[0]
    half = float("inf") if page.holds else (page.length + sum(len(x.strip()) for x in page.parts if isinstance(x, str))) / 2
    while stack:
        node, inside = stack.pop()
        order.append(node)
        within = inside or node.tag in ("article", "main") or not page.holds and node.paragraphs > most and bool(FINE.search(node.named()))
        after: Node | None = None
        for x in reversed(node.parts):
            if isinstance(x, Node):
                # a heading right before readers' comments is theirs
                x.odd = _is_odd(x, within, most, half) or x.tag in ("h2", "h3", "h4", "h5", "h6") and after is not None and after.odd and after.apart and after.tag not in TEASERS
                after = x
                if not x.odd:
                    stack.append((x, within))
            elif x.strip():
                after = None
    for node in reversed(order):
        for x in node.parts:
            if isinstance(x, str):
                node.chars += len(x.strip())
            elif not x.odd:
                node.chars += x.chars
                node.linked += x.linked
        if node.tag == "a":
            node.linked = node.chars
    return order


def _own_text(node: Node) -> str:
    """Text of an element up to the blocks in it."""
    out, stack = [], list(reversed(node.parts))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.odd and x.tag not in BLOCKS:
            stack.extend(reversed(x.parts))
    return "".join(out)


def _kept(nodes: list[Node]) -> list[Node]:
    """The best container and those of its siblings that belong to it, in page order."""
    order, page = _measure(nodes), nodes[0]
    for node in order:
        has_own = node.tag in ("div", "section", "article", "main", "body", "center", "#page") and any(
            isinstance(x, str) and x.strip() or isinstance(x, Node) and not x.odd and x.tag not in BLOCKS and x.chars for x in node.parts)
        if node.tag not in SCORED and not has_own:
            continue
        text = _own_text(node).strip()
        if len(text) < 2:
            continue
        points = 1 + text.count(",") + len(text) / 100
        own = node if has_own else node.up
        for share in (1.0, 0.5, 0.25):
            if own is None:
                break
            own.points += points * share
            own = own.up
    best, most = page, 0.0
    for node in order:
        if node.tag in INLINE_HOLDERS - {"td", "blockquote"} or node.tag in ("ul", "ol", "tr", "tbody", "thead", "dl", "#page", "html"):
            continue
        score = node.points * (1 - node.linked / node.chars if node.chars else 0)
        score *= 1.25 if node.tag in ("article", "main") else 1.0
        if score > most:
            best, most = node, score
    # an article that holds the best part whole is the container itself
    node = best
    while node.up is not None:
        node = node.up
        if node.tag in ("article", "main"):
            best = node
    if best.up is None:
        return [best]
    kept, parts = [], [x for x in best.up.parts if isinstance(x, Node)]
    before = True
    for x, after in zip(parts, [*parts[1:], None], strict=True):
        if x is best:
            kept.append(x)
            before = False
        elif not x.odd and x.chars:
            links = x.linked / x.chars
            good = x.points * (1 - links) >= max(10.0, 0.2 * most) and x.tag == best.tag
            # a heading belongs to what follows it
            titled = x.tag in ("h1", "h2") and links < 0.25 and (before and x.tag == "h1" or after is not None and not after.odd and after.chars > 0)
            if good or titled or x.tag == "p" and best.tag not in ("article", "main") and (x.chars > 80 and links < 0.25 or links == 0 and re.search(r"[.!?](?:\s|$)", _own_text(x))):
                kept.append(x)
    return kept


def main_text(html: str | None) -> str:
    """Main text of one page: its blocks in page order, white space as single spaces.  Empty if there is none."""
    if not html:
        return ""
    blocks, now = [], []
    for part in _kept(parse(html)):
        stack: list[Node | str | None] = [part]
        while stack:
            x = stack.pop()
            if x is None:  # the border of a block
                blocks.append("".join(now))
                now = []
            elif isinstance(x, str):
                now.append(unescape(x) if "&" in x else x)
            elif x.tag == "br":
                now.append(" ")
            elif not x.odd:
                if x.tag in BLOCKS:
                    stack += [None, *reversed(x.parts), None]
                else:
                    stack.extend(reversed(x.parts))
    blocks.append("".join(now))
    return " ".join(" ".join(b.split()) for b in blocks if b.strip())


def extract(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col`` in ``into``.

    Null, empty and text-less pages give an empty text.  Pages are read whole, one by one: repeated rows agree, an empty
    table gives an empty result.  Ties between containers go to the one that starts first.  Other columns stay as they are
    (one called ``into`` is replaced)."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(x.as_py()) for x in batch], pa.string())

    short_batches(pages.sparkSession)
    return pages.withColumn(into, run(F.col(f"`{html_col}`")))
