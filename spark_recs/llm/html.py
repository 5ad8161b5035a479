"""Main text of web pages by tree scoring.

A page is parsed into a light tree.  Elements that never hold article text
(scripts, forms, navigation, footers, asides and, by the words of their class,
id or role, menus, adverts, sidebars, notices, comments) are left out.  A class
or id alone drops no article or main element and nothing that holds one, nor
an element that is named as content too and has over half of the page's text;
`has-sidebar`, `with-`, `no-` and the like say nothing; and if no paragraph is
left, class and id are not heeded.  An article named as comments or related
posts goes if there is another one beside it, and what follows a heading such as
`3 Responses` goes with it.  Every paragraph gives points for its length and its
commas to its ancestors: all to the parent, half to the grandparent, a third,
quarter ... of that further up, `LEVELS` in all.  A container's points are
discounted by its link density.  The best container is kept, but the page's only
article (or main) before any other, unless that has `FAR` times its text.  Of the
siblings those with enough points or a long paragraph's text are kept, for an
article only inside its main; beside a container that is no article also those of
a sentence or more.  A heading before the kept parts stays with them.

Defined results: null or empty html gives an empty text; a page without
paragraphs gives the text of its body; markup that never closes ends with the
page; references that name no character stay as they are; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = "page_id long, url string, text string, n_chars long"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary table
tbody td tfoot th thead tr ul""".split())
DROPPED = set("""aside audio canvas dialog footer form head iframe input menu nav noscript
object option script select style svg template textarea title video""".split())
CLOSED_BY_BLOCK = {"p"}
PEERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table div section article main body html td blockquote".split())
BAD_WORDS = set("""ad ads adv advert adverts advertisement advertising adsense alert alerts banner banners
breadcrumb breadcrumbs comment comments consent cookie cookies discussion disqus footer gdpr masthead menu menus modal
nav navbar navigation newsletter notice notices notification notifications pager pagination popup promo
promoted promotion promotions recommended related reply replies respond responses rss share sharing shoutbox sidebar
sidebars signup skyscraper social sponsor sponsored subscribe subscription toolbar topbar widget widgets""".split())
BAD_ROLES = set("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
toolbar""".split())
GOOD_WORDS = set("article body content entry main post story text".split())
COMMENT_WORDS = set("comment comments discussion disqus replies reply respond responses shoutbox".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
LEVELS, FAR, BYLINE = 32, 10, 80
_COMMENT_HEAD = re.compile(r"(?:\d+ |reader |user |your |all |latest )?(?:comments?|responses|replies)(?: ?\(\d+\)|: ?\d+)?|\d+ response|\d+ reply"
                           r"|(?:leave|post|write|add) (?:a|your) (?:reply|comment|response)|join the (?:discussion|conversation)", re.I)
WORD = re.compile(r"[a-z]+")
_MODIFIER = re.compile(r"(?<![a-z])(?:has|with|without|no|hide|show)[-_]\S*")
_SENTENCE = re.compile(r"[.!?。！？][\"'”’»)]*(?:\s|$)")


class Node:
    __slots__ = ("tag", "parent", "parts", "good", "dropped", "names", "score", "chars", "linked", "commas")

    def __init__(self, tag, parent=None, good=False, dropped=False):
        self.tag, self.parent, self.parts = tag, parent, []
        self.good, self.dropped, self.names, self.score = good, dropped, set(), 0.0
        self.chars = self.linked = self.commas = 0


def _is_dropped(tag: str, attrs: dict, parent: Node) -> bool:
    if tag in DROPPED or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if (attrs.get("role") or "").lower() in BAD_ROLES or re.search(r"display\s*:\s*none", attrs.get("style") or "", re.I):
        return True
    if tag == "header":  # a page's header, not the heading of its article
        while parent is not None and parent.tag not in ("article", "main"):
            parent = parent.parent
        return parent is None
    return False


def _names(attrs: dict) -> set[str]:
    """The words of class and id, without those of modifiers."""
    named = re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{attrs.get('class') or ''} {attrs.get('id') or ''}").lower()
    return set(WORD.findall(_MODIFIER.sub(" ", named)))


class Tree(HTMLParser):
    """The page as Nodes; text of dropped elements isn't kept."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html")
        self.whole, self.suspects = [], []  # articles; elements named as no content
        self.open: dict[str, int] = {}      # elements above `at`, it included, by tag

    def _leave(self, node: Node) -> None:
        """Closes `node` and all inside it."""
        while self.at is not node.parent:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent

    def _close(self, tags, scopes) -> None:
        node = self.at
        while node is not self.root and node.tag not in tags:
            if node.tag in scopes:
                return
            node = node.parent
        if node is not self.root:
            self._leave(node)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and not self.at.dropped:
            return  # one tree whatever the markup says
        if tag == "body":
            while self.at.dropped and self.at.tag == "head":
                self._leave(self.at)
            return
        if tag == "br":
            self.at.parts.append(" ")
            return
        if tag in BLOCKS:
            self._close(CLOSED_BY_BLOCK, SCOPES - {"p"})
        if tag in PEERS:
            self._close(PEERS[tag], {"ul", "ol", "dl", "table", "select"})
        if tag in VOID:
            if tag == "hr":
                self.at.parts.append(Node("hr", self.at))
            return
        attrs = dict(attrs)
        names = _names(attrs)
        whole = tag in ("article", "main") or attrs.get("role") == "main"
        node = Node(tag, self.at, whole or not GOOD_WORDS.isdisjoint(names), self.at.dropped or _is_dropped(tag, attrs, self.at))
        node.names = names
        if not node.dropped:
            if not BAD_WORDS.isdisjoint(names):
                self.suspects.append(node)
            elif whole:
                self.whole.append(node)
        self.at.parts.append(node)
        self.at = node
        self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("html", "body", "br"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in ("html", "body") or tag in VOID or not self.open.get(tag):
            return
        node = self.at
        while node.tag != tag:
            node = node.parent
        self._leave(node)

    def handle_data(self, data):
        if not self.at.dropped:
            self.at.parts.append(data)


def _walk(root: Node) -> list[Node]:
    """Kept nodes, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(x for x in reversed(node.parts) if isinstance(x, Node) and not x.dropped)
    return out


def _blocks(root: Node) -> list[str]:
    """The texts of a node's blocks in page order, white space as one space."""
    out, run = [], []

    def flush():
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    todo = [iter(root.parts)]
    ends = [root.tag in BLOCKS]
    while todo:
        for x in todo[-1]:
            if not isinstance(x, Node):
                run.append(x)
            elif not x.dropped:
                block = x.tag in BLOCKS
                if block:
                    flush()
                todo.append(iter(x.parts))
                ends.append(block)
                break
        else:
            todo.pop()
            if ends.pop():
                flush()
    flush()
    return out


def _measure(nodes: list[Node]) -> None:
    """Characters, characters in links and commas of each subtree."""
    for node in reversed(nodes):
        for x in node.parts:
            if not isinstance(x, Node):
                text = " ".join(x.split())
                node.chars += len(text)
                node.commas += text.count(",") + text.count("，") + text.count("、")
        if node.tag == "a":
            node.linked = node.chars
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.commas += node.commas
            node.parent.linked += node.linked


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _is_paragraph(node: Node) -> bool:
    """A block with text of its own: in it directly or in inline elements."""
    if node.tag in ("h1", "h2", "h3", "h4", "h5", "h6") or node.tag not in BLOCKS:
        return False
    todo = list(node.parts)
    while todo:
        x = todo.pop()
        if not isinstance(x, Node):
            if x.strip():
                return True
        elif not x.dropped and x.tag not in BLOCKS:
            todo.extend(x.parts)
    return False


def _above(node: Node):
    while node.parent is not None:
        node = node.parent
        yield node


def _drop_comments(nodes: list[Node], holds: set[int]) -> None:
    """Leaves out what follows a heading of reader comments inside its parent,
    from the heading on, unless an article is among it."""
    for node in nodes:
        if node.tag in HEADINGS and node.parent is not None and not node.dropped and node.chars < 60:
            if _COMMENT_HEAD.fullmatch(" ".join(_blocks(node))):
                parts = node.parent.parts
                rest = parts[next(i for i, x in enumerate(parts) if x is node):]
                if not any(isinstance(x, Node) and id(x) in holds for x in rest):
                    node.parent.parts = parts[: len(parts) - len(rest)]


def _drop_suspects(tree: Tree) -> None:
    """Leaves out what its class or id names as no content, and comments by their heading."""
    holds = set()
    for node in tree.whole:
        while node is not None and id(node) not in holds:
            holds.add(id(node))
            node = node.parent
    nodes = _walk(tree.root)
    _measure(nodes)
    half = (tree.root.chars - tree.root.linked) / 2
    articles = [n for n in tree.whole if n.tag == "article" and n.chars]
    for node in tree.suspects:
        named = not GOOD_WORDS.isdisjoint(node.names) and COMMENT_WORDS.isdisjoint(node.names)
        node.dropped = id(node) not in holds and not (named and node.chars - node.linked > half)
        if node.tag in ("article", "main"):  # only beside another article
            node.dropped = node.dropped and any(a not in _above(node) for a in articles[:LEVELS])
    _drop_comments(nodes, holds)
    for node in nodes:
        node.chars = node.linked = node.commas = 0


def _score(tree: Tree) -> tuple[list[Node], list[Node]]:
    """(kept nodes, those with points)."""
    nodes = _walk(tree.root)
    _measure(nodes)
    scored: list[Node] = []
    for node in nodes:
        if node.chars and _is_paragraph(node):
            points = (1 + node.commas + min(node.chars / 100, 3)) * (1 - _density(node))
            level, up = 0, node.parent
            while up is not None and level < LEVELS:
                if up.score == 0:
                    scored.append(up)
                    up.score += 5 if up.good else 0
                up.score += points if level == 0 else points / (level + 1)
                level, up = level + 1, up.parent
    return nodes, scored


def main_text(html: str | None) -> str:
    """The page's article, one line per block."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    _drop_suspects(tree)
    nodes, scored = _score(tree)
    if not scored and any(n.dropped for n in tree.suspects):
        for node in nodes:
            node.chars = node.linked = node.commas = 0
        for node in tree.suspects:
            node.dropped = False
        nodes, scored = _score(tree)
    if not scored:
        good = [n for n in nodes if n.good and n.chars]
        return "\n".join(_blocks(good[0] if good else tree.root))
    value = {id(n): n.score * (1 - _density(n)) for n in scored}
    best = max(scored, key=lambda n: value[id(n)])
    if best.parent is None:
        return "\n".join(_blocks(best))
    # an article that holds the best container (its heading or another part) is the article itself
    best = next((up for up in _above(best) if up.tag in ("article", "main")), best) if best.tag not in ("article", "main") else best
    sole = _sole(tree, value)
    if sole is not None and sole is not best and best not in _above(sole) and best.chars <= FAR * sole.chars:
        best = sole
    if sole is not None and best in _above(sole) and best.tag != "main":
        best = sole
    if best.parent is None:
        return "\n".join(_blocks(best))
    article = best.tag in ("article", "main")
    beside = not article or any(up.tag == "main" for up in _above(best))
    least = max(10.0, 0.2 * value.get(id(best), 0.0))
    out: list[str] = []
    loose: list[str] = []
    for x in best.parent.parts:
        if not isinstance(x, Node) or x.dropped:
            continue
        heading = x.tag in HEADINGS
        if x is best:
            out += loose + _blocks(x)
        elif beside and (value.get(id(x), 0.0) >= least or (x.tag == "p" and x.chars >= 80 and _density(x) < 0.25)):
            out += loose + _blocks(x)
        elif not article and x.tag in BLOCKS and not heading and _density(x) < 0.25 and any(map(_SENTENCE.search, _blocks(x))):
            out += loose + _blocks(x)
        elif heading and not out:  # a heading before the kept parts belongs to them, a byline between them or not
            loose = _blocks(x)
            continue
        elif x.chars < BYLINE:
            continue
        loose = []
    return "\n".join(out)


def _sole(tree: Tree, value: dict[int, float]) -> Node | None:
    """The page's only article with points, or its only main if it has none."""
    some = [n for n in tree.whole if id(n) in value and not n.dropped]
    some = [n for n in some if n.tag == "article"] or some
    outer = {id(n) for n in some}
    some = [n for n in some if not any(id(up) in outer for up in _above(n))]
    return some[0] if len(some) == 1 else None


def _extract(batches):
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            texts = [main_text(h.as_py()) for h in part.column(2)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of `pages` (page_id, url, html)."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return src.mapInArrow(_extract, OUT)
