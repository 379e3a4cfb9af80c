"""Main text of web pages by tree scoring.

A page becomes a tree of elements.  Blocks that hold running text pass points for their length and commas to their
ancestors, less at each step up; links discount them.  The container with most points is the article, together with
those of its siblings that score or read like it.

What a class, an id, a role or ``form`` calls surroundings is judged once the page is read: a wrapper that holds the page's running
text is none, whatever its words say.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head script style noscript template iframe title nav footer aside button select option input textarea svg canvas object embed audio video map dialog menu xmp noembed noframes".split()
)
CONTAINERS = frozenset("article main section div body td center blockquote".split())
CLOSED_BY_BLOCK = frozenset("p".split())
SELF_CLOSING_ROWS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}

_NAME = re.compile(r"[^\s/>]+")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*|=[^\s/>=]*)(\s*=\s*)?")
_PLAIN_VALUE = re.compile(r"[^\s>]*")
MAX_DEPTH = 512  # elements nested deeper become siblings, as in browsers
_UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|banner|sponsor\w*|promo\w*|sidebar|side|comments?|disqus|respond|reply|replies|footer|foot|header|masthead|nav\w*|menu|breadcrumbs?|cookies?|consent|gdpr|notices?|alert|"
    r"popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|pagination|pager|toolbar|skip|widget|meta|tags?|legal|copyright|disclaimer)(?:$|[\s_-])",
    re.I,
)
_NEVER = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|respond|reply|replies|meta|ads?|advert\w*|sponsor\w*)(?:$|[\s_-])", re.I)
_LIKELY = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body|text)(?:$|[\s_-])", re.I)
_STATE = re.compile(r"(?:^|\s)(?:has|no|with|without|is)[_-]\S+|\S+[_-](?:open|opened|closed|enabled|disabled|on|off)(?=\s|$)", re.I)  # what a page has, not what an element is
_LINK_ROWS = re.compile(r"(?:^|(?<=[\s_-]))(?:social|share|sharing|tags?|toolbar|skip)(?=$|[\s_-])", re.I)
_OWN_WORDS = frozenset("article main content post entry story body text".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_READS = frozenset("p blockquote pre table figure".split())
_BETWEEN = _READS | frozenset("ul ol dl h2 h3 h4 h5 h6".split())
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "doubtful", "own", "score", "likely", "depth", "prose", "linked", "heads", "holds")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, likely: bool, doubtful: str = "", own: bool = False):
        self.tag, self.parent, self.dropped, self.likely, self.doubtful, self.own = tag, parent, dropped, likely, doubtful, own
        self.prose = self.linked = 0
        self.heads, self.holds = tag in ("h1", "main"), tag == "article" and not doubtful
        self.children: list[Node | str] = []
        self.score, self.depth = 0.0, 0 if parent is None else parent.depth + 1


class _Tokens:
    """One pass over a page: texts, and tags with their attributes.  No part of the page is looked at twice, so unclosed
    quotes, comments and tags cost no more than others."""

    def __init__(self, page: str):
        self.page, self.unclosed = page, set()

    def tag(self, at: int) -> tuple[str, dict[str, str], bool, int]:
        """(name, attributes, whether it ends with a slash, place after it) of the tag whose name starts at ``at``.

        Attributes are read one by one; the first of a name counts.  A quote that is never closed is part of a value
        without quotes; a tag that is never closed ends with the page."""
        page = self.page
        name = _NAME.match(page, at)
        at, found = name.end(), {}
        while True:
            gap = _GAP.match(page, at)
            at = gap.end()
            if at >= len(page) or page[at] == ">":
                return name.group().lower(), found, gap.group().endswith("/"), at + 1
            attribute = _ATTRIBUTE.match(page, at)
            at, value = attribute.end(), ""
            if attribute.group(2) is not None:
                quote = page[at : at + 1]
                end = -1
                if quote in ("'", '"') and quote not in self.unclosed:
                    end = page.find(quote, at + 1)
                    if end < 0:
                        self.unclosed.add(quote)
                if end >= 0:
                    value, at = page[at + 1 : end], end + 1
                else:
                    plain = _PLAIN_VALUE.match(page, at)
                    value, at = plain.group().strip("\"'"), plain.end()
            found.setdefault(attribute.group(1).lower(), value)

    def until(self, end: str, at: int) -> tuple[int, int]:
        """Where ``end`` stands from ``at`` on, and the place after it; the page's end if it doesn't."""
        found = -1 if end in self.unclosed else self.page.find(end, at)
        if found < 0:
            self.unclosed.add(end)
            return len(self.page), len(self.page)
        return found, found + len(end)


def parse(page: str) -> Node:
    """The page's tree.  Unclosed inline elements end with their block, blocks and rows end those they can't stand in.
    Elements that seem to be surroundings are doubtful until ``settle`` has seen the whole page."""
    root = top = Node("#root", None, False, False)
    open_tags: dict[str, int] = {}
    tokens, inside_article, at = _Tokens(page), 0, 0

    def close(upto: Node) -> Node:
        nonlocal inside_article
        node = top
        while node is not upto:
            inside_article -= node.tag in ("article", "main")
            open_tags[node.tag] -= 1
            node = node.parent
        return node

    while True:
        start = page.find("<", at)
        while start >= 0 and not (page[start + 1 : start + 2].isalpha() or page[start + 1 : start + 2] in ("!", "?") or page[start + 1 : start + 2] == "/" and page[start + 2 : start + 3].isalpha()):
            start = page.find("<", start + 1)
        text = page[at:] if start < 0 else page[at:start]
        if text:
            top.children.append(html.unescape(text))
        if start < 0:
            return root
        follows = page[start + 1]
        if follows in "!?":
            if page.startswith("<!--", start):
                at = tokens.until("-->", start + 4)[1]
            elif page.startswith("<![CDATA[", start):
                end, at = tokens.until("]]>", start + 9)
                top.children.append(page[start + 9 : end])
            else:
                at = tokens.until(">", start + 2)[1]
        elif follows == "/":
            tag, _, _, at = tokens.tag(start + 2)
            if open_tags.get(tag):
                node = top
                while node.parent is not None and node.tag != tag and not (tag in INLINE and node.tag not in INLINE):
                    node = node.parent
                if node.parent is not None and node.tag == tag:
                    top = close(node.parent)
        else:
            tag, names, slashed, at = tokens.tag(start + 1)
            if tag not in INLINE and tag not in VOID and tag not in RAW:
                node = top
                while node.parent is not None and node.tag in INLINE:
                    node = node.parent
                if node.tag in CLOSED_BY_BLOCK:
                    top = close(node.parent)
                elif tag in SELF_CLOSING_ROWS:
                    while node.parent is not None and node.tag != tag and node.tag not in SELF_CLOSING_ROWS[tag]:
                        node = node.parent
                    if node.tag == tag or (tag in ("dt", "dd", "td", "th") and node.tag in ("dt", "dd", "td", "th")):
                        top = close(node.parent)
            label = f"{names.get('class', '')} {names.get('id', '')}"
            likely = tag in ("article", "main") or bool(_LIKELY.search(label))
            dropped = top.dropped or tag in DROPPED or (tag == "header" and not inside_article)
            doubtful = "form" if tag == "form" else ""
            if not dropped and names and tag not in ("html", "body", "article", "main"):
                dropped = "hidden" in names or names.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(names.get("style", "")))
                role, said = names.get("role", "").lower(), _STATE.sub(" ", label)
                if _NEVER.search(said):
                    doubtful = "never"
                elif role in _ROLES or not (inside_article and likely) and _UNLIKELY.search(said):
                    links = role not in _ROLES and not _UNLIKELY.search(_LINK_ROWS.sub(" ", said))
                    doubtful = doubtful or ("links" if links else "class")
            own = bool(label.strip()) and any(all(part in _OWN_WORDS for part in re.split("[_-]", word.lower())) for word in label.split())
            node = Node(tag, top, dropped, likely, doubtful, own)
            top.children.append(node)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at) if f"</{tag}" not in tokens.unclosed else None
                if end is None:
                    tokens.unclosed.add(f"</{tag}")
                node.children.append(page[at : end.start() if end else len(page)])
                at = tokens.until(">", end.start())[1] if end else len(page)
            elif tag not in VOID and not slashed and node.depth < MAX_DEPTH:
                top = node
                open_tags[tag] = open_tags.get(tag, 0) + 1
                inside_article += tag in ("article", "main")


_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def settle(root: Node) -> None:
    """Drop the doubtful elements that are surroundings.

    One pass up counts the characters of running text (outside links and headings) in every element, and whether it holds the page's head: h1, main
    or article.  One pass down judges: a doubtful element is no surrounding if all running text is in it, or half of it and it holds
    the head or is named as an article is; a form, if it holds half; what is named as a row of links is, if it is running text.  What never is
    the article's own (comments, adverts) needs h1, main or an article's name."""
    order, stack = [], [(root, False, False)]
    while stack:
        node, linked, heading = stack.pop()
        order.append(node)
        for child in node.children:
            if not isinstance(child, str):
                if not child.dropped:
                    stack.append((child, linked or child.tag == "a", heading or child.tag in _HEADINGS))
            elif linked:
                node.linked += len(child.strip())
            elif not heading:
                node.prose += len(child.strip())
    for node in reversed(order):
        above = node.parent
        if above is not None:
            above.prose, above.linked = above.prose + node.prose, above.linked + node.linked
            above.heads, above.holds = above.heads or node.heads, above.holds or node.holds
    for node in order:
        if node.parent is not None and node.parent.dropped:
            node.dropped = True
        elif node.doubtful:
            half, head = 2 * node.prose >= root.prose > 0, node.own or node.heads or node.doubtful != "never" and node.holds
            reads = node.doubtful == "links" and node.prose > 140 and 4 * node.linked < node.prose
            node.dropped = not (reads or node.prose == root.prose > 0 or half and (head or node.doubtful == "form"))


def _blocks(start: Node) -> Iterator[tuple[Node, str, int]]:
    """(block element, its text, characters of it inside links) in page order; a block ends where another begins."""
    owner, pieces, linked = start, [], 0
    stack: list[tuple[Node, int, int]] = [(start, 0, 0)]

    def flush():
        text = _SPACE.sub(" ", "".join(pieces)).strip()
        pieces.clear()
        return text

    owners = [start]
    while stack:
        node, i, links = stack.pop()
        if i == len(node.children):
            if node.tag not in INLINE:
                text = flush()
                if text:
                    yield owners[-1], text, linked
                linked = 0
                if len(owners) > 1:
                    owners.pop()
            continue
        child = node.children[i]
        stack.append((node, i + 1, links))
        if isinstance(child, str):
            pieces.append(child)
            linked += len(child.strip()) if links else 0
        elif child.dropped:
            if child.tag not in INLINE:
                pieces.append(" ")
        elif child.tag == "br":
            pieces.append(" ")
        elif child.tag in INLINE:
            stack.append((child, 0, links + (child.tag == "a")))
        else:
            text = flush()
            if text:
                yield owners[-1], text, linked
            linked = 0
            owners.append(child)
            stack.append((child, 0, links))


def _points(text: str, linked: int) -> float:
    points = 1 + text.count(",") + min(len(text) / 100, 3)
    return points * max(0.0, 1 - linked / max(len(text), 1))


def extract(page: str | None) -> str:
    """The main text: blocks in page order, joined by one space; empty without any."""
    if not page:
        return ""
    tree = parse(page)
    settle(tree)
    blocks = list(_blocks(tree))
    if not blocks:
        return ""
    scored: dict[int, Node] = {}
    for owner, text, linked in blocks:
        points = _points(text, linked)
        if owner.tag in ("li", "dt", "dd", "caption", "th", "h1", "h2", "h3", "h4", "h5", "h6", "address"):
            points *= 0.25
        node, share, level = owner if owner.tag in CONTAINERS else owner.parent, 1.0, 0
        while node is not None and node.tag != "#root":
            if node.tag in CONTAINERS:
                node.score += points * share
                scored[id(node)] = node
                level += 1
                share = 1 / (2 * level) if level > 1 else 0.5
            node = node.parent
    if not scored:
        return " ".join(text for _, text, _ in blocks)
    for node in scored.values():
        if node.tag in ("article", "main"):
            node.score *= 2
        elif node.likely:
            node.score *= 1.25
    best = max(scored.values(), key=lambda n: (n.score, n.depth))
    chosen = {id(best)}
    if best.parent is not None:
        own = {}
        for owner, text, linked in blocks:
            node = owner
            while node is not None and node.parent is not best.parent:
                node = node.parent
            if node is not None and node is not best:
                size = own.setdefault(id(node), [node, 0, 0])
                size[1] += len(text)
                size[2] += linked
        inner = best.parent.tag not in ("body", "#root", "html")  # a paragraph there stands inside a container that isn't the page
        for key, (node, length, linked) in own.items():
            links = linked / max(length, 1)
            reads = node.tag in _READS and (length > 80 or inner) and links < 0.25
            heads = node.tag in ("h1", "h2") and best.tag not in ("article", "main", "body")
            if node.score >= max(10.0, 0.2 * best.score) and links < 0.25 or reads or heads:
                chosen.add(key)
        # what stands between two parts of the article belongs to it, but for lists of links
        row = [n for n in best.parent.children if isinstance(n, Node)]
        places = [i for i, n in enumerate(row) if id(n) in chosen]
        for node in row[places[0] : places[-1]]:
            if id(node) in own and node.tag in _BETWEEN and own[id(node)][2] < 0.25 * own[id(node)][1]:
                chosen.add(id(node))
    out = []
    for owner, text, _ in blocks:
        node = owner
        while node is not None and id(node) not in chosen:
            node = node.parent
        if node is not None:
            out.append(text)
    return " ".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 200):
            part = batch.slice(at, 200)
            texts = [extract(page) for page in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html; more columns are not read).

    Null and empty html give an empty text; html without any tag is one block.  Repeated rows are repeated; an empty table
    gives an empty result.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
