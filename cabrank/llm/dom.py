"""Block trees of HTML pages: tags to elements, and which of them say what they are.

Only block elements are nodes; inline markup is nothing but its text. Missing end tags are implied
as browsers do it, for paragraphs, list items, table parts and headings. A tag that the page ends
in is dropped, as is all that follows an unclosed comment or script.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import xxhash

# Element names and words by which elements declare themselves.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre section summary table "
    "caption tbody td tfoot th thead tr ul".split()
)
DROPPED = set(
    "nav footer aside form dialog menu dir script style noscript template iframe svg canvas object "
    "embed audio video map button select textarea head title noframes noembed xmp datalist".split()
)
RAW = set("script style textarea title iframe noframes noembed xmp".split())
CONTENT = set("article main".split())
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 blockquote pre #".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - set("body caption dd dt li summary tbody td tfoot th thead tr".split()) | {"li", "dd", "dt"}
# A start tag ends an open element of these names, unless one of the fences stands between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
HINTS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies "
    "consent gdpr notice sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "topbar comment comments disqus respond share sharing social related newsletter subscribe popup "
    "modal login search pagination pager toolbar".split()
)
ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)"
    r"""((?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]*)))?""")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in RAW}


class Node:
    """A block element: its label, and texts and elements in page order."""

    __slots__ = ("label", "name", "parent", "items", "drop", "soft", "content")

    def __init__(self, name: str, parent: Node | None, label: str = "", drop: bool = False, soft: bool = False, content: bool = False):
        self.name, self.parent, self.label = name, parent, label or name
        self.items: list[Node | str] = []
        # Declared no content: by its tag or role, or (soft) by a class, an id or as a form.
        self.drop, self.soft, self.content = drop, soft, content


def attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    return {k.lower(): unescape(a or b or c) for k, a, b, c in reversed(ATTRIBUTE.findall(text))}


def hinted(value: str) -> bool:
    """Whether a class or id names what is no article: ``ad``, ``site-footer``, ``cookie_bar``."""
    for word in value.lower().split():
        pieces = re.split(r"[-_:]+", word)
        if pieces[0] not in ("has", "with", "no", "is") and not HINTS.isdisjoint((pieces[0], pieces[-1])):
            return True
    return False


def parse(html: str, hints: bool = True) -> Node:
    """The block tree of a page. Without ``hints`` nothing but scripts and the head declares itself."""
    root = Node("#root", None)
    stack = [root]
    open_names: dict[str, int] = {}
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                stack[-1].items.append(text)

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            open_names[stack.pop().name] -= 1

    def nearest(names: set[str], fences: set[str]) -> int | None:
        """The outermost of the named elements inside the nearest fence."""
        found = None
        if any(open_names.get(n) for n in names):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in fences:
                    break
                if stack[i].name in names:
                    found = i
        return found

    at, end = 0, len(html)
    while at < end:
        token = TOKEN.search(html, at)
        if token is None:
            buffer.append(unescape(html[at:]))
            break
        if token.start() > at:
            buffer.append(unescape(html[at : token.start()]))
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name = name.lower()
        if token[1]:
            if open_names.get(name):
                flush()
                depth = max(i for i, n in enumerate(stack) if n.name == name)
                pop_to(depth)
            elif name in BLOCKS:
                flush()
            continue
        if name in RAW:
            flush()
            closing = RAW_END[name].search(html, at)
            if closing is not None:
                at = closing.end()
            elif name not in ("title", "textarea"):
                break
            continue
        if name == "br":
            buffer.append(" ")
            continue
        if name in VOID or name not in BLOCKS and name not in DROPPED:
            if name == "hr":
                flush()
            continue
        if name == "body":
            # What stands before is the head's, if its end tag is missing.
            if open_names.get("head"):
                flush()
                pop_to(max(i for i, n in enumerate(stack) if n.name == "head"))
            continue
        flush()
        if name in CLOSES_P and stack[-1].name == "p":
            pop_to(len(stack) - 1)
        if name in IMPLIED:
            depth = nearest(*IMPLIED[name])
            if depth is not None:
                pop_to(depth)
        if name[0] == "h" and name[1:].isdigit() and stack[-1].name[0] == "h" and stack[-1].name[1:].isdigit():
            pop_to(len(stack) - 1)
        node = declared(name, token[3], stack[-1], hints)
        stack[-1].items.append(node)
        if not token[3].endswith("/") or name not in ("svg", "canvas", "object"):
            stack.append(node)
            open_names[name] = open_names.get(name, 0) + 1
    flush()
    return root


def declared(name: str, text: str, parent: Node, hints: bool) -> Node:
    """An element with what its tag and attributes say about it."""
    own = attributes(text)
    kind = own.get("class", "").lower()
    label = f"{name}.{kind}" if kind else name
    if not hints:
        return Node(name, parent, label, drop=name in DROPPED - BLOCKS)
    role = own.get("role", "").lower()
    content = name in CONTENT or role in ("main", "article") or own.get("itemprop") == "articleBody"
    drop = name in DROPPED and name != "form" or role in ROLES or "hidden" in own or own.get("aria-hidden") == "true"
    if name == "header":
        up = parent
        while up is not None and not up.content:
            up = up.parent
        drop = drop or up is None
    soft = name == "form" or hinted(kind) or hinted(own.get("id", ""))
    return Node(name, parent, label, drop, soft, content)


def _walk(root: Node, soft: bool) -> list[Node]:
    """The element and all below it outside declared non-content, in page order."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node is not root and (node.drop or soft and node.soft):
            continue
        found.append(node)
        todo += [x for x in reversed(node.items) if not isinstance(x, str)]
    return found


def article_of(root: Node) -> tuple[list[Node], set[int] | None]:
    """The elements that declare the main text, and those whose class is not believed (None: all).

    Articles before other content elements; the page itself where there is none. A class or a form
    around all of the content is not believed.
    """
    for soft in (True, False):
        nodes = [n for n in _walk(root, soft) if n.content]
        for wanted in ([n for n in nodes if n.name == "article"], nodes):
            chosen = [n for n in wanted if any(isinstance(x, str) for y in _walk(n, True) for x in y.items)]
            if chosen:
                inner = set(map(id, chosen))
                chosen = [n for n in chosen if not _inside(n, inner)]
                return chosen, inner | {id(up) for n in chosen for up in _above(n)}
    believed = any(isinstance(x, str) for n in _walk(root, True) for x in n.items)
    return [root], set() if believed else None


def _above(node: Node) -> Iterator[Node]:
    up = node.parent
    while up is not None:
        yield up
        up = up.parent


def _inside(node: Node, nodes: set[int]) -> bool:
    return any(id(up) in nodes for up in _above(node))


def digest(*parts) -> int:
    """A signed 64-bit hash."""
    value = xxhash.xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def whole_text(node: Node) -> str:
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += reversed(x.items)
    return "\n".join(out)


def branches(root: Node, max_depth: int) -> tuple[list[tuple], list[tuple[str, list[int]]]]:
    """The page's part of the site's style tree, and its main text.

    Tree rows are (id, parent, depth, siblings, value, leaf). An element's id names its parent, the
    parent's style (the labels of all its children) and its place among them; its value is its own
    style or, where it has no elements (or lies at ``max_depth``), its text.

    Blocks are (text, ids of the branches that it goes with if they are of low importance). Inside
    declared content a paragraph of its own is no branch.
    """
    chosen, doubted = article_of(root)
    main, whole = set(map(id, chosen)), chosen == [root]
    rows: list[tuple] = []
    blocks: list[tuple[str, list[int]]] = []
    # (element or text, id, parent's id, depth, siblings, branches so far, inside the content)
    todo: list[tuple] = [(root, 0, 0, 0, 1, [], whole)]
    while todo:
        x, own, above, depth, siblings, path, inside = todo.pop()
        text = isinstance(x, str)
        if not text and (x.drop or x.soft and doubted is not None and id(x) not in doubted):
            continue
        if not text and id(x) in main and not whole:
            inside, path = True, []
        elif depth and inside and depth <= max_depth and (whole or ("#" if text else x.name) not in PARAGRAPHS):
            path = [*path, own]
        items = [] if text else x.items
        alone = len(items) == 1 and isinstance(items[0], str)
        leaf = text or alone or depth == max_depth
        if depth and depth <= max_depth and (text or items):
            if text or alone:
                value = digest("t", x if text else items[0])
            else:
                value = digest("t", whole_text(x)) if leaf else _style(items)
            rows.append((own, above, depth, siblings, value, leaf))
        if text or alone:
            if inside:
                blocks.append((x if text else items[0], path))
            continue
        style = _style(items)
        for i in range(len(items) - 1, -1, -1):
            todo.append((items[i], digest(own, style, i), own, depth + 1, len(items), path, inside))
    return rows, blocks


def _style(items: list) -> int:
    return digest("s", *["#" if isinstance(x, str) else x.label for x in items])
