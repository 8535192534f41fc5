"""Main text of web pages through wrappers: union-free expressions inferred from pages of one host.

A page becomes a stream of tokens, nested by element. Two streams are aligned
level by level: what both have is merged, a stretch that only one has becomes
optional, runs of like elements (or of like groups of elements) become
repeated, and texts that differ become slots. Aligning all pages of a
host gives its wrapper.

The wrapper then tells the article: the elements marked as such (``article``,
``main``), or else the innermost container that holds most of the text that
varies and has no heading, paragraph, list or table with such text beside it. Elements beside the article (menus, asides, adverts, forms, comments)
are known by tag or by a whole class; where only a part of a class says so, as
in ``related-posts``, or the class is one that articles use as well (``HINTS``),
the wrapper decides: the element goes if its text is the
same on all pages or mostly links; of a host with too few pages to tell, what ``HINTS`` name goes unless it has a heading. In an unmarked article text that the host's
pages share goes too. Every page is aligned with its host's wrapper, which is the
only source of the decision; a page of which it keeps nothing (another template)
is aligned with a wrapper of its own.

Wrappers come from all distinct pages of a host, whatever their length. Pages of one class
(elements, repeats and options agree) align place by place, so a class is its form
and, for each place of a text, sums that Spark combines before it shuffles. The classes of a host, those of
most pages first, are then aligned in rounds of about ``FAN`` a part, the parts by a hash of the class: a page's text depends
on its host's pages and not on order, partitions or tasks, and no task meets all pages or
all classes of a host but in what alignment leaves of them.

Edge cases: a null html counts as empty and gives an empty text; pages with a
null or unknown host count as one host; repeated pages give repeated rows and
count once; elements
nested deeper than ``DEPTH`` belong to the one there; very long pages take
linear time. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import chain, groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, slices, written

#: The number of pages from which a shared text can be told to be fixed, and the classes of a host that one part of a round aligns.
LEAST_PAGES, FAN = 3, 64
#: Deepest nesting that is told apart, and most different parts of a repeated element.
DEPTH, PARTS = 100, 64
#: The share of the varying text that a container must hold to be gone into, and that links must have to make a doubtful element no article.
MOST, LINKS = 0.6, 0.5

#: Elements of HTML by what they do to text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style noscript template title iframe textarea".split())
SILENT = RAW | frozenset("head svg math object canvas button select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body div section center main article table tbody tr td".split())
#: Elements of lists, whose neighbours of the same tag are repeats whatever they hold.
LISTED = frozenset("p li dt dd tr td th option blockquote figure".split())
#: Elements beside the article, and classes, ids or roles that name such parts.
BESIDE = frozenset("nav footer aside form menu dialog fieldset".split())
BESIDE_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer header login menu nav navbar navigation newsletter notice notices pagination popup promo related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
#: Of these classes, those that are only hints: a title stands in a header, a review has a menu.
HINTS = frozenset("header menu social".split())
#: Elements of which an article consists.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = HEADINGS | frozenset("p ul ol dl table blockquote pre figure hgroup".split())
#: Elements that a new one of the kind ends, if they are the innermost.
ENDS_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TAG_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
TAG_STOP = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
PARTS_OF_WORD = re.compile(r"[^a-z]+")


class Node:
    """An element, a group of elements (name in brackets) or a text (name ``#``) of a page or a wrapper.

    value: the text (in tables its ``key``) if it is the same wherever seen, else None (a slot). texts: places in the page's stream.
    """

    __slots__ = ("chars", "gone", "keep", "kids", "links", "name", "optional", "pages", "repeated", "shape", "texts", "value")

    def __init__(self, name: str, kids: list[Node] | None = None) -> None:
        self.name, self.kids = name, kids if kids is not None else []
        self.optional = self.repeated = self.keep = self.gone = False
        self.pages, self.chars, self.links, self.shape = 1, 0, 0, 0
        self.value: str | int | None = None
        self.texts: list[int] = []


# --- from a page to its tree


def tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """The place of the ``>`` that ends the tag, not in a quoted value; -1 if there is none. Each character is seen once."""
    while m := TAG_STOP.search(page, at):
        if not m[1]:
            return m.start()
        at = m.end()
        if at <= last[m[1]]:
            at = page.index(m[1], at) + 1
    return -1


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """("#", text), ("<p>", attributes) and ("</p>", ""). Comments and what scripts hold are left out; an unclosed tag is text."""
    last = {q: page.rfind(q) for q in "\"'"}
    at, size = 0, len(page)
    begin = at
    while (lt := page.find("<", at)) >= 0:
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            end = size if end < 0 else end + 3
        elif page.startswith("<![CDATA[", lt):
            end = page.find("]]>", lt)
            end = size if end < 0 else end + 3
        elif page[lt + 1 : lt + 2] in ("!", "?"):
            end = page.find(">", lt) + 1
            if not end:
                break
        elif m := TAG_NAME.match(page, lt + 1):
            end = tag_end(page, m.end(), last) + 1
            if not end:
                break
            if begin < lt:
                yield "#", page[begin:lt]
            tag = m[0].lower()
            rest = page[m.end() : end - 1]
            if tag[0] != "/" and rest.endswith("/") and tag not in VOID:
                yield f"<{tag}>", rest[:-1]
                yield f"</{tag}>", ""
            else:
                yield f"<{tag}>", rest
                if tag in RAW:
                    close = re.compile(rf"</{tag}\s*>", re.I).search(page, end)
                    end = close.end() if close else size
                    yield f"</{tag}>", ""
            at = begin = end
            continue
        else:
            at = lt + 1
            continue
        if begin < lt:
            yield "#", page[begin:lt]
        at = begin = end
    if begin < size:
        yield "#", page[begin:]


def element_name(tag: str, attributes: str) -> str:
    """The tag, then its classes, ids and roles in order. Words with digits tell pages apart and not elements."""
    if not attributes or tag in ("html", "body", "article", "p"):
        return tag
    return _name(tag, attributes) if len(attributes) < 300 else _name.__wrapped__(tag, attributes)


@lru_cache(maxsize=20_000)
def _name(tag: str, attributes: str) -> str:
    words = {("role=" if m[1].lower() == "role" else "") + w for m in ATTRIBUTE.finditer(attributes) for w in (m[2] or m[3] or m[4] or "").lower().split()}
    return " ".join([tag, *sorted(w for w in words if not any(c.isdigit() for c in w))])


def tree_of(page: str) -> tuple[Node, list[str | None]]:
    """The page as a tree, and its stream: texts, and None where a block begins or ends.

    Inline elements are no nodes of their own, unless their class says that they are beside the article.
    """
    root, stream = Node("page"), []
    stack: list[tuple[str, bool]] = []  # tag, and whether it is a node
    nodes, blocks = [root], []  # open nodes, and the places of blocks in the stack
    opened: dict[str, int] = {}
    silent = links = 0
    now: Node | None = None  # the text that goes on

    def close(size: int) -> None:
        nonlocal silent, links, now
        while len(stack) > size:
            tag, is_node = stack.pop()
            opened[tag] -= 1
            silent -= tag in SILENT
            links -= tag == "a"
            if is_node:
                nodes.pop()
                now = None
            if tag in BLOCKS:
                blocks.pop()

    for kind, data in tokens(page):
        if kind in ("#", "<br>"):
            if not silent:
                blank = kind != "#" or data.isspace()
                if now is None and not blank:
                    now = Node("#")
                    nodes[-1].kids.append(now)
                if now is not None:
                    now.texts.append(len(stream))
                    stream.append(" " if blank else data)
                    if not blank:
                        now.chars += len(data)
                        now.links += len(data) if links else 0
            continue
        tag = kind.strip("</>")
        if tag in BLOCKS:
            now = None
            stream.append(None)
        if kind[1] == "/":
            if opened.get(tag):
                size = len(stack) - 1
                while stack[size][0] != tag:
                    size -= 1
                close(size)
            continue
        if blocks and stack[blocks[-1]][0] in ENDS_ITSELF.get(tag, ()):
            close(blocks[-1])
        name = element_name(tag, data)
        is_node = not silent and tag not in SILENT and (tag in BLOCKS or is_beside(name)) and len(nodes) < DEPTH
        if is_node:
            node, now = Node(name), None
            nodes[-1].kids.append(node)
        if tag not in VOID:
            if is_node:
                nodes.append(node)
            if tag in BLOCKS:
                blocks.append(len(stack))
            stack.append((tag, is_node))
            opened[tag] = opened.get(tag, 0) + 1
            silent += tag in SILENT
            links += tag == "a"
    return root, stream


def shaped(root: Node, stream: list[str | None]) -> Node:
    """The tree with the values of texts, and with repeats folded, innermost first."""
    shapes: dict[tuple, int] = {}
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += n.kids
    for n in reversed(order):
        if n.name == "#":
            n.value = " ".join("".join(stream[i] or "" for i in n.texts).split())
            continue
        if " " not in n.name and n.name in ("div", "section") and all(k.name == "#" for k in n.kids):
            n.name += "#"
        n.kids = folded(n.kids)
        n.shape = shapes.setdefault((n.name, *(k.shape if k.name != "#" else -1 for k in n.kids)), len(shapes))
    return root


def like(a: Node, b: Node) -> bool:
    """Whether b repeats a: list elements and those of one class always do, others if they hold the same."""
    return a.name == b.name != "#" and len(a.kids) + len(b.kids) <= PARTS and (a.name.split(" ", 1)[0] in LISTED or " " in a.name or a.shape == b.shape)


def folded(kids: list[Node]) -> list[Node]:
    out: list[Node] = []
    for k in kids:
        if out and like(out[-1], k):
            out[-1] = merged(out[-1], k, repeat=True)
        else:
            out.append(k)
    for size in (2, 3):
        kids, out, i = out, [], 0
        while i < len(kids):
            unit, j = kids[i : i + size], i + size
            while len(unit) == size and len({u.name for u in unit}) > 1 and len(kids) >= j + size and all(like(u, k) for u, k in zip(unit, kids[j : j + size], strict=True)):
                unit = [merged(u, k, repeat=False) for u, k in zip(unit, kids[j : j + size], strict=True)]
                j += size
            if j > i + size:
                out.append(grouped(unit))
                out[-1].repeated = True
            else:
                j = i + 1
                out.append(kids[i])
            i = j
    return out


def grouped(unit: list[Node]) -> Node:
    return Node(f"({'|'.join(u.name for u in unit)})", unit)


# --- alignment


def pairs(wrapper: list[Node], page: list[Node]) -> Iterator[tuple[Node | None, Node | None]]:
    """Two levels side by side. At a mismatch the side that finds the other's element sooner is ahead; ties skip the wrapper's."""

    def places(nodes: list[Node]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for k, n in enumerate(nodes):
            out.setdefault(n.name, []).append(k)
        return out

    def following(where: list[int], at: int) -> int:
        k = bisect_left(where, at)
        return where[k] if k < len(where) else -1

    def group_at(group: Node, nodes: list[Node], at: int) -> bool:
        return group.name[0] == "(" and group.name == f"({'|'.join(n.name for n in nodes[at : at + len(group.kids)])})"

    in_wrapper: dict[str, list[int]] | None = None
    i = j = 0
    while i < len(wrapper) and j < len(page):
        w, p = wrapper[i], page[j]
        if w.name == p.name:
            yield w, p
            i, j = i + 1, j + 1
        elif group_at(w, page, j):
            yield w, grouped(page[j : j + len(w.kids)])
            i, j = i + 1, j + len(w.kids)
        elif group_at(p, wrapper, i):
            yield grouped(wrapper[i : i + len(p.kids)]), p
            i, j = i + len(p.kids), j + 1
        else:
            if in_wrapper is None:
                in_wrapper, in_page = places(wrapper), places(page)
            x, y = following(in_wrapper.get(p.name, []), i), following(in_page.get(w.name, []), j)
            if x < 0 and y < 0:
                yield w, None
                yield None, p
                i, j = i + 1, j + 1
            elif y < 0 or 0 <= x - i <= y - j:
                for k in range(i, x):
                    yield wrapper[k], None
                i = x
            else:
                for k in range(j, y):
                    yield None, page[k]
                j = y
    for w in wrapper[i:]:
        yield w, None
    for p in page[j:]:
        yield None, p


def merged(w: Node, p: Node, repeat: bool) -> Node:
    """One element for both: of the same page if it repeats there, else of a wrapper and the next page."""
    w.repeated |= p.repeated or repeat
    w.optional |= p.optional
    w.chars, w.links = w.chars + p.chars, w.links + p.links
    w.texts += p.texts
    if w.value != p.value:
        w.value = None
    if w.name == "#":
        return w
    kids = []
    for a, b in pairs(w.kids, p.kids):
        if a and b:
            kids.append(merged(a, b, repeat=False))
        else:
            kids.append(a or b)
            kids[-1].optional = True
    w.kids = kids
    return w


def _counted(w: Node, p: Node) -> None:
    """Adds up the pages that have an element; the two trees are about to be merged."""
    todo = [(w, p)]
    while todo:
        a, b = todo.pop()
        a.pages += b.pages
        todo += [(x, y) for x, y in pairs(a.kids, b.kids) if x and y and x.name[0] != "("]


def aligned(trees: Iterable[Node]) -> Node | None:
    """The trees of pages, classes or parts of a host as one, not judged."""
    wrapper: Node | None = None
    for tree in trees:
        if wrapper is None:
            wrapper = tree
        else:
            _counted(wrapper, tree)
            wrapper = merged(wrapper, tree, repeat=False)
    return wrapper


def infer(pages: list[str]) -> Node:
    """The wrapper of some pages of a host, judged."""
    wrapper = aligned(shaped(*tree_of(page)) for page in pages) or Node("page")
    judge(wrapper, len(pages))
    return wrapper


def key(text: str) -> int:
    """What stands for a text in tables."""
    h = xxhash.xxh64_intdigest(text.encode(errors="surrogatepass"))
    return h - (h >> 63 << 64)


def outline(root: Node) -> tuple[str, list[Node]]:
    """The class of a tree, a digest of all that it holds but its texts, and the texts in order."""
    parts: list[str] = []
    texts: list[Node] = []
    todo: list[Node | None] = [root]
    while todo:
        n = todo.pop()
        if n is None:
            parts.append(")")
            continue
        parts += (n.name, marks(n))
        if n.name == "#":
            texts.append(n)
        elif n.kids:
            parts.append("(")
            todo += (None, *reversed(n.kids))
    return blake2b("\n".join(parts).encode(errors="surrogatepass"), digest_size=16).hexdigest(), texts


def weighted(form: Node, pages: int, texts: list[tuple[int | None, int, int]]) -> Node:
    """The tree of a class by its form, its number of pages, and the value, chars and links of each text: what aligning its pages gives."""
    for t, (value, chars, links) in zip(outline(form)[1], texts, strict=True):
        t.value, t.chars, t.links = value, chars, links
    todo = [form]
    while todo:
        n = todo.pop()
        n.pages = pages
        todo += [k for k in n.kids if k.name[0] != "("]
    return form


def expression(node: Node) -> str:
    """A wrapper in the notation of regular expressions."""
    if node.name == "#":
        body = "#TEXT" if node.value is None else f"#'{node.value}'"
    else:
        inner = " ".join(expression(k) for k in node.kids)
        body = f"( {inner} )" if node.name[0] == "(" else f"( <{node.name}> {inner} </> )" if node.kids else f"<{node.name}/>"
    return body + ("+" if node.repeated else "") + ("?" if node.optional else "")


# --- what is the article


@lru_cache(maxsize=20_000)
def is_beside(name: str) -> bool:
    tag, *words = name.split(" ")
    return tag in BESIDE or any(w.removeprefix("role=") in BESIDE_WORDS and w not in HINTS for w in words)


@lru_cache(maxsize=20_000)
def is_doubtful(name: str) -> bool:
    return any(not BESIDE_WORDS.isdisjoint(PARTS_OF_WORD.split(w)) for w in name.split(" ")[1:])


@lru_cache(maxsize=20_000)
def is_hint(name: str) -> bool:
    return any(w in HINTS for w in name.split(" ")[1:])


def is_marked(name: str) -> bool:
    return name == "article" or name.split(" ", 1)[0] == "main" or " role=main" in name


def walk(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        n = todo.pop()
        yield n
        todo += n.kids


def mostly_links(node: Node) -> bool:
    texts = [t for t in walk(node) if t.name == "#"]
    return sum(t.links for t in texts) >= LINKS * sum(t.chars for t in texts)


def judge(root: Node, pages: int) -> None:
    """Sets keep on the elements of the article, and gone on the texts in it that go because they are fixed."""

    def fixed(t: Node) -> bool:
        return pages >= LEAST_PAGES and t.value is not None and 2 * t.pages >= pages

    def out(n: Node, inside: bool) -> bool:
        if is_beside(n.name) or n.name == "header" and not inside:
            return True
        if not is_doubtful(n.name):
            return False
        if pages < LEAST_PAGES and is_hint(n.name):  # nothing to compare with: the class is all there is
            return all(k.name not in HEADINGS for k in walk(n))
        return mostly_links(n) or all(fixed(t) for t in walk(n) if t.name == "#")

    shown, marked = [], []
    todo = [(root, False)]
    while todo:
        n, inside = todo.pop()
        if n.name == "#" or out(n, inside) and not is_marked(n.name):
            continue
        shown.append(n)
        if is_marked(n.name) and not inside:
            marked.append(n)
        todo += [(k, inside or is_marked(n.name)) for k in n.kids]
    on = {id(n) for n in shown}

    def measured(varying: bool) -> dict[int, int]:
        """The text of each shown element that isn't links; only what varies, if so asked."""
        size: dict[int, int] = {}
        for n in reversed(shown):  # parents stand before their children
            size[id(n)] = sum(t.chars - t.links if t.name == "#" and not (varying and fixed(t)) else size.get(id(t), 0) for t in n.kids)
        return size

    varies = True
    if not marked:
        size = measured(True)
        if not size.get(id(root)):
            varies, size = False, measured(False)

        def content(k: Node) -> bool:
            """Whether text of an article stands in an element as such: it, or one of a group, is no container."""
            if k.name == "#":
                return k.chars > k.links and not (varies and fixed(k))
            return bool(size.get(id(k))) and (k.name.split(" ", 1)[0] in CONTENT or k.name[0] == "(" and any(content(x) for x in k.kids))

        best = root
        while True:
            inner = max((k for k in best.kids if id(k) in on), key=lambda k: size[id(k)], default=None)
            whole = inner is not None and inner.name.split(" ", 1)[0] in CONTAINERS and not inner.repeated
            if not whole or not size[id(best)] or size[id(inner)] < MOST * size[id(best)] or any(content(k) for k in best.kids if k is not inner):
                break
            best = inner
        mains = [best]
    else:
        mains, varies = marked, False
    for m in mains:
        for n in walk_shown(m, on):
            n.keep = True
            for t in n.kids:
                t.gone = varies and t.name == "#" and fixed(t)


def walk_shown(node: Node, on: set[int]) -> Iterator[Node]:
    todo = [node]
    while todo:
        n = todo.pop()
        yield n
        todo += [k for k in n.kids if id(k) in on]


def pruned(root: Node) -> Node:
    """A judged wrapper without what decides nothing: the inside of elements of which nothing stays, and of those where all that isn't known by its name alone stays."""
    order = list(walk(root))
    keeps: dict[int, bool] = {}
    plain: dict[int, bool] = {}
    for n in reversed(order):
        keeps[id(n)] = n.keep or any(keeps[id(k)] for k in n.kids)
        if n.name == "#":
            plain[id(n)] = not n.gone
        elif is_doubtful(n.name) or n.name[0] == "(":
            plain[id(n)] = False
        elif is_beside(n.name):
            plain[id(n)] = not keeps[id(n)]
        else:
            plain[id(n)] = n.keep and all(plain[id(k)] for k in n.kids)
    for n in order:
        if n.name[0] != "(" and (not keeps[id(n)] or plain[id(n)]):
            n.kids = []
    return root


def marks(node: Node) -> str:
    return ("+" if node.repeated else "") + ("?" if node.optional else "")


def packed(node: Node) -> list:
    return [node.name, marks(node) + ("k" if node.keep else "") + ("g" if node.gone else ""), node.value, node.pages, node.chars, node.links, [packed(k) for k in node.kids]]


def unpacked(data: list) -> Node:
    node = Node(data[0], [unpacked(k) for k in data[6]])
    node.repeated, node.optional, node.keep, node.gone = (m in data[1] for m in "+?kg")
    node.value, node.pages, node.chars, node.links = data[2:6]
    return node


def form_of(node: Node) -> list:
    """A tree packed without what tells pages of its class apart."""
    return [node.name, marks(node), None, 1, 0, 0, [form_of(k) for k in node.kids]]


# --- from a page to its text


def kept_texts(wrapper: Node, page: Node) -> list[int]:
    """The places of the page's texts that the wrapper has in its article."""
    out: list[int] = []
    todo: list[tuple[Node | None, Node, bool]] = [(wrapper, page, wrapper.keep)]
    while todo:
        w, p, on = todo.pop()
        if p.name == "#":
            if on and not (w and w.gone and p.value is not None and w.value in (p.value, key(p.value))):
                out += p.texts
        elif w:
            inside = w.keep if w.name[0] != "(" else on
            todo += [(a, b, inside) for a, b in pairs(w.kids, p.kids) if b]
        elif on and not is_beside(p.name) and not (is_doubtful(p.name) and mostly_links(p)):
            todo += [(None, k, on) for k in p.kids]
    return out


def read_off(stream: list[str | None], places: list[int]) -> str:
    """The texts at some places, by block."""
    wanted = set(places)
    blocks, now = [], []
    for i, text in enumerate(stream):
        if text is None:
            blocks.append("".join(now))
            now = []
        elif i in wanted:
            now.append(text)
    blocks.append("".join(now))
    clean = (" ".join(entities.unescape(b).split()) for b in blocks if b)
    return "\n\n".join(b for b in clean if b)


def main_text(wrapper: Node, page: str) -> str:
    root, stream = tree_of(page)
    tree = shaped(root, stream)
    places = kept_texts(wrapper, tree)
    if not places and len(stream) > stream.count(None):
        own = infer([page])
        places = kept_texts(own, tree)
    return read_off(stream, places)


def extract(pages: list[str]) -> list[str]:
    """Main texts of all pages of one host, of up to FAN classes: what the Spark form gives."""
    classes: dict[str, list[Node]] = {}
    for page in dict.fromkeys(pages):
        tree = shaped(*tree_of(page))
        classes.setdefault(outline(tree)[0], []).append(tree)
    wrapper = aligned(aligned(trees) for _, trees in sorted(classes.items(), key=lambda c: (-len(c[1]), c[0]))) or Node("page")
    judge(wrapper, wrapper.pages)
    return [main_text(wrapper, p) for p in pages]


def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_host, _page (a digest), _class, the class's form where the task first meets it, and the key, chars and links of each text."""
    met: set[tuple[str, str]] = set()
    for batch in batches:
        for part in slices(batch):
            rows = []
            for host, page in zip(part.column("_host").to_pylist(), part.column("_text").to_pylist(), strict=True):
                tree = shaped(*tree_of(page))
                name, texts = outline(tree)
                form = None
                if (host, name) not in met:
                    if len(met) > 50_000:
                        met.clear()
                    met.add((host, name))
                    form = json.dumps(form_of(tree))
                sums = [None if t.value is None else key(t.value) for t in texts], [t.chars for t in texts], [t.links for t in texts]
                rows.append((host, blake2b(page.encode(errors="surrogatepass"), digest_size=16).hexdigest(), name, form, *sums))
            kinds = [pa.string()] * 4 + [pa.list_(pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["_host", "_page", "_class", "_tree", "keys", "chars", "links"])


def class_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_tree"):
            rows = zip(part.column("_tree").to_pylist(), part.column("_pages").to_pylist(), part.column("texts").to_pylist(), strict=True)
            made = [json.dumps(packed(weighted(unpacked(json.loads(t)), n, [(x["key"], x["chars"], x["links"]) for x in texts or []]))) for t, n, texts in rows]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("_host", "_class", "_pages")), pa.array(made, pa.string())], names=["_host", "_class", "_pages", "_tree"])


def aligned_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of rows of a host and part, in their order; its class is that of the first."""
    rows = ((r["_host"], r["_part"], r["_class"], r["_tree"]) for batch in batches for part in slices(batch, "_tree") for r in part.to_pylist())
    for (host, _), run in groupby(rows, key=lambda r: r[:2]):
        first = next(run)
        wrapper = aligned(unpacked(json.loads(r[3])) for r in chain([first], run))
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (host, first[2], wrapper.pages, json.dumps(packed(wrapper)))], names=["_host", "_class", "_pages", "_tree"])


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_tree"):
            made = []
            for tree in part.column("_tree").to_pylist():
                wrapper = unpacked(json.loads(tree))
                judge(wrapper, wrapper.pages)
                made.append(json.dumps(packed(pruned(wrapper))))
            yield pa.RecordBatch.from_arrays([part.column("_host"), pa.array(made, pa.string())], names=["_wrapped_host", "_wrapper"])


def wrappers(base: DataFrame) -> DataFrame:
    """base: _host, _text. One row for each host: _wrapped_host, _wrapper (JSON)."""
    seen = written(base.mapInArrow(outlines, "_host string, _page string, _class string, _tree string, keys array<long>, chars array<long>, links array<long>"), "outlines")
    forms = seen.where("_tree is not null").groupBy("_host", "_class").agg(F.min("_tree").alias("_tree"))
    pages = seen.drop("_tree").dropDuplicates(["_host", "_page"])
    texts = pages.select("_host", "_class", F.posexplode_outer(F.arrays_zip("keys", "chars", "links")).alias("pos", "t"))
    same = (F.count("t.keys") == F.count("*")) & (F.min("t.keys") == F.max("t.keys"))
    places = texts.groupBy("_host", "_class", "pos").agg(F.count("*").alias("n"), F.when(same, F.min("t.keys")).alias("key"), F.sum("t.chars").alias("chars"), F.sum("t.links").alias("links"))
    place = F.when(F.col("pos").isNotNull(), F.struct("pos", "key", "chars", "links"))
    classes = places.groupBy("_host", "_class").agg(F.max("n").alias("_pages"), F.sort_array(F.collect_list(place)).alias("texts"))
    made = written(classes.join(forms, ["_host", "_class"]).mapInArrow(class_trees, "_host string, _class string, _pages long, _tree string"), "classes")
    drop_written(seen)
    while True:
        counts = made.groupBy("_host").agg(F.count("*").alias("_n"))
        if (counts.agg(F.max("_n")).first()[0] or 0) <= 1:
            break
        dealt = made.join(counts, "_host").withColumn("_part", F.pmod(F.xxhash64("_class"), F.ceil(F.col("_n") / FAN)))
        order = dealt.repartition("_host", "_part").sortWithinPartitions("_host", "_part", F.desc("_pages"), "_class")
        new = written(order.select("_host", "_part", "_class", "_tree").mapInArrow(aligned_parts, "_host string, _class string, _pages long, _tree string"), "aligned")
        drop_written(made)
        made = new
    out = written(made.mapInArrow(judged, "_wrapped_host string, _wrapper string"), "wrappers")
    drop_written(made)
    return out


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each page: page_id, url, text, n_chars.

    Wrappers are written first, so that their size decides how they are joined: broadcast while small, else
    by a shuffle whose hot hosts adaptive execution splits.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    base = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), host.alias("_host"), F.coalesce(F.col(html_col), F.lit("")).alias("_text"))
    joined = base.join(wrappers(base), F.col("_host") == F.col("_wrapped_host"), "left").select("_id", "_url", "_host", "_text", "_wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Node] = {}
        for batch in batches:
            for part in slices(batch):
                texts = []
                for i, (host, page) in enumerate(zip(part.column("_host").to_pylist(), part.column("_text").to_pylist(), strict=True)):
                    if host not in known:
                        if len(known) > 500:
                            known.clear()
                        made = part.column("_wrapper")[i].as_py()
                        known[host] = unpacked(json.loads(made)) if made else Node("page")
                    texts.append(main_text(known[host], page))
                cols = [part.column("_id"), part.column("_url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
