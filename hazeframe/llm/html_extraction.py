"""Main text of HTML pages by wrapper induction.

Pages of a host are made by the same templates.  Their DOM trees are aligned by simple
tree matching: texts match if they are equal, elements if texts below them do, and
matched children keep their order.  A text that most pages keep in place belongs to
the template, those that vary are slots, and the slots' text is content, unless the
markup itself says that they are menus, adverts, forms, notices, comments and the like.
A form, or a word that may as well name a subject ("related work"), is no proof: such a
container's text, links and controls are weighed against it, and so is a short article
against much more text beside it.

Only texts that recur at one path can be constant, so counting these first leaves small
trees to match.  For each such text some of the pages with most of them are pivots, and
every page is matched with all pivots of its group; a pivot's tree has the texts it was
chosen for, so the pivots of a group are together ``PIVOTS`` times its recurring texts.

A host may have several templates, so votes are counted in groups: all its pages, those
of one frame (the outer elements) and those of one shape (all that structure the page).
Pages of a group with the same content outside texts that recur are copies and have one
vote between them.  Votes are sums over the cluster; a group's template is a short
list of text hashes.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Characters outside links of a long block; the share of links that prose stays below, and that long prose does.
LONG = 100
LINKED, FEW_LINKED = 1 / 3, 0.1
# Text outside all articles, to theirs, beyond which an article is a teaser.
BESIDE = 2
# Levels of elements below the root that are a page's frame.
FRAME = 3
# Pages that must agree at least, and the share of votes that makes a node constant.
LEAST_VOTES = 3
CONSTANT = 0.6
# Share of a group's pages that have a text which says nothing of what they are about.
RECURS = 0.1
# Pages that are pivots for a text, so that no page in disorder decides alone.
PIVOTS = 3
# Bytes of templates that may be broadcast.
BROADCAST_BYTES = 8 << 20

# HTML's element names by their role, and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body caption html legend li dd dt option optgroup tbody td tfoot th thead tr".split()) | {"li", "dd", "dt"}
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("table ul ol dl select article section main body html div td th".split())
FURNITURE = frozenset("nav footer aside form button select option input dialog menu object canvas fieldset search datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored sponsors promo promotion nav navbar navigation menu topbar "
    "breadcrumb breadcrumbs footer sidebar sidebars widget widgets cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe subscription signup login signin comment comments commentlist disqus respond replies share sharing social related "
    "recommended recommendations pagination pager toolbar copyright masthead skiplink".split()
)
# Words of these that name subjects too, and words that say no more about an element than its look.
DOUBTFUL = frozenset("social related share sharing recommended recommendations promotion respond replies copyright menu sponsor sponsors navigation".split())
LAYOUT = frozenset(
    "area article articles bar block body bottom box button buttons card cards center col column container content entries entry facebook follow footer grid group header heading "
    "icon icons inner item items left link links list media mini module more network networks news outer page panel post posts read reading right row section side stories story "
    "title tools top twitter wrap wrapper".split()
)
CONTROLS = frozenset("label select button".split())
HEADERS = frozenset(["header", "masthead"])
HEADINGS = frozenset("h1 h2 h3".split())
STATES = frozenset("has with without no is".split())
COMMENTS = frozenset("comment ad advert related promo sponsored".split())
MAIN = frozenset(["article", "main"])
STRUCTURE = frozenset("html body center div section article main header footer nav aside form fieldset".split())
DOUBTS = frozenset(["form", "doubt", "subject"])
# Names of a control say as little as links do.
LINKS = frozenset(["a", "label"])
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd td".split())
P, NOT_P = frozenset(["p"]), BLOCKS - {"p"}
# Blocks nested deeper belong to the block at this depth.
DEPTH = 150

_TAG = re.compile(
    r"""<(?:!--.*?(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*>)""", re.S
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


class Node:
    """An element: label, role in the page, children in order (elements and texts)."""

    __slots__ = ("children", "label", "leaves", "odd", "tag")

    def __init__(self, tag: str, label: str, odd: str):
        self.tag, self.label, self.odd = tag, label, odd
        self.children: list[Node | str] = []
        self.leaves: list[tuple] | None = None


def _furniture(tag: str, attributes: str) -> tuple[str, str]:
    """Class words as a label; and "drop", "header", "form", "doubt", "subject" or "" for the element."""
    names, role, hidden = [], "", False
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        value, name = "".join(values).lower(), name.lower()
        if name in ("class", "id"):
            # "has-sidebar" says something about what is beside the element.
            names += [n for token in value.split() if (parts := _PARTS.split(token))[0] not in STATES for n in parts]
        elif name == "role":
            role = value.strip()
        else:
            hidden = hidden or name == "hidden" or value == "true"
    label = ".".join(n for n in names if n and not n.isdigit())
    if tag in ("body", "html") or tag == "main":
        return label, ""
    words = WORDS.intersection(names)
    if tag == "article":
        return label, "drop" if words & COMMENTS else ""
    if hidden or tag in FURNITURE - {"form"} or words - HEADERS - DOUBTFUL or role in ROLES - {"banner"}:
        return label, "drop"
    if tag == "form":
        return label, "form"
    if words & DOUBTFUL:
        return label, "subject" if any(len(n) > 3 and n.isalpha() for n in set(names) - WORDS - LAYOUT) else "doubt"
    return label, "header" if tag == "header" or HEADERS.intersection(names) or role == "banner" else ""


def parse(page: str) -> Node:
    """The DOM of a page, without scripts, styles, comments and the head's raw texts; any markup will do."""
    root = Node("html", "html", "")
    stack, at, size = [root], 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            _close(stack, tag)
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = size if end is None else end.start()
            continue
        if tag in ("html", "head"):
            continue
        if tag in CLOSES_P:
            _end(stack, P, NOT_P)
        if tag in SIBLINGS:
            _end(stack, SIBLINGS[tag], SCOPES - SIBLINGS[tag])
        if tag in MAIN:
            # A form around the main part is the whole page's, not one to fill in.
            for outer in stack:
                outer.odd = "" if outer.tag == "form" else outer.odd
        node = Node(tag, *_furniture(tag, m[3] or m[6] or ""))
        stack[-1].children.append(node)
        if tag not in VOID:
            stack.append(node)
    return root


def _end(stack: list[Node], tags: frozenset[str] | set[str], stop: frozenset[str]) -> None:
    """End the nearest open element of ``tags``, unless one of ``stop`` stands before it."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in stop:
            return


def _close(stack: list[Node], tag: str) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        # An inline end tag does not end a block.
        if tag not in BLOCKS and stack[k].tag in BLOCKS:
            return


def _has_heading(node: Node) -> bool:
    todo = [node]
    while todo:
        one = todo.pop()
        if one.tag in HEADINGS:
            return True
        todo += [c for c in one.children if isinstance(c, Node)]
    return False


class Doubt:
    """What speaks for and against a container that may be furniture; ``outer`` is the number of the one around it."""

    def __init__(self, kind: str, outer: int):
        self.kind, self.outer = kind, outer
        self.chars = self.linked = self.longest = self.paragraphs = self.controls = 0

    def add(self, chars: int, linked: int, longest: int, paragraphs: int) -> None:
        self.chars += chars
        self.linked += linked
        self.longest = max(self.longest, longest)
        self.paragraphs += paragraphs

    def is_content(self, beside: int) -> bool:
        """Prose that is named as a subject, or long, or outweighs the text ``beside`` it; of a form, only the last.

        A form has to have more paragraphs than controls, too.
        """
        if not self.paragraphs or self.linked > LINKED * self.chars:
            return False
        outweighs = self.chars - self.linked >= beside
        if self.kind == "form":
            return outweighs and self.paragraphs > self.controls
        return outweighs or self.kind == "subject" or self.longest >= LONG and self.linked <= FEW_LINKED * self.chars


class Page:
    """Blocks of text of a page, each with its place in the tree.

    A block is ``(path, text, state, linked)``: labels from the root, text with single
    spaces, whether the markup keeps it ("", "main" within the main element, "drop"),
    and the characters of it that are link texts.  Elements that hold blocks are the
    tree that is matched.
    """

    def __init__(self, page: str):
        self.blocks: list[list] = []
        # Containers in doubt, by number; 0 is none.
        self._doubts = [Doubt("", 0)]
        self._marked = False
        self.tree = self._walk(parse(page), "", "")
        self._weigh()
        self.has_main = any(b[2] == "main" for b in self.blocks)

    def _weigh(self) -> None:
        """Decide on the containers in doubt, inner ones first, and on articles that are teasers."""
        sure = self._doubts[0]
        for path, text, state, linked, doubt in self.blocks:
            if state != "drop":
                last = path.rpartition("/")[2].partition(".")[0]
                own = len(text) - linked
                self._doubts[doubt].add(len(text), linked, own, own > 0 and (last in PARAGRAPHS))
        beside, kept = sure.chars - sure.linked, [True] * len(self._doubts)
        for n in range(len(self._doubts) - 1, 0, -1):
            one = self._doubts[n]
            kept[n] = one.is_content(beside)
            outer = self._doubts[one.outer]
            outer.controls += one.controls
            if kept[n] and one.outer:
                outer.add(one.chars, one.linked, one.longest, one.paragraphs)
        for n in range(1, len(kept)):
            kept[n] = kept[n] and kept[self._doubts[n].outer]
        for b in self.blocks:
            b[2] = b[2] if kept[b.pop()] else "drop"
        if not self._marked:
            article = sum(len(b[1]) - b[3] for b in self.blocks if b[2] == "main")
            rest = sum(len(b[1]) - b[3] for b in self.blocks if b[2] == "" and len(b[1]) - b[3] >= LONG)
            if rest > BESIDE * article:
                for b in self.blocks:
                    b[2] = "" if b[2] == "main" else b[2]

    def _walk(self, root: Node, path: str, state: str) -> tuple:
        """Iterative, as markup can nest without end; gives (label, children), where a block is its number."""
        top: list = ["", []]
        # Open block: texts, link characters.
        text: list[str] = []
        linked = 0
        here = (path, state, 0)
        todo: list[tuple] = [("enter", root, path, state, top[1], False, 0, 0)]

        def flush(into: list) -> None:
            nonlocal linked
            if text:
                joined = " ".join(references.unescape("".join(text)).split())
                if joined:
                    into.append(len(self.blocks))
                    self.blocks.append([here[0], joined, here[1], min(linked, len(joined)), here[2]])
                text.clear()
            linked = 0

        while todo:
            what, node, path, state, into, link, depth, doubt = todo.pop()
            if what == "text":
                text.append(node)
                linked += len(node) if link else 0
                continue
            if what == "leave":
                here = (path, state, doubt)
                flush(into)
                continue
            block = node.tag in BLOCKS or node.odd not in ("", "header")
            self._doubts[doubt].controls += node.tag in CONTROLS
            if block:
                here = (path, state, doubt)
                flush(into)
                if state != "drop":
                    # The header of an article is the one with its heading.
                    inner = node.odd == "drop" or node.odd == "header" and not (state == "main" and _has_heading(node))
                    state = "drop" if inner else "main" if node.tag in MAIN or state == "main" else state
                    self._marked = self._marked or node.tag == "main"
                    if node.odd in DOUBTS:
                        self._doubts.append(Doubt(node.odd, doubt))
                        doubt = len(self._doubts) - 1
                children = into
                if depth < DEPTH:
                    path = f"{path}/{node.tag}.{node.label}" if node.label else f"{path}/{node.tag}"
                    children = []
                    into.append((f"{node.tag}.{node.label}", children))
            else:
                children = into
                if node.tag == "br":
                    text.append(" ")
            link = link or node.tag in LINKS
            depth += block
            later = [("leave", None, path, state, children, False, depth, doubt)] if block else []
            for child in reversed(node.children):
                # Text of a block's own, between its blocks, is flushed where they begin.
                later.append(("text" if isinstance(child, str) else "enter", child, path, state, children, link, depth, doubt))
            todo += later
        here = ("", "", 0)
        flush(top[1])
        return ("", top[1])

    def nesting(self) -> list[tuple[int, int]]:
        """Per block how many elements of the tree it is in, and how many of them the block before is in too."""
        out, common = [], 0
        todo: list[tuple] = [(child, 0) for child in reversed(self.tree[1])]
        while todo:
            one, depth = todo.pop()
            if one is None:
                common = min(common, depth - 1)
            elif isinstance(one, int):
                out.append((depth, common))
                common = depth
            else:
                todo.append((None, depth + 1))
                todo += [(child, depth + 1) for child in reversed(one[1])]
        return out


def prune(nesting: list[tuple[int, int]], wanted: list[bool]) -> list[tuple[int, int]]:
    """The nesting of the wanted blocks alone."""
    out, common = [], 0
    for (depth, shared), keep in zip(nesting, wanted, strict=True):
        common = min(common, shared)
        if keep:
            out.append((depth, common))
            common = depth
    return out


def tree_of(keys: list[int], nesting: list[tuple[int, int]]) -> list:
    """Nested lists of keys."""
    root: list = []
    path = [root]
    for key, (depth, common) in zip(keys, nesting, strict=True):
        del path[common + 1 :]
        while len(path) <= depth:
            path[-1].append([])
            path.append(path[-1][-1])
        path[-1].append(key)
    return root


def _key_sets(tree: list) -> dict[int, set[int]]:
    """Keys below each list, by its identity; children with no key that those before them lack are taken out."""
    found: dict[int, set[int]] = {}
    todo = [(tree, False)]
    while todo:
        one, done = todo.pop()
        if not done:
            todo.append((one, True))
            todo += [(c, False) for c in one if isinstance(c, list)]
            continue
        have: set[int] = set()
        kept = []
        for c in one:
            new = found[id(c)] if isinstance(c, list) else {c}
            if not new <= have:
                have |= new
                kept.append(c)
        one[:] = kept
        found[id(one)] = have
    return found


def align(a: list, b: list) -> set[int]:
    """Simple tree matching of two trees of text keys: the keys that are aligned.

    Equal keys match, lists match if their parents do, and matched children are in the
    same order on both sides; as many texts as can be are aligned.  Children are paired
    through the keys they have in common, and the heaviest chain of pairs that rises on
    both sides is found with a tree of prefix maxima.
    """
    sets = {**_key_sets(a), **_key_sets(b)}

    def solve(x: list, y: list) -> tuple[int, tuple | None]:
        where: dict[int, list[int]] = {}
        for j, d in enumerate(y):
            for k in sets[id(d)] if isinstance(d, list) else (d,):
                where.setdefault(k, []).append(j)
        best: list[tuple[int, tuple | None]] = [(0, None)] * (len(y) + 1)

        def upto(j: int) -> tuple[int, tuple | None]:
            top = best[0]
            while j > 0:
                top = max(top, best[j], key=_weight)
                j &= j - 1
            return top

        for c in x:
            deep = isinstance(c, list)
            found = []
            for j in sorted({j for k in (sets[id(c)] if deep else (c,)) for j in where.get(k, ())}):
                if isinstance(y[j], list) == deep:
                    weight, inner = solve(c, y[j]) if deep else (1, (None, c))
                    before, link = upto(j)
                    found.append((j + 1, (before + weight, (link, inner))))
            for j, value in found:
                while j <= len(y):
                    best[j] = max(best[j], value, key=_weight)
                    j += j & -j
        return upto(len(y))

    aligned, todo = set(), [solve(a, b)[1]]
    while todo:
        one = todo.pop()
        if one is not None:
            link, inner = one
            todo.append(link)
            if isinstance(inner, int):
                aligned.add(inner)
            else:
                todo.append(inner)
    return aligned


def _weight(one: tuple) -> int:
    return one[0]


def text_key(block: list) -> int:
    """Hash of a block's place and text."""
    data = f"{block[0]}\n{block[1]}".encode()
    return zlib.crc32(data) << 32 | zlib.crc32(data[::-1], 0x9E3779B9)


def _wanted(page: Page) -> list[list]:
    """Blocks that the markup keeps: those of the main part, if there is one."""
    wanted = "main" if page.has_main else ""
    return [b for b in page.blocks if b[2] == wanted]


def _in_list(block: list) -> bool:
    return block[3] >= len(block[1]) and block[0].rpartition("/")[2].startswith("li")


def _menus(page: Page, blocks: list[list]) -> list[int]:
    """Per block the number of the list of links it is in, or 0.

    Lists in a marked main part are content, and so are those that follow more text
    in the same element than they have themselves.
    """
    if page.has_main:
        return [0] * len(blocks)
    out, sizes = [], Counter()
    for b in blocks:
        if _in_list(b):
            sizes[b[0]] += len(b[1])
    before: Counter = Counter()
    for b in blocks:
        outer = b[0].rpartition("/")[0]
        if _in_list(b):
            out.append(0 if before[outer.rpartition("/")[0]] > sizes[b[0]] else zlib.crc32(b[0].encode()) + 1)
        else:
            out.append(0)
            before[outer] += len(b[1]) - b[3]
    return out


def _joined(blocks: list[tuple[int, str]]) -> str:
    """Texts one a line, without lists of links outside any marked menu; a block has the number of its list or 0."""
    menus = Counter(m for m, _ in blocks if m)
    return "\n".join(t for m, t in blocks if not m or menus[m] < 3)


def main_text(page: Page, constant: frozenset[int] | set[int] = frozenset()) -> str:
    """Blocks of the page's slots, one a line."""
    wanted = _wanted(page)
    return _joined([(m, b[1]) for m, b in zip(_menus(page, wanted), wanted, strict=True) if not (constant and text_key(b) in constant)])


def _content_key(block: list) -> int:
    """Hash of a block's text without digits, which tell no copies apart; 0 if there are no letters."""
    words = _NUMBER.sub("", block[1])
    return zlib.crc32(words.encode()) << 32 | zlib.crc32(block[0].encode()) if _LETTER.search(words) else 0


def shapes(page: Page) -> tuple[int, int]:
    """Hashes of a page's frame and of its shape: the places of the elements that structure it."""
    found = set()
    for path in {b[0] for b in page.blocks}:
        parts = path.split("/")[1:]
        n = next((k for k, x in enumerate(parts) if x.partition(".")[0] not in STRUCTURE), len(parts))
        found.update(tuple(parts[:k]) for k in range(1, n + 1))
    frame = {x for x in found if len(x) <= FRAME + 1}
    return tuple(zlib.crc32(t) << 32 | zlib.crc32(t[::-1], 0x9E3779B9) for t in ("\n".join(sorted("/".join(x) for x in y)).encode() for y in (frame, found)))


_NUMBER = re.compile(r"\d+")
_LETTER = re.compile(r"[^\W\d_]")
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_PARSED = pa.schema(
    [("shapes", _LONGS), ("keys", _LONGS), ("contents", _LONGS), ("menus", _LONGS), ("texts", pa.list_(pa.string())), ("depths", _INTS), ("common", _INTS)]
)
_PARSED_SQL = "shapes array<long>, keys array<long>, contents array<long>, menus array<long>, texts array<string>, depths array<int>, common array<int>"


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each page that can be content, the keys by which they are counted, and those of link lists."""
    for batch in batches:
        rows = []
        for html in batch.column("html"):
            page = Page(html.as_py())
            kept = _wanted(page)
            menus = _menus(page, kept)
            main = "main" if page.has_main else ""
            nesting = prune(page.nesting(), [b[2] == main for b in page.blocks])
            keys, contents = [_signed(text_key(b)) for b in kept], [_signed(_content_key(b)) for b in kept]
            rows.append(([*map(_signed, shapes(page))], keys, contents, menus, [b[1] for b in kept], [d for d, _ in nesting], [c for _, c in nesting]))
        columns = list(zip(*rows, strict=True)) or [()] * len(_PARSED)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _PARSED, strict=True)]
        yield pa.record_batch([*(batch.column(c) for c in ("page_id", "url", "host")), *arrays], names=["page_id", "url", "host", *_PARSED.names])


def _only(keys: list[int], depths: list[int], common: list[int], wanted: set[int]) -> tuple[list[int], list[tuple[int, int]]]:
    """Those of a page's keys that are wanted, and their nesting."""
    here = [k in wanted for k in keys]
    return [k for k, keep in zip(keys, here, strict=True) if keep], prune(list(zip(depths, common, strict=True)), here)


def _pivot_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pivots with the texts alone that they were chosen for."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("keys", "depths", "common", "chosen")]
        rows = [_only(keys, depths, common, set(chosen)) for keys, depths, common, chosen in zip(*columns, strict=True)]
        parts = [[k for k, _ in rows], [[d for d, _ in n] for _, n in rows], [[c for _, c in n] for _, n in rows]]
        arrays = [pa.array(part, kind) for part, kind in zip(parts, (_LONGS, _INTS, _INTS), strict=True)]
        yield pa.record_batch([batch.column("group"), *arrays], names=["group", "keys", "depths", "common"])


def _votes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a page keeps in place of its group's pivots, and a hash of its content outside texts that recur."""
    for batch in batches:
        own, shared = [], []
        for keys, contents, depths, common, recurring, pivots in zip(
            *(batch.column(c).to_pylist() for c in ("keys", "contents", "depths", "common", "recurring", "pivots")), strict=True
        ):
            recurring = set(recurring)
            left = sorted({c for k, c in zip(keys, contents, strict=True) if c and k not in recurring})
            data = ",".join(map(str, left)).encode()
            own.append(_signed(zlib.crc32(data) << 32 | zlib.crc32(data[::-1], 0x9E3779B9)))
            aligned: set[int] = set()
            for pivot in pivots:
                here = _only(keys, depths, common, set(pivot["keys"]))
                if here[0]:
                    aligned |= align(tree_of(*here), tree_of(pivot["keys"], list(zip(pivot["depths"], pivot["common"], strict=True))))
            # The key 0 counts the pages that vote.
            shared.append([0, *aligned])
        yield pa.record_batch([batch.column("group"), pa.array(own, pa.int64()), pa.array(shared, _LONGS)], names=["group", "own", "shared"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for keys, menus, blocks, constant in zip(*(batch.column(c).to_pylist() for c in ("keys", "menus", "texts", "constant")), strict=True):
            constant = set(constant or ())
            texts.append(_joined([(m, t) for k, m, t in zip(keys, menus, blocks, strict=True) if k not in constant]))
        yield pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without port and login; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def _small(df: DataFrame) -> DataFrame:
    """The stored frame, to be broadcast if its size allows."""
    row = df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()
    return F.broadcast(df) if (row[0] or 0) <= BROADCAST_BYTES else df


def _groups(parsed: DataFrame) -> DataFrame:
    """The parsed pages with the groups they vote in: their host, frame and shape."""
    shapes = F.concat(F.array(F.lit(0).cast("long")), F.col("shapes"))
    ids = F.transform(shapes, lambda x, level: F.xxhash64(F.col("host"), level, x))
    return parsed.withColumn("groups", F.when(F.col("host").isNotNull() & (F.size("keys") > 0), ids))


def induce(pages: DataFrame) -> DataFrame:
    """``shape``, ``constant``: hashes of the template's blocks.  ``pages`` has ``groups``, ``keys``, ``contents``, ``depths`` and ``common``.

    ``shape`` is the last of a page's groups, which the others follow from.
    """
    sets = pages.where("groups IS NOT NULL").select("groups", F.array_sort("keys").alias("sorted"), "keys", "contents", "depths", "common")
    # Pages that are equal are one.
    known = sets.groupBy("groups", F.xxhash64("sorted").alias("page")).agg(F.min(F.struct("keys", "contents", "depths", "common")).alias("one"))
    known = common.store(known.select("groups", "page", "one.*"), "page-keys")
    counted = known.select(F.explode("groups").alias("group"), F.concat(F.array(F.lit(0).cast("long")), F.array_distinct("keys")).alias("keys"))
    counted = common.store(counted.select("group", F.explode("keys").alias("key")).groupBy("group", "key").agg(F.count("*").alias("pages")), "counts")
    sizes = counted.where(f"key = 0 AND pages >= {LEAST_VOTES}").select("group", F.col("pages").alias("size"))
    often = counted.where(f"key != 0 AND pages >= {LEAST_VOTES}").join(sizes, "group").where(F.col("pages") >= F.col("size") * RECURS)
    # At most 1 / RECURS times the blocks of a page, on average.
    often = common.store(often.groupBy("group").agg(F.collect_list("key").alias("recurring")), "recurring")
    # The pivots of a text are pages that have most of the texts that recur.
    having = known.select(F.explode("groups").alias("group"), "page", "keys").join(_small(often), "group")
    having = having.select("group", "page", F.array_intersect("keys", "recurring").alias("keys")).where(F.size("keys") > 0)
    having = having.select("group", F.size("keys").alias("n"), "page", F.explode("keys").alias("key"))
    most = [F.max(F.struct("n", F.xxhash64("page", F.lit(k)), "page"))["page"] for k in range(PIVOTS)]
    chosen = having.groupBy("group", "key").agg(F.array_distinct(F.array(*most)).alias("pages"))
    chosen = chosen.select("group", "key", F.explode("pages").alias("page")).groupBy("group", "page").agg(F.collect_list("key").alias("chosen"))
    chosen = common.store(chosen, "chosen")
    pivots = known.select(F.explode("groups").alias("group"), "page", "keys", "depths", "common").join(_small(chosen), ["group", "page"])
    pivots = pivots.select("group", "keys", "depths", "common", "chosen").mapInArrow(_pivot_of, "group long, keys array<long>, depths array<int>, common array<int>")
    pivots = pivots.groupBy("group").agg(F.collect_list(F.struct("keys", "depths", "common")).alias("pivots"))
    aligning = common.store(often.join(pivots, "group"), "pivots")
    voting = known.select(F.explode("groups").alias("group"), "keys", "contents", "depths", "common").join(_small(aligning), "group")
    voting = voting.select("group", "keys", "contents", "depths", "common", "recurring", "pivots").mapInArrow(_votes_of, "group long, own long, shared array<long>")
    votes = voting.select("group", "own", F.explode("shared").alias("key")).distinct().groupBy("group", "key").agg(F.count("*").alias("votes"))
    votes = common.store(votes, "votes")
    voters = votes.where("key = 0").select("group", F.col("votes").alias("voters"))
    constant = votes.where("key != 0").join(voters, "group").where((F.col("votes") >= LEAST_VOTES) & (F.col("votes") >= F.col("voters") * CONSTANT))
    constant = common.store(constant.select("group", "key"), "constant")
    shapes = known.select(F.element_at("groups", -1).alias("shape"), "groups").distinct().select("shape", F.explode("groups").alias("group"))
    return common.store(shapes.join(constant, "group").groupBy("shape").agg(F.collect_set("key").alias("constant")), "wrappers")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` (blocks of the main text, one a line), ``n_chars``.

    White space in a block is one space, references are decoded.  Where the page marks
    its main part (article, main), text comes from there.  A null or empty page has
    an empty text.  A page whose URL is null or has no host is read without a
    template, and so is the only page of a host.  Rows are read one by one, repeated
    ones alike.  Other columns are not looked at.  An empty table gives no rows.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    id_type = pages.schema[id_col].dataType.simpleString()
    parsed = rows.mapInArrow(_parse, f"page_id {id_type}, url string, host string, {_PARSED_SQL}")
    parsed = _groups(common.store(parsed, "blocks"))
    wrappers = induce(parsed)
    joined = parsed.withColumn("shape", F.element_at("groups", -1)).join(_small(wrappers), "shape", "left")
    joined = joined.select("page_id", "url", "keys", "menus", "texts", "constant")
    return joined.mapInArrow(_extract, f"page_id {id_type}, url string, text string, n_chars long")
