"""HTML to text by layout: all visible text, with block spacing, lists and aligned tables.

A tokenizer reads tags, comments, and raw-text elements; a tree builder adds implied
tags (an open p ends before a block, an li before the next li, cells and rows
imply each other, mis-nested and missing end tags are resolved by the stack of open
elements); elements that no browser shows (head, script, style, template, hidden ones, titles and
definitions in svg, annotations in math) give no text, nor does text that is not visible, though elements in it that are made
visible again do; text directly in a row stands before its table. The renderer walks the tree: blocks stand on lines of their own, paragraphs,
headings, lists and tables are set off by an empty line, list items get their marker and
are indented by depth, table cells are padded to the width of their column, and a table's head comes first and its foot last, cells that span rows
or columns keep their place; white space is folded except in pre and textarea.

Defined results: null stays null; an empty page, or one without visible text, gives
an empty text; plain text without tags is kept; unfinished tags at the end are
dropped, a lone < is text; extra columns are left alone; repeated rows give one row each.
Depth is unlimited (no recursion).
"""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist title link meta "
                   "area base param source track rp dialog".split())
FOREIGN = frozenset("svg math".split())
FOREIGN_HIDDEN = frozenset("title desc metadata defs symbol annotation annotation-xml".split())  # inside svg and math
BLOCK = frozenset("address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hgroup hr html legend li listing main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
                  "thead tr ul caption xmp plaintext".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr menu dir listing fieldset".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                   "hgroup hr li main menu nav ol p pre search section summary table ul listing xmp dd dt".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta noframes script style template title".split())
SCOPE = frozenset("html table td th caption template object marquee applet".split())
# start tag -> (elements it ends if open, elements that stop the search)
CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table td th".split())),
    "dd": (frozenset("dd dt".split()), frozenset("dl table td th".split())),
    "dt": (frozenset("dd dt".split()), frozenset("dl table td th".split())),
    "option": (frozenset(["option"]), frozenset("select optgroup datalist".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset(["table"])),
    "td": (frozenset("td th caption colgroup".split()), frozenset("tr table".split())),
    "th": (frozenset("td th caption colgroup".split()), frozenset("tr table".split())),
    "tbody": (frozenset("tr td th tbody thead tfoot caption colgroup".split()), frozenset(["table"])),
    "thead": (frozenset("tr td th tbody thead tfoot caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("tr td th tbody thead tfoot caption colgroup".split()), frozenset(["table"])),
    "caption": (frozenset("caption colgroup".split()), frozenset(["table"])),
    "rt": (frozenset("rt rp".split()), frozenset(["ruby"])),
    "rp": (frozenset("rt rp".split()), frozenset(["ruby"])),
}
BULLET = "* "

_TOKEN = re.compile(r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?P<close>>|\Z)"
                    r"|(?P<bogus>[!?/][^>]*+)(?:>|\Z))", re.DOTALL)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_INVISIBLE = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.IGNORECASE)
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534   # fixed values of the HTML standard
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    """An element; ``hidden`` ones are left out whole, of those that are not ``seen`` the text, but not elements made visible again."""

    __slots__ = ("name", "attrs", "children", "hidden", "seen")

    def __init__(self, name: str, attrs: dict[str, str], seen: bool = True):
        self.name, self.attrs, self.children = name, attrs, []
        own = _VISIBILITY.findall(attrs.get("style", ""))
        self.seen = own[-1].lower() == "visible" if own else seen
        self.hidden = name in HIDDEN and not (name == "dialog" and "open" in attrs) or "hidden" in attrs or (
            name == "input" and attrs.get("type", "").lower() == "hidden") or bool(_INVISIBLE.search(attrs.get("style", "")))


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def parse(html: str) -> Node:
    """The tree of a page, with implied tags added."""
    root = Node("html", {})
    open_: list[Node] = [root]
    depth = {"html": 1}

    def push(name: str, attrs: dict[str, str]) -> None:
        node = Node(name, attrs, open_[-1].seen)
        node.hidden = node.hidden or name in FOREIGN_HIDDEN and any(depth.get(x) for x in FOREIGN)
        open_[-1].children.append(node)
        open_.append(node)
        depth[name] = depth.get(name, 0) + 1

    def pop() -> Node:
        node = open_.pop()
        depth[node.name] -= 1
        return node

    def end_to(i: int) -> list[Node]:
        """Close the open elements from ``i`` on; the formatting ones that were cut are returned."""
        cut = []
        while len(open_) > i:
            cut.append(pop())
        return [n for n in reversed(cut) if n.name in FORMATTING]

    def find(names: frozenset[str], stop: frozenset[str]) -> int:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].name in names:
                return i
            if open_[i].name in stop:
                return 0
        return 0

    def start(name: str, attrs: dict[str, str]) -> None:
        if name in ("html", "body"):
            if name == "body" and depth.get("head"):
                end_to(find(frozenset(["head"]), frozenset()))
            if attrs.get("style") or "hidden" in attrs:
                open_[0].hidden = open_[0].hidden or Node("div", attrs).hidden
            return
        if depth.get("svg") and name == "text" and open_[-1].children:
            open_[-1].children.append(" ")  # labels stand apart
        if depth.get("head") and name != "head" and name not in HEAD_ONLY and name != "noscript":
            end_to(find(frozenset(["head"]), frozenset()))
        cut: list[Node] = []
        if name in ENDS_P and depth.get("p") and (i := find(frozenset(["p"]), SCOPE)):
            cut = end_to(i)
        if name in CLOSES:
            names, stop = CLOSES[name]
            while any(depth.get(x) for x in names) and (i := find(names, stop)):
                end_to(i)
                cut = []
        if name == "a" and depth.get("a") and (i := find(frozenset(["a"]), SCOPE)):
            end_to(i)
        inside = open_[-1].name
        if name in ("td", "th") and inside != "tr" and depth.get("table"):
            if inside == "table":
                push("tbody", {})
            if open_[-1].name in ("tbody", "thead", "tfoot"):
                push("tr", {})
        elif name == "tr" and inside == "table":
            push("tbody", {})
        for n in cut[:8]:  # formatting goes on in the new block
            push(n.name, n.attrs)
        if name in VOID:
            open_[-1].children.append(Node(name, attrs))
        else:
            push(name, attrs)

    def end(name: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br":
            open_[-1].children.append(Node("br", {}))
            return
        if not depth.get(name) or name == "html":
            if name == "p":
                open_[-1].children.append(Node("p", {}))
            return
        stop = frozenset() if name in ("table", "head") else frozenset(["table"]) if name in ("tr", "tbody", "thead", "tfoot", "caption") else SCOPE - {name}
        i = find(frozenset([name]), stop)
        if i:
            again = end_to(i + 1)
            pop()
            if name not in FORMATTING and name in ("p",):
                return
            if name in FORMATTING:
                for n in again[:8]:
                    push(n.name, n.attrs)

    at, size = 0, len(html)
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            open_[-1].children.append(unescape(html[at:lt]))
            at = lt
            continue
        m = _TOKEN.match(html, at)
        if not m:
            nxt = html.find("<", at + 1)
            nxt = size if nxt < 0 else nxt
            open_[-1].children.append(unescape(html[at:nxt]))
            at = nxt
            continue
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if not m["close"]:
            break
        if m["end"]:
            end(name)
            continue
        attrs = _attributes(m["attrs"]) if m["attrs"] and not m["attrs"].isspace() else {}
        start(name, attrs)
        if m["attrs"].endswith("/") and any(depth.get(x) for x in FOREIGN):  # only foreign elements close themselves
            if open_[-1].name == name:
                pop()
            continue
        if name in RAW or name == "plaintext":
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, at) if name != "plaintext" else None
            stop = close.start() if close else size
            body = html[at:stop]
            if name not in HIDDEN:
                open_[-1].children.append(unescape(body) if name in ("textarea", "title") else body)
            at = (html.find(">", stop) + 1 or size) if close else size
            if open_[-1].name == name:
                pop()
    return root


class _Lines:
    """Text under construction: lines, a pending blank and a pending gap."""

    __slots__ = ("done", "line", "blank", "gap", "indent", "marker")

    def __init__(self):
        self.done: list[str] = []
        self.line: list[str] = []
        self.blank = False
        self.gap = 0
        self.indent = ""
        self.marker = ""

    def text(self, s: str, keep: bool = False) -> None:
        if keep:
            first, *rest = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            if first:
                self._put(first)
            for x in rest:
                self.end(force=True)
                if x:
                    self._put(x)
            return
        words = _BLANK.sub(" ", s)
        if not words or words == " ":
            self.blank = self.blank or bool(words)
            return
        if words[0] == " ":
            self.blank = True
        body = words.strip(" ")
        self._put(body)
        self.blank = words[-1] == " "

    def _put(self, s: str) -> None:
        if not self.line:
            if self.gap and self.done:
                self.done.append("")
            self.gap = 0
            if self.marker:
                self.line.append(self.indent[:-len(self.marker)] + self.marker if len(self.indent) >= len(self.marker) else self.marker)
                self.marker = ""
            elif self.indent:
                self.line.append(self.indent)
        elif self.blank:
            self.line.append(" ")
        self.blank = False
        self.line.append(s)

    def end(self, force: bool = False) -> None:
        if self.line:
            self.done.append("".join(self.line).rstrip(" "))
            self.line = []
        elif force and self.done:
            self.done.append("")
        self.blank = False

    def space(self) -> None:
        self.end()
        self.gap = 1


def _stray(text: str, parent: Node) -> list[Node]:
    """Text that stands directly in a table or a row goes before the table."""
    if not text.strip() or not parent.seen:
        return []
    node = Node("caption", {})
    node.children = [text]
    return [node]


def _cells(table: Node) -> tuple[list[Node], list[list[list[Node]]]]:
    """(captions, sections of rows of cells) of a table: its head first, its foot last; nested tables belong to their cell."""
    captions: list[Node] = []
    sections: dict[int, list[list[list[Node]]]] = {0: [], 1: [[]], 2: []}

    def row(n: Node) -> list[Node]:
        for c in n.children:
            if isinstance(c, str):
                captions.extend(_stray(c, n))
        return [c for c in n.children if not isinstance(c, str) and not c.hidden]
    todo = [(c, table) for c in reversed(table.children)]
    while todo:
        n, parent = todo.pop()
        if isinstance(n, str):
            captions.extend(_stray(n, parent))
        elif n.hidden or n.name in ("col", "colgroup"):
            continue
        elif n.name == "tr":
            sections[1][-1].append(row(n))
        elif n.name in ("tbody", "thead", "tfoot"):
            place = {"thead": 0, "tfoot": 2}.get(n.name, 1)
            own = sections[1 if sections[place] and place != 1 else place]    # a second head or foot is a body
            own.append([])
            for c in n.children:
                if isinstance(c, str):
                    captions.extend(_stray(c, n))
                elif c.name == "tr" and not c.hidden:
                    own[-1].append(row(c))
                elif c.name != "tr":
                    todo.append((c, n))
            sections[1].append([])
        else:
            captions.append(n)
    return captions, [section for place in range(3) for section in sections[place] if section]


def _span(cell: Node, name: str, most: int) -> int:
    text = cell.attrs.get(name, "")
    return max(1, min(most, int(text))) if text.isdecimal() and len(text) < 10 else 1


def layout(section: list[list[Node]]) -> list[list[tuple[int, int, Node | None]]]:
    """For each row its (column, columns, cell) from left to right; a cell from a row above is None there."""
    out, taken = [], {}       # taken: first column -> (columns, rows left) of cells that reach down
    for row in section:
        here = [(at, n, None) for at, (n, _) in taken.items()]
        busy = {at + i for at, n, _ in here for i in range(n)}
        left = {at: (n, rows - 1) for at, (n, rows) in taken.items() if rows > 1}
        at = 0
        for cell in row:
            while at in busy:
                at += 1
            n, rows = _span(cell, "colspan", MAX_COLSPAN), _span(cell, "rowspan", MAX_ROWSPAN)
            here.append((at, n, cell))
            if rows > 1:
                left[at] = n, rows - 1
            at += n
        out.append(sorted(here, key=lambda c: c[0]))
        taken = left
    return out


def _table(out: _Lines, table: Node) -> Generator[Node, list[str], None]:
    captions, sections = _cells(table)
    for c in captions:
        for line in (yield c):
            out.text(line, keep=True)
            out.end()
    rows = []
    for section in sections:
        for placed in layout(section):
            row = []
            for at, n, cell in placed:
                row.append((at, n, (yield cell) if cell else []))
            rows.append(row)
    width: dict[int, int] = {}
    for row in rows:
        for at, n, cell in row:
            if n == 1:
                width[at] = max(width.get(at, 0), max(map(len, cell), default=0))
    for row in rows:
        for k in range(max((len(cell) for _, _, cell in row), default=0)):
            line, end = [], 0
            for at, n, cell in row:
                line += ["".ljust(width.get(i, 0)) for i in range(end, at)]
                room = sum(width.get(at + i, 0) for i in range(n)) + 3 * (n - 1)
                line.append((cell[k] if k < len(cell) else "").ljust(room))
                end = at + n
            written = " | ".join(line).rstrip()
            if written.strip(" |"):
                out.text(written, keep=True)
                out.end()


def render_lines(root: Node) -> list[str]:
    """The lines of a subtree; what its tables hold is rendered first, on a stack of its own."""
    stack, lines = [_render(root)], None
    while stack:
        try:
            stack.append(_render(stack[-1].send(lines)))
            lines = None
        except StopIteration as done:
            stack.pop()
            lines = done.value
    return lines


def _render(root: Node) -> Generator[Node, list[str], list[str]]:
    """The lines of a subtree; asks for those of the nodes it yields."""
    out, pre = _Lines(), 0
    # (node, entering, indent to restore)
    lists: list[list] = []
    todo: list[tuple] = [(root, True)]
    while todo:
        n, entering = todo.pop()
        if isinstance(n, str):
            out.text(n, pre > 0)
            continue
        name = n.name
        if entering:
            if n.hidden:
                continue
            if name == "br":
                out.end(force=True)
                continue
            if name == "hr" and n.seen:
                out.space()
                out.text("---")
                out.space()
                continue
            if name == "img" and n.seen and n.attrs.get("alt"):
                out.text(n.attrs["alt"])
                continue
            if name == "input" and n.seen and n.attrs.get("value") and n.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number"):
                out.text(" " + n.attrs["value"] + " ")
                continue
            if name == "table" and n is not root:
                out.space()
                yield from _table(out, n)
                out.space()
                continue
            if name in SPACED and not (name in ("ul", "ol", "menu", "dir") and lists):
                out.space()
            elif name in BLOCK:
                out.end()
            if name in ("ul", "ol", "menu", "dir"):
                begin = n.attrs.get("start", "1")
                lists.append([name, int(begin) - 1 if re.fullmatch(r"-?[0-9]{1,9}", begin) else 0])
            elif name == "li":
                kind = lists[-1] if lists else ["ul", 0]
                kind[1] += 1
                mark = f"{kind[1]}. " if kind[0] == "ol" else BULLET
                n.attrs["\0indent"] = out.indent
                out.indent, out.marker = out.indent + " " * len(mark), mark
            elif name in ("blockquote", "dd"):
                n.attrs["\0indent"] = out.indent
                out.indent += "  "
            elif name in ("pre", "textarea", "listing", "xmp"):
                pre += 1
            todo.append((n, False))
            todo.extend((c, True) for c in reversed(n.children) if n.seen or not isinstance(c, str))
        else:
            if name in ("ul", "ol", "menu", "dir"):
                lists.pop()
            if name in SPACED and not (name in ("ul", "ol", "menu", "dir") and lists):
                out.space()
            elif name in BLOCK:
                out.end()
            if "\0indent" in n.attrs:
                out.indent, out.marker = n.attrs["\0indent"], ""
            if name in ("pre", "textarea", "listing", "xmp"):
                pre -= 1
    out.end()
    lines = out.done
    while lines and not lines[-1]:
        lines.pop()
    return lines


def to_text(html: str | None) -> str | None:
    return None if html is None else "\n".join(render_lines(parse(html)))


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, text, n_chars, n_lines), one row per page."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [to_text(t.as_py()) for t in batch.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), pa.array(texts, pa.string()), pa.array([None if t is None else len(t) for t in texts], pa.int64()),
                     pa.array([None if t is None else t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                    names=["page_id", "text", "n_chars", "n_lines"])
    from pyspark.sql import functions as F
    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(html).alias("html")).mapInArrow(
        look, "page_id long, text string, n_chars long, n_lines long")
