"""HTML to text by layout-aware rendering.

A tree builder reads the page with implied tags (an open paragraph ends before a block, a list item
before the next one, a cell or row before the next one, missing ends at the end), visibility rules
leave out what a browser wouldn't show, and a renderer emits all other text: blocks on lines of
their own with blank lines where a browser leaves space, list items with markers and indents, and
table cells padded so that columns align.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import bytesets as bs

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript title iframe noembed noframes datalist audio video canvas object map param rp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table ul caption optgroup option search".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table pre blockquote figure hr fieldset".split())
#: Tags before which an open element of the key's tag ends, and the elements that keep it open.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
}
#: Depth beyond which elements become siblings, as browsers do; no text is lost.
MAX_DEPTH = 150

# A quote opens a string only after "="; a value without quotes ends at a space or ">".
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>]*+))?)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]*+))?""")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_BRACE = re.compile(r"""[{};]|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'""")
_FIRST = re.compile(r"\s*+")
_MEDIA = re.compile(r"(?:only\s+)?(?:all|screen)")
_SIMPLE = re.compile(r"[.#]?[\w-]+")
_COMPOUND = re.compile(r"""(?:[\w-]+|\*)?(?:[.#][\w-]+|\[[^\]]*\]|:[\w-]+(?:\([^()]*\))?)*""")
_NAMED = re.compile(r"\[\s*[\w-]+\s*\]")
_PART = re.compile(r"""[.#]?[\w-]+|\[[^\]]*\]|:[\w-]+(?:\([^()]*\))?|\*""")
#: States that an element doesn't have unless the reader does something.
_STATES = frozenset(":hover :focus :focus-within :focus-visible :active :target :visited :checked :before :after".split())
#: What hides an element, by property, and values that leave visibility as it is around the element.
UNSEEN = {"display": frozenset(["none"]), "visibility": frozenset(["hidden", "collapse"])}
_NEUTRAL = frozenset("inherit unset revert revert-layer".split())
#: Precedence of what the page's own attributes say: ``hidden`` gives way to any rule, ``style`` to none
#: but important ones.
_ATTRIBUTE_RANK, _INLINE_RANK = (-1, 0, 0), (1 << 30, 0, 0)
#: Layout only, no text depends on it: the most characters that a column is padded to, or that a run of
#: empty cells takes; half of it in a table inside a cell, and so on. Longer cells run over.
MAX_WIDTH = 512


@dataclass(slots=True)
class Node:
    tag: str
    attributes: str = ""
    children: list = field(default_factory=list)
    parent: Node | None = None
    shown: bool = True  # has a place in the layout
    seen: bool = True  # its own text is visible

    def attribute(self, name: str) -> str | None:
        if name not in self.attributes.lower():
            return None
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return unescape((m[2] or "").strip("\"'"))
        return None


@dataclass(slots=True)
class Styles:
    """What the page's styles say on visibility, each with its precedence in the cascade, and its title.

    ``hides``: per simple selector (tag, .class, #id) and property, from rules that surely hold on a
    screen; ``hides_by_path``: the same of longer selectors. ``shows``: of rules of any selector that
    may hold there. The latter two hold {(property, selector): (precedence, steps)} by an id, class or tag that the
    selector asks of the element (``*``: none).
    """

    hides: dict[str, dict[str, tuple]] = field(default_factory=dict)
    hides_by_path: dict[str, dict[tuple[str, str], tuple[tuple, list]]] = field(default_factory=dict)
    shows: dict[str, dict[tuple[str, str], tuple[tuple, list]]] = field(default_factory=dict)
    rules: int = 0
    title: str | None = None
    tables: int = 0  # around what is rendered


def build_tree(page: str) -> tuple[Node, Styles]:
    """The tree, and what the page's styles say on visibility."""
    root = Node("#root")
    stack, at, hidden = [root], 0, Styles()
    find, n, last = page.find, len(page), page.rfind(">")

    def text(value: str) -> None:
        if value:
            stack[-1].children.append(unescape(value) if "&" in value else value)

    while at < n:
        lt = find("<", at)
        if lt < 0:
            text(page[at:])
            break
        if lt > at:
            text(page[at:lt])
        if page.startswith("<!--", lt):
            end = find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt) if lt < last else None
        if m is None:
            text("<")
            at = lt + 1
            continue
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            _end(stack, tag)
            continue
        _imply_ends(stack, tag)
        node = Node(tag, m[3], parent=stack[-1])
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            raw = page[at:end.start() if end else n]
            if tag == "style":
                _read_rules(_COMMENT.sub(" ", raw), hidden, _media(node.attribute("media") or ""))
            elif tag == "textarea":
                node.children.append(unescape(raw))
            elif tag == "title" and hidden.title is None:
                hidden.title = _SPACES.sub(" ", unescape(raw)).strip(" ")
            at = n if end is None else (find(">", end.end()) + 1 or n)
        elif tag not in VOID and len(stack) < MAX_DEPTH:
            stack.append(node)
    return root, hidden


def _imply_ends(stack: list[Node], tag: str) -> None:
    if tag in BLOCK:
        _close(stack, frozenset(["p"]), frozenset(["button", "td", "th", "caption", "table", "object"]))
    if tag == "body":
        _close(stack, frozenset(["head"]), frozenset())
    rule = CLOSES.get(tag)
    if rule:
        while _close(stack, *rule):
            pass


def _close(stack: list[Node], tags: frozenset[str], keep: frozenset[str]) -> bool:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return True
        if stack[k].tag in keep:
            return False
    return False


def _end(stack: list[Node], tag: str) -> None:
    """The innermost open element of the tag ends, unless a table cell stands between."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        if stack[k].tag in ("td", "th", "caption") and tag not in ("tr", "table", "tbody", "thead", "tfoot"):
            return


def _media(queries: str) -> bool | None:
    """Whether a media list holds on a screen; None: under conditions."""
    parts = [q.strip() for q in queries.lower().split(",")]
    if any(not q or _MEDIA.fullmatch(q) for q in parts):
        return True
    screen = [q for q in parts if q.startswith("(") or re.match(r"(?:only\s+)?(?:all|screen)\s+and\b|not\s+(?!all|screen)", q)]
    return None if screen else False


def _read_rules(style: str, styles: Styles, holds: bool | None) -> None:
    """Gathers the rules of a style sheet; ``holds`` as of :func:`_media`."""
    open_blocks: list[tuple[str, bool | None]] = []
    at, first = 0, _FIRST.match(style).end()
    for m in _BRACE.finditer(style):
        mark = m[0]
        if mark not in "{};" or mark == ";" and (not open_blocks or not open_blocks[-1][0].startswith("@")) and not style.startswith("@", first):
            continue
        body, at = style[at:m.start()].strip(), m.end()
        first = _FIRST.match(style, at).end()
        if mark == "{":
            now = open_blocks[-1][1] if open_blocks else holds
            if body.startswith("@"):
                kind, _, rest = body.lower().partition(" ")
                if not rest and "(" in kind:
                    kind, _, rest = kind.partition("(")
                    rest = "(" + rest
                own = _media(rest) if kind == "@media" else True if kind == "@layer" else None if kind in ("@supports", "@container", "@scope") else False
                now = False if now is False or own is False else None if now is None or own is None else True
            open_blocks.append((body, now))
        elif mark == "}" and open_blocks:
            selectors, now = open_blocks.pop()
            if now is not False and not selectors.startswith("@"):
                _add_rule(selectors, body, styles, now)


def _seen(declarations: str) -> dict[str, tuple[bool, bool]]:
    """(important, hides) of the declaration that decides, per property."""
    out: dict[str, tuple[bool, bool]] = {}
    for declaration in declarations.lower().split(";"):
        name, _, value = declaration.partition(":")
        name = name.strip()
        if name in UNSEEN:
            words = value.replace("!", " !").split()
            important = "!important" in words or words[-2:] == ["!", "important"]
            if words and (important or not out.get(name, (False,))[0]) and (name == "display" or words[0] not in _NEUTRAL):
                out[name] = important, words[0] in UNSEEN[name]
    return out


def _add_rule(selectors: str, declarations: str, styles: Styles, surely: bool | None) -> None:
    styles.rules += 1
    for name, (important, hides) in _seen(declarations).items():
        for selector in map(str.strip, selectors.lower().split(",")):
            if hides and not surely:
                continue
            if hides and _SIMPLE.fullmatch(selector):
                rank = (important, _weight([selector]), styles.rules)
                own = styles.hides.setdefault(selector, {})
                own[name] = max(own.get(name, rank), rank)
            elif (steps := _steps(selector)) is not None:
                if hides and not _certain(steps):
                    continue
                rank = (important, _weight([p for _, parts in steps for p in parts]), styles.rules)
                asked = min(steps[-1][1], key=lambda p: "#.".find(p[0]) % 3 if p[0] not in "[:*" else 3)
                rules = (styles.hides_by_path if hides else styles.shows).setdefault("*" if asked[0] in "[:" else asked, {})
                key = (name, selector)
                rules[key] = max(rules.get(key, (rank, steps)), (rank, steps), key=lambda r: r[0])


def _certain(steps: list[tuple[str, list[str]]]) -> bool:
    """Whether :func:`_holds` tells for sure: no siblings, no pseudo-classes, attributes by name alone."""
    return all(combinator in " >" and not any(p[0] == ":" or p[0] == "[" and not _NAMED.fullmatch(p) for p in parts)
               for combinator, parts in steps)


def _steps(selector: str) -> list[tuple[str, list[str]]] | None:
    """(combinator before it, parts) per compound; None for what can't be read or never holds at rest."""
    out, combinator = [], ""
    for token in re.sub(r"\s*([>+~])\s*(?![^\[(]*[\])])", r" \1 ", selector).split():
        if token in (">", "+", "~"):
            combinator = token
        elif _COMPOUND.fullmatch(token):
            parts = _PART.findall(token)
            if _STATES.intersection(parts) or "::" in token:
                return None
            out.append((combinator or " ", parts))
            combinator = ""
        else:
            return None
    return out or None


def _weight(parts: list[str]) -> tuple[int, int, int]:
    kinds = [p[0] for p in parts if p != "*"]
    return kinds.count("#"), sum(k in ".[:" for k in kinds), sum(k not in "#.[:" for k in kinds)


def _matches(node: Node, parts: list[str]) -> bool:
    """Whether the element fits a compound; pseudo-classes and attributes with values may."""
    for p in parts:
        if p[0] == "#":
            fits = (node.attribute("id") or "").lower() == p[1:]
        elif p[0] == ".":
            fits = p[1:] in (node.attribute("class") or "").lower().split()
        elif p[0] == "[":
            fits = node.attribute(re.split(r"[~|^$*=\s\]]", p[1:].strip(), maxsplit=1)[0]) is not None
        else:
            fits = p[0] in ":*" or p == node.tag
        if not fits:
            return False
    return True


def _holds(node: Node, steps: list[tuple[str, list[str]]]) -> bool:
    """Whether the element fits a selector; siblings before it aren't looked at and may fit."""
    if not _matches(node, steps[-1][1]):
        return False
    path = []
    above: Node | None = node if len(steps) > 1 else None
    while above is not None:
        path.append(above)
        above = above.parent
    ended: set[int] = set()  # steps that some element above fits, with all steps before them
    there = {0} if len(steps) == 1 else set()
    for element in reversed(path):
        now = {k for k, (combinator, parts) in enumerate(steps)
               if (k == 0 or combinator in "+~" or k - 1 in (there if combinator == ">" else ended)) and _matches(element, parts)}
        ended |= now
        there = now
    return len(steps) - 1 in there


def _says(node: Node, styles: Styles) -> dict[str, bool]:
    """Whether the cascade hides the element, per property it speaks of. A rule that surely holds
    hides, unless one that may hold and takes precedence shows."""
    keys = [node.tag]
    hides: dict[str, tuple] = {}
    shows: dict[str, tuple] = {}
    if node.attributes:
        keys += [f"#{(node.attribute('id') or '').lower()}"] + [f".{c}" for c in (node.attribute("class") or "").lower().split()]
        if node.attribute("hidden") is not None:
            hides["display"] = False, _ATTRIBUTE_RANK, 0
        for name, (important, says) in _seen(node.attribute("style") or "").items():
            rank = important, _INLINE_RANK, 0
            if says:
                hides[name] = rank
            else:
                shows[name] = rank
    for key in keys:
        for name, rank in styles.hides.get(key, {}).items():
            hides[name] = max(hides.get(name, rank), rank)
    for best, rules in ((hides, styles.hides_by_path), (shows, styles.shows)):
        if rules:
            for key in [*keys, "*"]:
                for (name, _), (rank, steps) in rules.get(key, {}).items():
                    if (name not in best or rank > best[name]) and (best is hides or name == "visibility" or name in hides) and _holds(node, steps):
                        best[name] = rank
    return {name: name not in shows or name in hides and hides[name] > shows[name] for name in {*hides, *shows}}


def _set_visibility(root: Node, styles: Styles) -> None:
    """Marks every element: what isn't displayed goes with all inside; what is invisible keeps its
    place, and elements inside may be visible again."""
    todo = [root]
    while todo:
        around = todo.pop()
        for node in around.children:
            if isinstance(node, str):
                continue
            node.seen = around.seen
            if (node.tag in HIDDEN or node.tag == "dialog" and node.attribute("open") is None
                    or node.tag == "input" and (node.attribute("type") or "").lower() == "hidden"):
                node.shown = False
                continue
            if node.attributes or styles.rules:
                says = _says(node, styles)
                node.shown = not says.get("display", False)
                node.seen = not says.get("visibility", not around.seen)
            if node.shown:
                todo.append(node)


class _Lines:
    """Lines of a block; inline text gathers until something ends the line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.space = False

    def text(self, value: str) -> None:
        words = _SPACES.sub(" ", value)
        if not self.inline or self.inline[-1].endswith(" "):
            words = words.lstrip(" ")
        if words:
            self.inline.append(words)

    def preserved(self, value: str) -> None:
        first, *rest = value.replace("\r\n", "\n").split("\n")
        self.inline.append(first)
        for line in rest:
            self.line_end(True)
            self.inline.append(line)

    def line_end(self, forced: bool = False) -> None:
        line = "".join(self.inline).rstrip()
        self.inline.clear()
        if line or forced:
            if self.space and self.lines:
                self.lines.append("")
            self.space = False
            self.lines.append(line)

    def add(self, lines: list[str]) -> None:
        self.line_end()
        if lines:
            if self.space and self.lines:
                self.lines.append("")
            self.space = False
            self.lines += lines

    def blank(self) -> None:
        self.line_end()
        self.space = True

    def done(self) -> list[str]:
        self.line_end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _width(text: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else not unicodedata.combining(c) for c in text) if not text.isascii() else len(text)


def _walk(node: Node, out: _Lines, page: Styles, pre: bool, nested: bool) -> None:
    shut = node.tag == "details" and node.attribute("open") is None
    for child in node.children:
        if isinstance(child, str):
            if node.seen and not shut:
                (out.preserved if pre else out.text)(child)
            continue
        if not child.shown or shut and child.tag != "summary":
            continue
        tag = child.tag
        if tag == "br":
            out.line_end(child.seen)
        elif tag == "hr":
            out.blank()
        elif tag == "input":
            if child.seen:
                out.text(child.attribute("value") or "")
        elif tag in ("ul", "ol", "menu", "dir"):
            out.line_end() if nested else out.blank()
            _list(child, out, page)
            out.line_end() if nested else out.blank()
        elif tag == "table":
            out.blank()
            out.add(_table(child, page))
            out.blank()
        elif tag == "blockquote":
            out.blank()
            out.add(["> " + line if line else ">" for line in _block(child, page)])
            out.blank()
        elif tag == "dd":
            out.add(["  " + line if line else "" for line in _block(child, page)])
        elif tag in BLOCK:
            out.blank() if tag in SPACED else out.line_end()
            _walk(child, out, page, pre or tag == "pre", nested)
            out.blank() if tag in SPACED else out.line_end()
        else:
            _walk(child, out, page, pre or tag in ("textarea", "xmp"), nested)


def _block(node: Node, page: Styles, nested: bool = False) -> list[str]:
    out = _Lines()
    _walk(node, out, page, False, nested)
    return out.done()


def _number(node: Node, name: str, otherwise: int) -> int:
    value = (node.attribute(name) or "").strip()
    return int(value) if re.fullmatch(r"[+-]?[0-9]{1,9}", value) else otherwise


def _list(node: Node, out: _Lines, page: Styles) -> None:
    number = _number(node, "start", 1)
    for child in node.children:
        if isinstance(child, str) or child.tag != "li":
            out.add(_block(Node("div", "", [child], seen=node.seen), page, True))
        elif child.shown:
            number = _number(child, "value", number)
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            lines = _block(child, page, True)
            if lines or child.seen:
                first, *rest = lines or [""]
                out.add([(mark + first).rstrip(), *[" " * len(mark) + x if x else "" for x in rest]])


def _table(node: Node, page: Styles) -> list[str]:
    """Lines of a table: the caption, what stands outside of cells, then its rows."""
    width = MAX_WIDTH >> page.tables
    page.tables += 1
    head: list[str] = []
    grid: list[list[tuple[int, list[str]]]] = []
    loose = Node("div", seen=node.seen)
    groups = [(node, iter(node.children))]
    while groups:
        group, children = groups[-1]
        spans, at = _Spans(), 0
        for child in children:
            if isinstance(child, str):
                if group.seen:
                    loose.children.append(child)
            elif not child.shown:
                continue
            elif child.tag in ("tbody", "thead", "tfoot"):
                groups.append((child, iter(child.children)))
                break
            elif child.tag == "tr":
                row = _row(child, spans, at, loose, page)
                at += 1
                if row:
                    grid.append(row)
            elif child.tag in ("td", "th"):
                grid.append([(0, _block(child, page))])
            elif child.tag == "caption":
                head += _block(child, page)
            else:
                loose.children.append(child)
        else:
            groups.pop()
    head += _block(loose, page)
    page.tables -= 1
    return head + _aligned(grid, width)


class _Spans:
    """Up to which row each column of a row group is taken by cells from above, as a tree of column ranges
    (key: first column and level), so that a step takes the logarithm of the number of columns."""

    def __init__(self) -> None:
        self.level = -1
        self.whole: dict[int, int] = {}  # first row in which the range as a whole is free
        self.least: dict[int, int] = {}  # first row in which some column of it is free

    def free(self, column: int, row: int) -> int:
        """The first column from ``column`` on that is free in the row."""
        if self.level < 0:
            return column
        todo = [(0, self.level)]
        while todo:
            at, level = todo.pop()
            least = self.least.get(at << 6 | level, 0)
            if at + (1 << level) <= column or least > row:
                continue
            if level == 0 or at << 6 | level not in self.least:
                return max(at, column)
            level -= 1
            todo += [(at + (1 << level), level), (at, level)]
        return max(column, 1 << self.level)

    def take(self, first: int, end: int, until: int) -> None:
        """Takes the columns from ``first`` to before ``end`` in all rows before ``until``."""
        while self.level < 0 or 1 << self.level < end:
            self.level += 1
            if self.level:
                self.least[self.level] = 0
        self._take(0, self.level, first, end, until)

    def _take(self, at: int, level: int, first: int, end: int, until: int) -> int:
        key, half = at << 6 | level, at + (1 << level >> 1)
        if first <= at and at + (1 << level) <= end:
            self.whole[key] = max(self.whole.get(key, 0), until)
            self.least[key] = max(self.least.get(key, 0), until)
        elif first < at + (1 << level) and at < end:
            below = min(self._take(at, level - 1, first, end, until), self._take(half, level - 1, first, end, until))
            self.least[key] = max(self.whole.get(key, 0), below)
        return self.least.get(key, 0)


def _row(node: Node, spans: _Spans, at: int, loose: Node, page: Styles) -> list[tuple[int, list[str]]]:
    """The cells of a row group's row number ``at`` with their columns."""
    row: list[tuple[int, list[str]]] = []
    column = 0
    for cell in node.children:
        if isinstance(cell, str) or cell.tag not in ("td", "th"):
            if not isinstance(cell, str) or node.seen:
                loose.children.append(cell)
        elif cell.shown:
            column = spans.free(column, at)
            wide = min(max(_number(cell, "colspan", 1), 1), 1000)
            high = _number(cell, "rowspan", 1)
            row.append((column, _block(cell, page)))
            if high > 1 or high == 0:
                spans.take(column, column + wide, at + (high or 65535))
            column += wide
    return row


def _aligned(grid: list[list[tuple[int, list[str]]]], most: int) -> list[str]:
    """Rows as lines, columns padded to their widest cell, but to ``most`` characters at most; columns in
    which no cell starts have no width. Of a run of empty cells the last ``most`` characters are
    written. So no line takes more than its own cells' text and ``most`` characters around each."""
    place = {column: k for k, column in enumerate(sorted({column for row in grid for column, _ in row}))}
    widths = [0] * len(place)
    for row in grid:
        for column, cell in row:
            widths[place[column]] = min(most, max([widths[place[column]], *map(_width, cell)]))

    def empty(first: int, end: int) -> str:
        run, length = [], 0
        while end > first and length < most:
            end -= 1
            run.append(" " * widths[end] + " | ")
            length += widths[end] + 3
        return "".join(reversed(run))[max(length - most, 0):]

    lines = []
    for row in grid:
        parts: list[list[tuple[int, str]]] = [[] for _ in range(max([1, *(len(c) for _, c in row)]))]
        for column, cell in row:
            for part, text in zip(parts, cell):
                if text:
                    part.append((place[column], text))
        last = place[row[-1][0]]
        for part in parts:
            line, after = [], 0
            for k, text in part:
                line += [empty(after, k), text, " " * (widths[k] - _width(text)), " | " if k < last else ""]
                after = k + 1
            lines.append("".join([*line, empty(after, last)]).rstrip())
    return lines


def read_page(page: str) -> tuple[str, str]:
    """Title and visible text, laid out in lines; both empty for an empty page."""
    root, styles = build_tree(page)
    _set_visibility(root, styles)
    return styles.title or "", "\n".join(_block(root, styles))


def render(page: str) -> str:
    """All visible text of a page."""
    return read_page(page)[1]


def render_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, title, text, n_chars), one row per input row, no shuffle.

    Null html counts as an empty page; repeated rows give equal rows; any markup, however broken
    or deep, gives its text (elements beyond a fixed depth become siblings, as in browsers; columns of
    tables align up to a fixed width each, whatever the size of the page). The title is the
    first title element's text.
    """
    def run(batches):
        for batch in batches:
            offsets, _ = bs.string_buffers(batch.column(1))
            for i, j in bs.row_slices(offsets):
                pages_in = [x or "" for x in batch.column(1).slice(i, j - i).to_pylist()]
                titles, texts = zip(*map(read_page, pages_in))
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(titles, pa.string()),
                                       pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                      ["page_id", "title", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html")).mapInArrow(
        run, "page_id long, title string, text string, n_chars long")
