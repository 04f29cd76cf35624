"""Visible text of HTML pages, laid out: a tree with implied tags, visibility rules, a renderer.

The tree builder closes and opens what a browser would (paragraphs, list items, table rows and
cells); the renderer walks the tree without recursion.  Paragraphs and headings are set apart by
an empty line, other blocks begin a line, list items carry a bullet or their number and are
indented by depth, preformatted text keeps its line breaks and blanks, and cells of a table are
padded so that columns align, two blanks apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the HTML standard: elements by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style template noscript iframe object datalist noframes audio video canvas area annotation annotation-xml mphantom".split())
# Inside svg only the text of these is drawn, and nothing of those.
DRAWN = frozenset({"text", "foreignobject"})
UNDRAWN = frozenset("desc metadata defs symbol clippath mask pattern marker".split())
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
# Elements of svg and math whose content is HTML again, and the HTML elements that end svg and math.
HTML_INSIDE = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset menu".split())
BLOCKS = APART | frozenset(
    "html body div section article header footer nav main aside address li dt dd form details summary figcaption legend caption center dialog tr thead tbody tfoot option".split())
CLOSES_PARAGRAPH = BLOCKS - frozenset("li dt dd tr thead tbody tfoot caption option html body legend summary".split())
# An element of the key ends open elements of the value, inside the nearest element of the scope.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th", "caption"}, {"table"}), "th": ({"td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}), "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
BARRIERS = frozenset({"table", "td", "th", "caption", "button", "html", "body"})
_WHOLE = re.compile("-?[0-9]{1,9}")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
_TOKEN = re.compile(r""""[^"]*"|'[^']*'|[{};]""")
_COMPOUND = re.compile(r"(\*|[A-Za-z][A-Za-z0-9-]*)?((?:[.#][A-Za-z0-9_-]+)*)")
_FEATURE = re.compile(r"\(\s*(?:(min|max)-)?(width|height)\s*:\s*([0-9.]+)(px|r?em)?\s*\)")
_RANGE = re.compile(r"\(\s*(width|height)\s*(<=?|>=?|=)\s*([0-9.]+)(px|r?em)?\s*\)")
# A page is seen on a desktop screen.
SCREEN = {"width": 1280, "height": 800}
FEATURES = frozenset("(color) (hover) (hover:hover) (any-hover:hover) (pointer:fine) (any-pointer:fine) (orientation:landscape) (prefers-color-scheme:light) (prefers-reduced-motion:no-preference) (scripting:enabled) (update:fast) (grid:0)".split())
DISPLAYS = frozenset(
    "none block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell table-caption table-row-group table-header-group table-footer-group table-column table-column-group list-item contents flow flow-root ruby initial unset inherit revert revert-layer".split())
VISIBILITIES = frozenset("visible hidden collapse initial unset inherit revert revert-layer".split())


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]
        self.count: dict[str, int] = {}
        self.begun = False  # the body has begun

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...`` is a comment up to the next ``>``, as in browsers."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def unknown_decl(self, data: str) -> None:
        """Nothing to show."""

    def _pop_to(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.count[node.tag] -= 1
        del self.open[depth:]

    def _end_implied(self, tags: set[str], scope: set[str] | frozenset[str]) -> None:
        """Close the outermost open element of ``tags`` that lies inside the nearest of ``scope``."""
        if not any(self.count.get(tag) for tag in tags):
            return
        found = None
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.open[depth].tag
            if tag in scope:
                break
            if tag in tags:
                found = depth
        if found:
            self._pop_to(found)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self.count.get(tag):
            return
        if tag == "head" and (self.begun or self.count.get("head")):
            return
        foreign = self._foreign()
        if foreign and tag in BREAKOUT:
            self._pop_to(foreign)
            foreign = 0
        if tag not in ("head", "html") and tag not in IN_HEAD and not foreign:
            # The head ends where the body begins; an unclosed title or script ends at a block.
            blocks = tag in BLOCKS or tag in ("a", "b", "i", "span", "img")
            if self.count.get("head") and (self.open[-1].tag == "head" or blocks and not (self.count.get("noscript") or self.count.get("template"))):
                self._end_implied({"head"}, frozenset())
            self.begun |= not self.count.get("head")
        if foreign:
            return self._push(tag, {name: value or "" for name, value in attrs})
        if tag in CLOSES_PARAGRAPH:
            self._end_implied({"p"}, BARRIERS)
        if tag in IMPLIED_END:
            self._end_implied(*IMPLIED_END[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push("tr", {})
        node = self._push(tag, {name: value or "" for name, value in attrs})
        if tag in VOID:
            self._pop_to(len(self.open) - 1)
        return node

    def _push(self, tag: str, attributes: dict[str, str]) -> Node:
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        self.open.append(node)
        self.count[tag] = self.count.get(tag, 0) + 1
        return node

    def _foreign(self) -> int:
        """Depth of the svg or math element around the next tag, or 0 where tags are HTML."""
        if self.count.get("svg") or self.count.get("math"):
            for depth in range(len(self.open) - 1, 0, -1):
                tag = self.open[depth].tag
                if tag in ("svg", "math"):
                    return depth
                if tag in HTML_INSIDE:
                    return 0
        return 0

    def handle_startendtag(self, tag, attrs):
        node = self.handle_starttag(tag, attrs)
        if node and self.open[-1] is node and (tag in ("svg", "math") or self._foreign()):
            self._pop_to(len(self.open) - 1)  # a slash closes nothing in HTML, but does in svg and math

    def handle_endtag(self, tag):
        if tag == "p" and not self.count.get("p"):
            self.handle_starttag("p", [])  # a lone end tag is an empty paragraph
        if tag in VOID or tag in ("html", "body") or not self.count.get(tag):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            here = self.open[depth].tag
            if here == tag:
                return self._pop_to(depth)
            if here in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                return  # an end tag inside a cell ends nothing outside it

    def handle_data(self, data):
        if data.strip(" \t\n\r\f"):
            if self.open[-1].tag == "head":
                self._pop_to(len(self.open) - 1)
            self.begun |= not self.count.get("head")
        self.open[-1].children.append(data)


def _on_screen(query: str) -> bool:
    """Whether a media query list holds on a desktop screen; what is unknown does not."""
    return not query.strip() or any(_holds(one.strip()) for one in query.lower().split(","))


def _holds(query: str) -> bool:
    turned = re.match(r"not\s+(?=[a-z])", query)
    for part in re.split(r"\s+and\s+", re.sub(r"^(?:not|only)\s+(?=[a-z])", "", query)):
        if not any(_part_holds(one) for one in re.split(r"\s+or\s+", part)):
            return bool(turned)
    return not turned


def _part_holds(part: str) -> bool:
    part = part.strip()
    if part.startswith("not"):
        return part[3:].strip().startswith("(") and not _part_holds(part[3:])
    feature, ranged = _FEATURE.fullmatch(part), _RANGE.fullmatch(part)
    if feature:
        bound, name, number, unit = feature.groups()
        sign = {"min": ">=", "max": "<=", None: "="}[bound]
    elif ranged:
        name, sign, number, unit = ranged.groups()
    else:
        return part in ("all", "screen") or re.sub(r"\s+", "", part) in FEATURES
    if number.count(".") > 1 or number == ".":
        return False
    here, there = SCREEN[name], float(number) * (16 if unit in ("em", "rem") else 1)
    return {"<": here < there, "<=": here <= there, ">": here > there, ">=": here >= there, "=": here == there}[sign]


def _declared(body: str) -> dict[str, tuple[bool, str]]:
    """(important, value) of display and visibility; the last valid one counts, important ones first."""
    found: dict[str, tuple[bool, str]] = {}
    for one in _COMMENT.sub(" ", body).split(";"):
        name, colon, value = one.partition(":")
        name = name.strip().lower()
        if not colon or name not in ("display", "visibility"):
            continue
        value, mark, word = value.strip().lower().partition("!")
        value, important = value.strip(), word.strip() == "important"
        known = DISPLAYS if name == "display" else VISIBILITIES
        if value and (important or not mark) and all(part in known for part in value.split()) and (important or not found.get(name, (False,))[0]):
            found[name] = (important, value)
    return found


class Rules:
    """Style rules for display and visibility: selectors of one element, by tag, classes and id."""

    def __init__(self, sheets: list[tuple[str, str]]):
        self.by_key: dict[str, list[tuple]] = {}
        self.number = 0
        for media, sheet in sheets:
            if _on_screen(media):
                self._read(_COMMENT.sub(" ", sheet))

    def _read(self, sheet: str) -> None:
        blocks: list[tuple[str, str]] = []  # kind of the open blocks (group, rule, other) and a rule's selectors
        last, body = 0, ""
        for match in _TOKEN.finditer(sheet):
            sign = match.group()
            if len(sign) > 1:
                continue
            before = sheet[last:match.start()]
            inside = blocks[-1][0] if blocks else "group"
            if sign == "{":
                last, head = match.end(), before.strip()
                word, _, rest = head.partition(" ") if not head.lower().startswith("@media(") else ("@media", "", head[6:])
                word = word.lower()
                if inside != "group":
                    blocks.append(("other", ""))
                elif word == "@media":
                    blocks.append(("group" if _on_screen(rest) else "other", ""))
                elif word in ("@layer", "@supports") and not re.match(r"not\b", rest.strip(), re.I):
                    blocks.append(("group", ""))
                elif head.startswith("@"):
                    blocks.append(("other", ""))
                else:
                    blocks.append(("rule", head))
                    body = ""
            elif sign == "}":
                last = match.end()
                if inside == "rule":
                    self._add(blocks[-1][1], body + before)
                if blocks:
                    blocks.pop()
            elif inside == "rule":
                body += before + ";"
                last = match.end()
            elif inside != "group" or before.strip().startswith("@"):
                last = match.end()  # a statement such as @import
        if blocks and blocks[-1][0] == "rule":
            self._add(blocks[-1][1], body + sheet[last:])  # the end of the sheet closes what is open

    def _add(self, selectors: str, body: str) -> None:
        declared = _declared(body)
        self.number += 1
        for selector in selectors.split(",") if declared else ():
            selector = selector.strip()
            match = _COMPOUND.fullmatch(selector)
            if not match or not selector:
                continue
            tag, names = (match[1] or "*").lower(), re.findall(r"[.#][^.#]+", match[2])
            weight = sum(10_000 if name[0] == "#" else 100 for name in names) + (tag != "*")
            self.by_key.setdefault(names[0] if names else tag, []).append((tag, frozenset(names), weight, self.number, declared))

    def of(self, node: Node) -> dict[str, str]:
        """The values of display and visibility that the page's author gives an element."""
        a, best = node.attributes, {}
        if self.by_key:
            names = {"." + name for name in a.get("class", "").split()} | ({"#" + a["id"]} if "id" in a else set())
            for key in (*names, node.tag, "*"):
                for tag, wanted, weight, number, declared in self.by_key.get(key, ()):
                    if tag in ("*", node.tag) and wanted <= names:
                        for name, (important, value) in declared.items():
                            best[name] = max(best.get(name, ()), (important, False, weight, number, value))
        if "style" in a:
            for name, (important, value) in _declared(a["style"]).items():
                best[name] = max(best.get(name, ()), (important, True, 0, 0, value))
        return {name: found[-1] for name, found in best.items()}


def _shown(node: Node, rules: Rules, visible: bool) -> tuple[bool, bool]:
    """Whether an element is laid out, and whether its own text is visible."""
    a = node.attributes
    if node.tag in UNSEEN or node.tag == "input":
        return False, False
    given = rules.of(node) if rules.by_key or "style" in a else {}
    display, visibility = given.get("display", "revert"), given.get("visibility", "inherit")
    if display.startswith("revert"):  # the browser's own rules
        display = "none" if "hidden" in a or (node.tag == "dialog" and "open" not in a) else "block"
    if visibility in ("visible", "initial", "hidden", "collapse"):
        visible = visibility in ("visible", "initial")
    return display != "none", visible


class Sheet:
    """Lines of one flow of text: collapses blanks, and keeps the gap that blocks ask for."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # a blank is due before the next word
        self.apart = False  # an empty line is due before the next line
        self.indent = 0
        self.mark = ""

    def write(self, text: str) -> None:
        words = _BLANKS.split(text)
        for k, word in enumerate(words):
            if k:
                self.blank = True
            if word:
                if self.line and self.blank:
                    self.line.append(" ")
                self.line.append(word)
                self.blank = False

    def write_preformatted(self, text: str) -> None:
        for k, part in enumerate(text.split("\n")):
            if k:
                self.end_line(forced=True)
            if part:
                self.line.append(part)

    def end_line(self, forced: bool = False) -> None:
        if self.line or forced:
            if self.apart and self.lines:
                self.lines.append("")
            self.apart = False
            lead = " " * self.indent
            if self.mark:
                lead = " " * (self.indent - 2) + self.mark if self.indent >= 2 else self.mark
                self.mark = ""
            self.lines.append((lead + "".join(self.line)).rstrip())
            self.line = []
        self.blank = False

    def add_lines(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self.line = [line]
            self.end_line(forced=True)


def _number(text: str, default: int) -> int:
    """A whole number in decimal digits, as attributes give it; anything else is ``default``."""
    return int(text) if _WHOLE.fullmatch(text) else default


def _wide(node: Node, name: str) -> int:
    return max(1, min(_number(node.attributes.get(name, "1").strip(), 1), 1000))


def _align(rows: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Cells (columns, rows, lines) to lines: a column is as wide as its widest cell.

    Columns that a wider cell covers and in which none begins take no room, so a cell costs the
    same whatever it spans.
    """
    grid: list[dict[int, list[str]]] = []
    above: list[tuple[int, int, int]] = []  # columns that cells of earlier rows still cover: begin, end, first free row
    for r, cells in enumerate(rows):
        above = sorted(cover for cover in above if cover[2] > r)
        grid.append({})
        c, k, fresh = 0, 0, []
        for columns, down, lines in cells:
            while k < len(above) and above[k][0] <= c:
                c = max(c, above[k][1])
                k += 1
            grid[r][c] = lines
            if down > 1:
                fresh.append((c, c + columns, r + down))
            c += columns
        above += fresh
    begins = sorted({c for row in grid for c in row})
    width = dict.fromkeys(begins, 0)
    for row in grid:
        for c, lines in row.items():
            width[c] = max([width[c], *map(len, lines)])
    wide = [c for c in begins if width[c]]
    out = []
    for row in grid:
        for k in range(max(map(len, row.values()), default=0)):
            padded = [(row[c][k] if c in row and k < len(row[c]) else "").ljust(width[c]) for c in wide]
            out.append("  ".join(padded).rstrip())
    return out


def visible_text(html: str | None) -> str:
    """All visible text of a page; null and empty pages have none."""
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    sheets, stack = [], [builder.root]
    while stack:
        node = stack.pop()
        if node.tag == "style":
            sheets.append((node.attributes.get("media", ""), "".join(c for c in node.children if isinstance(c, str))))
        stack += [c for c in reversed(node.children) if not isinstance(c, str)]  # sheets in the page's order
    rules = Rules(sheets)

    page = Sheet()
    flows = [page]  # innermost last: the page, then a cell of a table, and so on
    lists: list[list] = []  # [ordered, next number] of open lists
    tables: list[dict] = []
    verbatim = 0
    walk: list[tuple] = [("open", builder.root, True, False, True)]  # visible; inside svg; where text is drawn
    while walk:
        what, node, visible, drawing, drawn = walk.pop()
        flow = flows[-1]
        if what == "text":
            if visible and drawn:
                (flow.write_preformatted if verbatim else flow.write)(node)
            continue
        if what == "open":
            tag = node.tag
            laid_out, visible = _shown(node, rules, visible)
            if not laid_out or drawing and tag in UNDRAWN:
                continue
            if tag == "svg":
                drawing, drawn = True, False
            elif drawing and tag in DRAWN:
                drawing, drawn = tag == "text", True
                flow.blank = True
            if tag == "br":
                if not visible:
                    continue
                flow.end_line(forced=True) if flow.line or flow.lines and not flow.apart else None
                continue
            if tag in BLOCKS:
                flow.end_line()
                flow.apart |= tag in APART and not (tag in ("ul", "ol", "menu") and lists)
            if tag in ("ul", "ol", "menu"):
                lists.append([tag == "ol", _number(node.attributes.get("start", "1").strip(), 1)])
                flow.indent += 2
            elif tag == "li":
                here = lists[-1] if lists else [False, 1]
                here[1] = _number(node.attributes.get("value", "").strip(), here[1])
                flow.mark = f"{here[1]}. " if here[0] else "- "
                here[1] += 1
            elif tag == "dd" or tag == "blockquote":
                flow.indent += 2
            elif tag == "pre":
                verbatim += 1
            elif tag == "table":
                tables.append({"rows": [], "lists": lists, "verbatim": verbatim})
                lists, verbatim = [], 0
            elif tag == "tr" and tables:
                tables[-1]["rows"].append([])
            elif tag in ("td", "th") and tables:
                flows.append(Sheet())
            walk.append(("close", node, visible, drawing, drawn))
            children = node.children
            if tag == "details" and "open" not in node.attributes:  # closed: its summary is all that shows
                children = [child for child in children if not isinstance(child, str) and child.tag == "summary"][:1]
            walk += [("text" if isinstance(child, str) else "open", child, visible, drawing, drawn) for child in reversed(children)
                     if not (tag in ("table", "tr", "tbody", "thead", "tfoot") and isinstance(child, str) and not child.strip(" \t\n\r\f"))]
            continue
        tag = node.tag
        if drawing and tag in DRAWN:
            flow.blank = True
        if tag in ("td", "th") and tables:
            flow.end_line()
            cell = flows.pop()
            table = tables[-1]
            if not table["rows"]:
                table["rows"].append([])
            table["rows"][-1].append((_wide(node, "colspan"), _wide(node, "rowspan"), cell.lines))
            continue
        if tag in BLOCKS:
            flow.end_line()
            flow.mark = "" if tag == "li" else flow.mark
            flow.apart |= tag in APART and not (tag in ("ul", "ol", "menu") and len(lists) > 1)
        if tag in ("ul", "ol", "menu"):
            lists.pop()
            flow.indent -= 2
        elif tag == "dd" or tag == "blockquote":
            flow.indent -= 2
        elif tag == "pre":
            verbatim -= 1
        elif tag == "table":
            table = tables.pop()
            lists, verbatim = table["lists"], table["verbatim"]
            flow.apart = True
            flow.add_lines(_align(table["rows"]))
            flow.apart = True
    page.end_line()
    return "\n".join(page.lines)


def rendered(html: Column) -> Column:
    @F.pandas_udf("string")
    def render(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([visible_text(page) for page in batch], dtype=object)

    return render(html)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url and the visible text of every page; nothing is shuffled.

    A null or empty page gives an empty text, repeated rows repeat, an empty table gives no rows.
    Malformed markup is read as browsers read it: numbers that are none count as one, unknown
    declarations are comments, open elements end with the page.
    """
    return pages.select("page_id", "url", rendered(F.col("html")).alias("text"))
