"""Visible text of web pages by layout-aware rendering.

Markup is cut into tags and text, a tree builder supplies the tags that authors
leave out, visibility rules hide what a reader does not see, and the tree is laid
out: blocks stand on lines of their own, with blank lines between paragraphs, list
items have marks and indents, table columns are aligned. All visible text is
emitted; nothing is judged to be boilerplate.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricewright.llm.tables import column, map_batches

# Element names of the HTML standard by their role in a tree.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes title datalist object canvas audio video".split())
#: In a drawing only text elements show, and not where they are only defined; in a formula not the notes on it.
HIDDEN_FOREIGN = {
    "svg": HIDDEN | frozenset("desc metadata defs symbol marker clippath mask pattern".split()),
    "math": HIDDEN | frozenset("annotation annotation-xml mphantom".split()),
}
#: Elements of drawings and formulas with HTML inside, start tags of HTML that end a drawing or formula, and those that end a select.
HTML_INSIDE = {"svg": frozenset("foreignobject desc title".split()), "math": frozenset("mi mo mn ms mtext annotation-xml".split())}
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
ENDS_SELECT = frozenset("input textarea select caption table tbody tfoot thead tr td th".split())
#: Parts of formulas and drawings that stand apart: a blank goes before each.
APART = {"svg": frozenset(("text",)), "math": frozenset(("mtr", "mtd"))}
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body div section article aside header footer nav main address form fieldset details summary figcaption hr li dt dd tr td th thead tbody tfoot caption center legend".split()
)
#: A start tag of the key closes open elements of the first set, but not beyond the second.
CLOSES: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th", "caption")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "thead": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption")), frozenset(("table",))),
    "tbody": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption")), frozenset(("table",))),
    "tfoot": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption")), frozenset(("table",))),
    "option": (frozenset(("option",)), frozenset(("select",))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "hr": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "body": (frozenset(("head",)), frozenset(("html",))),
}
SCOPES = frozenset(("table", "td", "th", "caption", "button", "html", "foreignobject"))
ROW_LIMITS = frozenset(("table", "thead", "tbody", "tfoot", "td", "th", "caption"))
#: Start tags that may stand in a head; any other one, or text, ends it.
HEAD = frozenset("base link meta title style script noscript template".split())

# A quote opens a value only after = and blanks; any other quote is a plain character.
_NAME = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+"
_EQUALS = r"[ \t\n\r\f]*+=[ \t\n\r\f]*+"
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?P<name>[A-Za-z][^\s/>]*)"
    rf"(?P<attributes>(?:[ \t\n\r\f/]++|{_NAME}(?:{_EQUALS}(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^ \t\n\r\f>]++)?+)?+)*+)(?:>|\Z)"
    r"|</(?P<end>[A-Za-z][^\s/>]*)[^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(rf"({_NAME})(?:{_EQUALS}(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^ \t\n\r\f>]++))?+)?+")
UNSEEN_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
SPACES = re.compile(r"[ \t\n\r\f]+")


NO_MARKS: dict[str, str] = {}


class Node:
    __slots__ = ("children", "foreign", "marks", "mute", "name", "start", "unseen")

    def __init__(self, name: str, unseen: bool = False, start: int = 1):
        self.name, self.unseen, self.start = name, unseen, start
        self.foreign: str | None = None  # svg or math, for elements of these
        self.mute = False  # text directly inside does not show
        self.marks = NO_MARKS  # kept for select, optgroup and option only
        self.children: list[Node | str] = []


def attributes(raw: str) -> tuple[dict[str, str], bool]:
    """Attributes of a tag, and whether it ends in a slash that belongs to no value."""
    found: dict[str, str] = {}
    end = 0
    for m in ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        end = m.end()
    return found, raw.endswith("/") and end < len(raw)


def is_unseen(name: str, marks: dict[str, str], foreign: str | None = None) -> bool:
    if foreign:
        return (
            name in HIDDEN_FOREIGN[foreign]
            or marks.get("display", "").strip() == "none"
            or marks.get("visibility", "").strip() in ("hidden", "collapse")
            or bool(UNSEEN_STYLE.search(marks.get("style", "")))
        )
    return (
        name in HIDDEN
        or "hidden" in marks
        or name == "input"
        or name == "dialog" and "open" not in marks
        or bool(UNSEEN_STYLE.search(marks.get("style", "")))
    )


def parse(page: str) -> Node:
    """Tree of a page; never fails, whatever the markup."""
    root = Node("html")
    stack = [root]
    selects: list[Node] = []

    def close(names: frozenset[str], limits: frozenset[str]) -> bool:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in limits:
                return False
            if stack[k].name in names:
                # the outermost one to close may lie further out
                deeper = k
                while deeper > 1 and stack[deeper - 1].name in names:
                    deeper -= 1
                del stack[deeper:]
                return True
        return False

    def back_to_row() -> None:
        # forms and inline elements opened in a row hold no cells
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in HIDDEN or stack[k].name in ROW_LIMITS or stack[k].foreign:
                return
            if stack[k].name == "tr":
                del stack[k + 1 :]
                return

    def leave_head() -> None:
        if stack[-1].name == "head":
            stack.pop()

    def add_text(text: str) -> None:
        if text.strip(" \t\n\r\f"):
            leave_head()
        if text and not stack[-1].mute:
            stack[-1].children.append(text)

    at = 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if m is None:
            add_text(html.unescape(page[at:]))
            break
        add_text(html.unescape(page[at : m.start()]))
        at = max(m.end(), m.start() + 1)
        if m["name"]:
            name, (marks, closed) = m["name"].lower(), attributes(m["attributes"] or "")
            if name in BREAKS_OUT or name == "font" and marks.keys() & {"color", "face", "size"}:
                while holds_foreign(stack[-1]):
                    stack.pop()
            foreign = name if name in ("svg", "math") else stack[-1].foreign if holds_foreign(stack[-1]) else None
            if foreign:
                leave_head()
                inside = stack[-1]
                if name in APART[foreign] or inside.name == "mfrac" or name == "tspan" and "x" in marks:
                    inside.children.append(" ")
                node = _child(stack[-1], Node(name, is_unseen(name, marks, foreign)))
                node.foreign = foreign
                node.mute = foreign == "svg" and name not in ("text", "foreignobject") and (name == "svg" or inside.mute)
                if not closed:
                    stack.append(node)
                continue
            if selects and name in ENDS_SELECT:
                before = len(stack)
                close(frozenset(("select",)), SCOPES)
                if name == "select" and len(stack) < before:
                    continue
            if name in BLOCKS and name not in ("td", "th", "tr", "caption", "thead", "tbody", "tfoot"):
                close(frozenset(("p",)), SCOPES)
            if name == "html":
                continue
            if name not in HEAD:
                leave_head()
            if name in CLOSES:
                while close(*CLOSES[name]) and name in ("tr", "thead", "tbody", "tfoot"):
                    pass  # a row or part of a table is never inside another row of it
            if name in ("td", "th"):
                back_to_row()
            if name in ("td", "th") and stack[-1].name in ("table", "thead", "tbody", "tfoot"):
                stack.append(_child(stack[-1], Node("tr")))
            start = marks.get("start", "1")
            node = _child(stack[-1], Node(name, is_unseen(name, marks), int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1))
            if name in ("select", "optgroup", "option"):
                node.marks = marks
                if name == "select":
                    selects.append(node)
            if name in VOID:
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                body = page[at : end.start() if end else len(page)]
                node.children.append(html.unescape(body) if name in ("textarea", "title") else body)
                at = end.end() if end else len(page)
                continue
            stack.append(node)
        elif m["end"]:
            name = m["end"].lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if stack[k].name in ("td", "th", "table") and name not in ("table", "tr", "tbody", "thead", "tfoot"):
                    break  # an end tag inside a cell does not close what is around the table
            else:
                if name == "br":
                    leave_head()
                    _child(stack[-1], Node("br"))
        elif holds_foreign(stack[-1]) and page.startswith("<![CDATA[", m.start()):
            end = page.find("]]>", m.start())
            add_text(page[m.start() + 9 : end if end >= 0 else len(page)])
            at = end + 3 if end >= 0 else len(page)
    for select in selects:
        show_options(select)
    return root


def holds_foreign(node: Node) -> bool:
    """Whether a tag inside belongs to a drawing or formula."""
    return bool(node.foreign) and node.name not in HTML_INSIDE[node.foreign]


def show_options(select: Node) -> None:
    """Leave in a select what it shows: the chosen option, or in a list box all of them."""
    size = select.marks.get("size", "").strip()
    box = "multiple" in select.marks or re.fullmatch(r"[0-9]{1,9}", size) is not None and int(size) > 1
    options: list[tuple[Node, bool]] = []  # with: may be chosen
    shown: list[Node | str] = []
    todo = [(c, False, False) for c in reversed(select.children)]
    while todo:
        node, disabled, unseen = todo.pop()
        if isinstance(node, str):
            continue
        disabled, unseen = disabled or "disabled" in node.marks, unseen or node.unseen
        if node.name == "option":
            if node.marks.get("label"):
                node.children = [node.marks["label"]]
            options.append((node, not disabled))
            if box and not unseen:
                shown += [" ", node, " "]
            continue
        if box and not unseen and node.marks.get("label"):
            shown += [" ", node.marks["label"], " "]
        todo += [(c, disabled, unseen) for c in reversed(node.children)]
    if not box:
        chosen = [n for n, _ in options if "selected" in n.marks][-1:] or [n for n, free in options if free][:1]
        for node in chosen:  # shows in the closed box, even if hidden in the open list
            node.unseen = False
            shown += [" ", node, " "]
    select.children = shown


def _child(parent: Node, node: Node) -> Node:
    parent.children.append(node)
    return node


def shown_width(text: str) -> int:
    """Columns a text takes: wide characters two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class _Lines:
    """Lines of a block under construction; white space collapses as in a browser."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.open = ""
        self.gap = False

    def text(self, text: str, kept: bool) -> None:
        if kept:
            first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.open += first
            for line in rest:
                self.lines.append(self.open.rstrip(" "))
                self.open = line
            return
        text = SPACES.sub(" ", text)
        if not self.open or self.open.endswith(" "):
            text = text.lstrip(" ")
        self.open += text

    def end_line(self) -> None:
        if self.open.strip():
            self.lines.append(self.open.rstrip())
        self.open = ""

    def blank(self) -> None:
        self.end_line()
        if self.lines and self.lines[-1] != "":
            self.lines.append("")

    def block(self, lines: list[str], first: str = "", rest: str = "") -> None:
        self.end_line()
        for k, line in enumerate(lines):
            self.lines.append(((first if k == 0 else rest) + line).rstrip())

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and self.lines[-1] == "":
            self.lines.pop()
        while self.lines and self.lines[0] == "":
            self.lines.pop(0)
        return self.lines


def layout(node: Node, kept: bool = False) -> list[str]:
    """Lines of an element's visible content.

    Walks with its own stack, so that deep nesting is no matter.
    """
    # a frame: node, position among children, its lines, item number, rows of a table
    frames = [[node, 0, _Lines(), node.start, [], kept]]
    while True:
        frame = frames[-1]
        here, at, out, _, rows, pre = frame
        if at < len(here.children):
            frame[1] += 1
            child = here.children[at]
            if isinstance(child, str):
                if here.name not in ("ul", "ol", "dl", "tr", "table", "thead", "tbody", "tfoot") or child.strip():
                    out.text(child, pre)
            elif child.unseen:
                pass
            elif child.name == "br":
                out.lines.append(out.open.rstrip())
                out.open = ""
            elif child.name == "hr":
                out.blank()
            elif child.name in BLOCKS and not child.foreign:
                frames.append([child, 0, _Lines(), child.start, [], pre or child.name == "pre"])
            else:  # inline: its content flows on in the same lines
                if child.name == "q":
                    out.text('"', pre)
                frames.append([child, 0, out, child.start, rows, pre or child.name == "textarea"])
            continue
        frames.pop()
        if not frames:
            return out.done() + table_lines(rows)
        parent = frames[-1]
        into: _Lines = parent[2]
        if here.foreign or here.name not in BLOCKS:
            if here.name == "q":
                into.text('"', pre)
            continue
        if here.name in ("td", "th"):
            if parent[0].name == "tr":
                parent[4].append(out.done())
            else:
                into.block(out.done())
        elif here.name == "tr":
            lines = out.done()
            if rows:  # what stands beside the cells goes before the table, as in a browser
                into.block(lines)
                parent[4].append(rows)
            elif lines:
                parent[4].append([lines])
        elif here.name in ("thead", "tbody", "tfoot"):
            into.block(out.done())
            parent[4].extend(rows)
        else:
            lines = out.done()
            if here.name == "table" or rows:
                lines = lines + table_lines(rows)
            if here.name == "li":
                ordered = parent[0].name == "ol"
                mark = f"{parent[3]}. " if ordered else "- "
                parent[3] += 1
                into.block(lines or [""], mark, " " * len(mark))
            elif here.name == "dd":
                into.block(lines, "    ", "    ")
            elif here.name == "blockquote":
                into.blank()
                into.block(lines, "> ", "> ")
                into.blank()
            elif here.name in PARAGRAPHS and not (here.name in ("ul", "ol") and parent[0].name in ("li", "ul", "ol")):
                if lines:
                    into.blank()
                    into.block(lines)
                    into.blank()
            else:
                into.block(lines)


def table_lines(rows: list[list[list[str]]]) -> list[str]:
    """Rows of cells, cells of lines, as text with aligned columns two blanks apart."""
    columns = max((len(r) for r in rows), default=0)
    widths = [max((shown_width(line) for r in rows if k < len(r) for line in r[k]), default=0) for k in range(columns)]
    out = []
    for row in rows:
        for k in range(max((len(c) for c in row), default=0)):
            cells = [c[k] if k < len(c) else "" for c in row]
            out.append("  ".join(c + " " * (widths[i] - shown_width(c)) for i, c in enumerate(cells)).rstrip())
    return out


def visible_text(page: str | None) -> str:
    """Rendered text of a page; null and empty pages give the empty text."""
    return "\n".join(layout(parse(page))) if page else ""


def page_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, text, n_chars, n_lines.

    Null and empty pages, and pages that show nothing, have the empty text and no
    lines. Rows repeat as in the input and null ids stay null; an empty table
    gives no rows; further columns are ignored. Narrow: nothing is shuffled.
    Broken markup is rendered as far as it goes, unclosed elements end with the
    page.
    """
    named = pages.select(column(pages, id_col).cast("bigint").alias("id"), column(pages, html_col).cast("string").alias("html"))

    def rendered(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [visible_text(h) for h in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["page_id", "text"])

    rows = map_batches(named, rendered, "page_id bigint, text string")
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return rows.select("page_id", "text", F.length("text").cast("bigint").alias("n_chars"), lines.cast("bigint").alias("n_lines"))
