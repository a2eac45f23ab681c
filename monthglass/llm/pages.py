"""Visible text of web pages, laid out.

Markup is read into a stack of open elements, with the tags that HTML lets authors
leave out put in or closed. Elements that a browser doesn't show are passed over.
What is left is written as lines: blocks apart, lists with markers and indents,
preformatted text as it is, and table cells in aligned columns.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches
from .names import fresh
from .words import strings

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes datalist audio video canvas".split())
#: Inside drawings and formulas: what only describes them or is drawn where it is used.
UNSEEN_INSIDE = {
    "svg": frozenset("defs desc metadata symbol clippath mask marker pattern".split()),
    "math": frozenset("annotation annotation-xml".split()),
}
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl blockquote pre table figure hr fieldset".split())
BLOCKS = APART | frozenset(
    "html body div section article aside nav header footer main address form li dt dd details summary dialog center figcaption legend caption optgroup option tr".split()
)
#: An opening tag closes what stands open of the second set, down to one of the third.
CLOSES = {
    **{t: (("p",), ("table", "td", "th", "button", "caption", "object")) for t in APART | frozenset("div section article aside nav header footer main address form center details dialog".split())},
    "li": (("li", "p"), ("ul", "ol", "menu", "table", "td")),
    "dt": (("dt", "dd", "p"), ("dl", "table", "td")),
    "dd": (("dt", "dd", "p"), ("dl", "table", "td")),
    "td": (("td", "th", "caption", "p"), ("tr", "table")),
    "th": (("td", "th", "caption", "p"), ("tr", "table")),
    "tr": (("tr", "td", "th", "caption", "p"), ("table",)),
    **{t: (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p"), ("table",)) for t in ("thead", "tbody", "tfoot")},
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "body": (("head",), ()),
    "a": (("a",), ("table", "td", "li", "div", "p")),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base link meta title style script template noscript html head".split())
TABLE_PARTS = frozenset("table td th tr thead tbody tfoot caption".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)|<![a-zA-Z\[][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACE = " \t\n\r\f"
SPACES_RUN = re.compile(r"[ \t\n\r\f]+")
WAITED, PADDED = 200, 16  # a column waits for a cell of this length, and for longer ones if it then has at most so many times its text


class Box:
    """Lines of text of one flow: the page's, or a cell's."""

    def __init__(self):
        self.parts: list[str] = []
        self.breaks, self.space, self.fresh = 0, False, True
        self.indents, self.marker = [""], None

    def part(self, n: int) -> None:
        """At least n line breaks before the next text."""
        if not self.fresh or self.parts:
            self.breaks = max(self.breaks, n)
        self.space = False

    def write(self, text: str) -> None:
        if self.breaks or self.fresh:
            if self.parts:
                self.parts.append("\n" * max(1, self.breaks))
            if self.marker is not None:
                self.parts.append(self.indents[-2] + self.marker if len(self.indents) > 1 else self.marker)
                self.marker = None
            else:
                self.parts.append(self.indents[-1])
            self.breaks, self.space, self.fresh = 0, False, False
        if self.space:
            self.parts.append(" ")
        self.parts.append(text)
        self.space = False

    def flow(self, text: str) -> None:
        """Text with its white space run together."""
        inner = text.strip(SPACE)
        if not inner:
            self.space = self.space or (bool(text) and not self.breaks and not self.fresh)
            return
        if text[0] in SPACE:
            self.space = not self.breaks and not self.fresh
        self.write(SPACES_RUN.sub(" ", inner).replace("\xa0", " "))
        self.space = text[-1] in SPACE

    def lines(self, text: str) -> None:
        """Text as it is."""
        for k, line in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                self.newline()
            if line:
                self.write(line)

    def newline(self) -> None:
        if not self.fresh or self.parts:
            self.breaks = min(self.breaks + 1, 2)
        self.space = False

    def text(self) -> str:
        return "\n".join(x.rstrip() for x in "".join(self.parts).split("\n"))


class Grid:
    """A table: rows of (column, columns taken, lines)."""

    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        self.caption = ""
        self.below: dict[int, int] = {}  # column -> rows that a cell from above still takes

    def row(self) -> None:
        self.below = {c: n - 1 for c, n in self.below.items() if n > 1}
        self.taken = set(self.below)
        self.rows.append([])

    def cell(self, text: str, wide: int, tall: int) -> None:
        if not self.rows:
            self.row()
        at = 0
        while at in self.taken:
            at += 1
        columns = range(at, at + wide)
        self.taken.update(columns)
        if tall > 1:
            self.below.update({c: tall for c in columns})
        self.rows[-1].append((at, wide, text.split("\n")))

    def fitting(self, lengths: list[int]) -> int:
        """The width of the widest cell of a column that doesn't pad it beyond measure; wider ones stick out."""
        most = max(WAITED, PADDED * sum(lengths) // max(1, len(self.rows)))
        return max([0, *(n for n in lengths if n <= most)])

    def text(self) -> list[str]:
        """The rows' lines; a column begins where its widest cell before has ended."""
        width: dict[int, list[int]] = {}
        for row in self.rows:
            for at, wide, lines in row:
                if wide == 1:
                    width.setdefault(at, []).extend(len(x) for x in lines)
        columns = sorted(width)
        width = {c: self.fitting(lengths) for c, lengths in width.items()}
        starts, total = {}, 0
        for c in columns:
            starts[c] = total
            total += width[c] + 2
        out = []
        for row in self.rows:
            for k in range(max((len(lines) for _, _, lines in row), default=0)):
                line = ""
                for at, _, lines in row:
                    piece = lines[k] if k < len(lines) else ""
                    if piece:
                        begin = starts.get(at, len(line) + 2 * bool(line))
                        line = line.ljust(begin) if len(line) <= begin else line + "  "
                        line += piece
                out.append(line.rstrip())
        return [x for x in out if x]


class Page:
    """Builds and renders in one go; each open element knows what its end undoes."""

    def __init__(self):
        self.open: list[dict] = []
        self.frames: list[Box | Grid] = [Box()]
        self.counts: Counter[str] = Counter()
        self.hidden = 0
        self.title = ""

    @property
    def box(self) -> Box:
        """The nearest flow: text between a table's cells goes before the table."""
        return next(f for f in reversed(self.frames) if isinstance(f, Box))

    def feed(self, page: str) -> None:
        at = 0
        while at < len(page):
            m = TOKEN.search(page, at)
            if m is None:
                self.text(page[at:])
                break
            if m.start() > at:
                self.text(page[at : m.start()])
            at = m.end()
            if m[1]:
                self.end(m[1].lower())
            elif (m[2] or m[4]) and not (m[4] and m[6] == ""):  # a tag cut off at the page's end is no tag
                tag = (m[2] or m[4]).lower()
                at = self.start(tag, (m[3] if m[2] else m[5]) or "", page, at)
        while self.open:
            self.pop()

    def text(self, raw: str) -> None:
        if self.open and self.open[-1]["tag"] == "head" and raw.strip(SPACE):
            self.pop()
        if self.hidden or not self.shown():
            return
        text = entities.unescape(raw)
        if any(e["pre"] for e in self.open[-1:]):
            self.box.lines(text)
        else:
            self.box.flow(text)

    def shown(self) -> bool:
        return self.open[-1]["shown"] if self.open else True

    def start(self, tag: str, rest: str, page: str, at: int) -> int:
        if self.open and self.open[-1]["tag"] == "head" and tag not in IN_HEAD:
            self.pop()
        self.imply(tag)
        if tag == "br":
            if not self.hidden:
                self.box.newline()
            return at
        if tag in VOID:
            if tag == "hr" and not self.hidden:
                self.box.part(2)
            return at
        attrs = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(rest)}
        style = re.sub(r"\s", "", attrs.get("style", "")).lower()
        inside = any(self.counts[kind] and tag in tags for kind, tags in UNSEEN_INSIDE.items())
        unseen = tag in UNSEEN or inside or "hidden" in attrs or "display:none" in style or (tag == "dialog" and "open" not in attrs)
        above = self.open[-1] if self.open else None
        if above and above["tag"] == "details" and not above["opened"] and tag != "summary":
            unseen = True
        shown = self.shown()
        if "visibility:hidden" in style or "visibility:collapse" in style:
            shown = False
        elif "visibility:visible" in style:
            shown = True
        if above and above["tag"] == "details" and not above["opened"]:
            shown = above["outer"]
        pre = (above["pre"] if above else False) or tag in ("pre", "textarea", "xmp")
        entry = {"tag": tag, "unseen": unseen, "shown": shown, "outer": shown, "pre": pre, "opened": "open" in attrs, "frame": None, "list": None}
        if tag == "details" and not entry["opened"]:
            entry["shown"] = False
        self.open.append(entry)
        self.counts[tag] += 1
        self.hidden += unseen
        if not self.hidden:
            self.enter(entry, attrs)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            body, at = (page[at : close.start()], close.end()) if close else (page[at:], len(page))
            if tag == "title" and not self.title and not self.counts["svg"]:
                self.title = " ".join(entities.unescape(body).split())
            elif tag in ("textarea", "xmp"):
                self.text(body)
            self.pop()
        elif pre and tag == "pre" and page[at : at + 1] == "\n":
            at += 1
        return at

    def imply(self, tag: str) -> None:
        """Closes what the tag ends, and opens the row that a cell must stand in."""
        if tag in HEADINGS and self.open and self.open[-1]["tag"] in HEADINGS:
            self.pop()
        closes, stop = CLOSES.get(tag, ((), ()))
        if any(self.counts[c] for c in closes):
            for k in range(len(self.open) - 1, -1, -1):
                name = self.open[k]["tag"]
                if name in stop:
                    break
                if name in closes:
                    self.cut(k)
                    if tag == "p" or closes == ("p",):
                        break
        if tag in ("td", "th") and next((e["tag"] for e in reversed(self.open) if e["tag"] in ("table", "tr", "td", "th")), "") == "table":
            self.start("tr", "", "", 0)

    def enter(self, entry: dict, attrs: dict) -> None:
        tag, box = entry["tag"], self.box
        if tag == "table":
            box.part(2)
            entry["frame"] = Grid()
        elif tag == "tr" and isinstance(self.frames[-1], Grid):
            self.frames[-1].row()
        elif tag in ("td", "th", "caption") and isinstance(self.frames[-1], Grid):
            entry["frame"] = Box()
            entry["span"] = _number(attrs.get("colspan"), 1, 1000), _number(attrs.get("rowspan"), 1, 65534)
        elif tag in ("ul", "ol", "menu"):
            inside = any(e["list"] for e in self.open[:-1])
            box.part(1 if inside else 2)
            entry["list"] = [tag, _number(attrs.get("start"), 1, 1 << 31)]
        elif tag == "li":
            box.part(1)
            kind = next((e["list"] for e in reversed(self.open) if e["list"]), ["ul", 1])
            if kind[0] == "ol":
                kind[1] = _number(attrs.get("value"), kind[1], 1 << 31)
                box.marker = f"{kind[1]}. "
                kind[1] += 1
            else:
                box.marker = "- "
            box.indents.append(box.indents[-1] + " " * len(box.marker))
        elif tag in ("dd", "blockquote"):
            box.part(2 if tag == "blockquote" else 1)
            box.indents.append(box.indents[-1] + "  ")
        elif tag in BLOCKS or (tag == "text" and self.counts["svg"]):
            box.part(2 if tag in APART else 1)
        if entry["frame"]:
            self.frames.append(entry["frame"])

    def end(self, tag: str) -> None:
        if tag == "br":
            return self.start("br", "", "", 0) and None
        for k in range(len(self.open) - 1, -1, -1) if self.counts[tag] else ():
            name = self.open[k]["tag"]
            if name == tag:
                self.cut(k)
                return None
            if name in TABLE_PARTS and tag not in TABLE_PARTS:
                break
        if tag == "p" and not self.hidden:
            self.box.part(2)
        return None

    def cut(self, k: int) -> None:
        while len(self.open) > k:
            self.pop()

    def pop(self) -> None:
        entry = self.open.pop()
        tag = entry["tag"]
        self.counts[tag] -= 1
        if not self.hidden:
            if entry["frame"]:
                frame = self.frames.pop()
                below = self.frames[-1]
                if isinstance(frame, Grid):
                    self.place(frame)
                elif tag == "caption":
                    below.caption = frame.text()
                else:
                    below.cell(frame.text(), *entry["span"])
            elif tag in ("li", "dd", "blockquote"):
                box = self.box
                box.part(2 if tag == "blockquote" else 1)
                if len(box.indents) > 1:
                    box.indents.pop()
                box.marker = None
            elif tag in ("ul", "ol", "menu"):
                self.box.part(1 if any(e["list"] for e in self.open) else 2)
            elif tag in BLOCKS or (tag == "text" and self.counts["svg"]):
                self.box.part(2 if tag in APART else 1)
        self.hidden -= entry["unseen"]

    def place(self, grid: Grid) -> None:
        box = self.box
        for line in [*(grid.caption.split("\n") if grid.caption else ()), *grid.text()]:
            box.part(1)
            box.write(line)
        box.part(2)


def _number(text, default: int, most: int) -> int:
    m = re.match(r"\s*(\d{1,9})", text or "")
    return min(int(m[1]), most) if m and (int(m[1]) or default != 1) else default


def render(page: str | None) -> tuple[str, str]:
    """(title, visible text) of a page; both empty for null and for a page that shows nothing."""
    made = Page()
    made.feed(page or "")
    return made.title, made.frames[0].text().strip("\n")


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with the columns title, text, n_lines in place of the markup.

    Each row is read by itself: ids may repeat or be null, other columns stay as they
    are; columns named like the new ones are replaced. Null or empty markup gives empty
    text. Broken markup is read as far as it goes: open elements end with the page, a
    tag cut off at its end is dropped. Style sheets are not read, only the attributes
    `hidden` and `style`. Formulas and drawings give their text, without annotations,
    definitions and metadata; an object gives what stands in for it. Cells of any length
    are kept whole; one that would pad its column beyond measure sticks out of it.
    """

    def run(column: pd.Series) -> pd.DataFrame:
        found = [render(x) for x in strings(pa.array(column, pa.string(), from_pandas=True)).to_pylist()]
        return pd.DataFrame([(t, x, x.count("\n") + 1 if x else 0) for t, x in found], columns=["title", "text", "n_lines"])

    made = F.pandas_udf(run, "title string, text string, n_lines long")(F.col(f"`{html_col}`"))
    kept = [c for c in pages.columns if c not in (html_col, "title", "text", "n_lines")]
    (name,) = fresh(pages, "_made")
    return small_batches(pages).select([F.col(f"`{c}`") for c in kept] + [made.alias(name)]).select(
        [F.col(f"`{c}`") for c in kept] + [F.col(name)[c].alias(c) for c in ("title", "text", "n_lines")]
    )
