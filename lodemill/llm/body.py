"""The main body of a page: tree scoring of its text pieces.

Text pieces pass points for length and commas, discounted by link density, to the containers above
them; so do the page's title and the place where a part of a page was cut out. The best container is kept,
with those containers beside and inside it that carry sections of their own. Left out are menus, boxes, side columns, notices and footers, which the tree tells by their
tags and by how they are built, and short texts that stand on many pages between ever other neighbours.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Tags that cut a text (fixed values).
CUTTING = frozenset(
    "html head body title p div ul ol li table thead tbody tr td th h1 h2 h3 h4 h5 h6 br hr nav header footer aside section article main details "
    "summary figure figcaption blockquote form dl dt dd button".split()
)
#: Elements that are dropped whole (fixed values).
DROPPED = "script|style|svg|noscript"
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_CONTAINERS = frozenset(("div", "article", "section", "main", "body", "html"))
_LEAVES = _HEADINGS | {"p", "div", "li", "td", "th", "dt", "dd", "blockquote", "figcaption", "summary", "button"}
_ASIDE = frozenset(("nav", "aside", "footer", "header", "details", "summary", "form", "button", "head", "title"))
#: Which open elements a start tag ends, up to which other one.
_ENDS = {"li": ("li", ("ul", "ol")), "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table")), "tr": ("tr", ("table",)), "dt": ("dd", ("dl",)), "dd": ("dt", ("dl",))}

_MARK = re.compile(rf"<!--.*?(?:-->|\Z)|<({DROPPED})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>", re.S | re.I)
_SECTION = re.compile(r"""\bid\s*=\s*['"]""", re.I)
_JUMP = re.compile(r"""\bhref\s*=\s*['"]?#""", re.I)
_COMMA = re.compile("[,，、،]")
_LABEL = re.compile("[:：]")
_SENTENCE = re.compile(r"""[.!?。！？…]["'”’)\]]*(?:\[\d+\])*$""")

#: Points that the page's title gives, and that the unseen container gives in which a part of a page begins: as
#: much as some five paragraphs, so a longer text beside it still wins.
TITLE_POINTS = BEGIN_POINTS = 15.0
#: A text of at most CHROME_CHARS on CHROME_SHARE % of its source's pages that stands after and before CHROME_PLACES different texts is furniture.
CHROME_CHARS, CHROME_PLACES, CHROME_SHARE = 200, 6, 1


@dataclass
class Node:
    name: str
    parent: Node | None
    wraps: bool = False  # has block children
    text: bool = False  # has text of its own
    section: bool = False  # a heading of a section is below
    points: float = 0.0
    path: set[str] = field(default_factory=set)


@dataclass
class Piece:
    text: str
    node: Node
    linked: int = 0
    anchored: bool = False  # holds an element with an id, as section headings do
    jumps: bool = False  # holds a link into this page
    timed: bool = False


def parse(source: str) -> tuple[list[Piece], Node]:
    """The pieces of a page or of a part of one, and the node in which it begins.

    A paragraph-like element with text ends where another block begins, so a missing end tag does no
    harm. An end tag without a start tag ends the part's unseen parent.
    """
    root = Node("", None)
    open_: list[Node] = [root]
    pieces: list[Piece] = []
    buffer: list[str] = []
    linked = 0
    in_link = anchored = jumps = timed = False
    at = 0

    def flush() -> None:
        nonlocal linked, anchored, jumps, timed
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            node = open_[-1]
            node.text = True
            pieces.append(Piece(text, node, min(linked, len(text)), anchored, jumps, timed))
        linked, anchored, jumps, timed = 0, False, False, False

    for mark in _MARK.finditer(source):
        if mark.start() > at:
            buffer.append(source[at : mark.start()])
            if in_link:
                linked += mark.start() - at
        at = mark.end()
        name = mark.group(3)
        if name is None:
            continue
        name, end, rest = name.lower(), bool(mark.group(2)), mark.group(4)
        if name not in CUTTING:
            if name == "a":
                in_link = not end
                jumps = jumps or bool(not end and _JUMP.search(rest))
            elif name == "time":
                timed = True
            if not end and _SECTION.search(rest):
                anchored = True
            continue
        flush()
        in_link = False
        if name in ("br", "hr"):
            continue
        if end:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].name == name:
                    del open_[k:]
                    break
            else:
                if name in _CONTAINERS and len(open_) == 1:
                    above = Node("", None)
                    open_[0].parent, open_[0].name = above, name
                    above.wraps = True
                    open_[0] = above
            continue
        if name in _ENDS:
            also, stop = _ENDS[name]
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].name in stop:
                    break
                if open_[k].name in (name, also):
                    del open_[k:]
                    break
        while len(open_) > 1 and (open_[-1].name == "p" or open_[-1].text and open_[-1].name in _LEAVES):
            open_.pop()
        node = Node(name, open_[-1])
        open_[-1].wraps = True
        open_.append(node)
    buffer.append(source[at:])
    flush()
    return pieces, root


def _up(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def score(pieces: list[Piece], first: Node) -> Node | None:
    """Passes points to the containers and gives the best; of equal ones the first and innermost.

    A piece gives its points to its own container, half of them to the next one up, and so on. first: the
    node in which the part begins; if its start tag is not in the part, it gets BEGIN_POINTS.
    """
    best: Node | None = None

    def give(nodes: Iterable[Node], points: float) -> None:
        nonlocal best
        for n in nodes:
            if n.name in _CONTAINERS or n.parent is None:
                n.points += points
                if best is None or n.points > best.points:
                    best = n
                points /= 2

    if first.parent is not None:
        give([first], BEGIN_POINTS)
    for piece in pieces:
        ups = list(_up(piece.node))
        if piece.node.name == "h1":
            give(ups[1:4], TITLE_POINTS)
        if any(n.name in _ASIDE for n in ups):
            continue
        heading = piece.node.name in _HEADINGS
        for n in ups:
            n.section = n.section or heading and piece.anchored
        if piece.node.name == "h1":
            continue
        points = 1 + len(_COMMA.findall(piece.text)) + min(len(piece.text) / 100, 3)
        points *= 1 - piece.linked / len(piece.text) if not heading else 0.5 + piece.anchored
        give(islice((n for n in (ups[1:] if piece.node.parent is not None else ups) if n.name in _CONTAINERS or n.parent is None), 3), points)
    return best


def main_body(source: str | None, furniture: frozenset[str] | set[str] = frozenset()) -> list[int]:
    """Numbers of the pieces that belong to the main body; furniture: texts known to be no page's own."""
    return _kept(*parse(source), furniture) if source else []


def _kept(pieces: list[Piece], first: Node, furniture: frozenset[str] | set[str] = frozenset()) -> list[int]:
    best = score(pieces, first)
    if best is None:
        return []
    title = next((k for k, p in enumerate(pieces) if p.node.name == "h1"), 0)
    kept = [title] if pieces[title].node.name == "h1" else []
    for k in range(title + len(kept), len(pieces)):
        piece = pieces[k]
        if piece.timed or piece.jumps and piece.node.name not in _HEADINGS or piece.text in furniture and not piece.anchored and not _listed(piece):
            continue
        if _inside(piece, best):
            kept.append(k)
    while kept and _labelled(pieces[kept[-1]]):
        kept.pop()
    return kept


def _labelled(piece: Piece) -> bool:
    """A line with a label that is no sentence; at the end of a page it lists something about the page."""
    if piece.node.name not in ("p", "div", "") or _listed(piece) or len(piece.text) > CHROME_CHARS:
        return False
    return bool(_LABEL.search(piece.text)) and not _SENTENCE.search(piece.text)


def _listed(piece: Piece) -> bool:
    """In a list, table or quotation, whose entries may well be the same on many pages."""
    return any(n.name in ("ul", "ol", "table", "dl") for n in _up(piece.node))


def _inside(piece: Piece, best: Node) -> bool:
    """Whether nothing between the piece and the best container sets it apart, or beside it a container with sections."""
    within = False
    for n in _up(piece.node):
        if n is best:
            within = True
            break
        if n.name in _ASIDE:
            return False
        if n.name in _CONTAINERS and n.wraps and not n.section:
            return False
        if n.name in _HEADINGS and not piece.anchored:
            return False
    return within or best.parent is not None and any(n.section and n.parent is best.parent for n in _up(piece.node))


def _short(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


def _walk(fields: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each page and field: the kept pieces; text for those that furniture may take out. Of these, the
        first of a text on a page counts: it has hashes of its neighbours."""
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for key, site, *values in zip(*(batch.column(k).to_pylist() for k in range(len(fields) + 2))):
                met: set[str] = set()
                for name, source in zip(fields, values):
                    if not source:
                        continue
                    pieces, first = parse(source)
                    title = next((k for k, p in enumerate(pieces) if p.node.name == "h1"), None)
                    for k in _kept(pieces, first):
                        piece = pieces[k]
                        text = before = after = None
                        if len(piece.text) <= CHROME_CHARS and k != title and not piece.anchored and not _listed(piece):
                            text = piece.text
                            if piece.node.name != "h1" and text not in met:
                                met.add(text)
                                before = _short(pieces[k - 1].text if k else "")
                                after = _short(pieces[k + 1].text if k + 1 < len(pieces) else "")
                        for column, value in zip(out, (key, site, name, k, text, before, after)):
                            column.append(value)
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "site", "field_name", "piece_no", "text", "before", "after"])

    return work


def _sites(pages: DataFrame, site: str | None) -> Column:
    return (F.coalesce(F.col(site).cast("string"), F.lit("")) if site else F.lit("")).alias("site")


def _walked(pages: DataFrame, key: Column, fields: list[str], site: str | None) -> DataFrame:
    kinds = "doc_id long, site string, field_name string, piece_no int, text string, before long, after long"
    return cut(pages.select(key.cast("long").alias("doc_id"), _sites(pages, site), *fields).mapInArrow(_walk(fields), kinds))


def _furniture(walked: DataFrame, pages: DataFrame, site: str | None) -> DataFrame:
    seen = walked.where("before IS NOT NULL").select("site", "text", "before", "after")
    sizes = pages.select(_sites(pages, site)).groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    per = seen.groupBy("site", "text").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    common = cut(per.join(sizes, "site").where(F.col("n") * 100 >= F.col("pages") * CHROME_SHARE).select("site", "text"))
    held = seen.join(common.select("text").distinct(), "text", "left_semi").join(common.withColumn("common", F.lit(True)), ["site", "text"], "left")
    held = cut(held.withColumn("common", F.coalesce("common", F.lit(False))))
    own = held.groupBy("site", "text").agg(F.count(F.lit(1)).alias("here"), F.least(F.countDistinct("before"), F.countDistinct("after")).alias("own"))
    own = own.join(sizes, "site").where(F.col("here") * 100 >= F.col("pages") * CHROME_SHARE)
    pooled = held.groupBy("text").agg(
        F.least(F.countDistinct(F.when(F.col("common"), F.col("before"))), F.countDistinct(F.when(F.col("common"), F.col("after")))).alias("places"),
        F.count_if("common").alias("strong"), F.count(F.lit(1)).alias("n"),
    )
    told = (F.col("own") >= CHROME_PLACES) | (F.col("places") >= CHROME_PLACES) & (F.col("strong") * 2 >= F.col("n"))
    return own.join(pooled, "text").where(told).select("site", "text")


def furniture_texts(pages: DataFrame, fields: list[str], site: str | None = None) -> DataFrame:
    """site, text: short texts of the pages' bodies that are furniture on the pages of a site.

    site: the column that names a page's source; without it all pages are one source's. A text must stand
    on CHROME_SHARE % of the source's own pages, however many pages there are, and after and before
    CHROME_PLACES different texts: on this source's pages, or on those of all sources where it has that
    share on more than one page, if they are at least half of the pages that hold it. A text counts once a page. Copies of
    a page don't make its sentences furniture, since their neighbours are the same, nor does a neighbour
    that is edited in many ways on one side.
    """
    return _furniture(_walked(pages, F.lit(None), list(fields), site), pages, site)


def main_pieces(pages: DataFrame, key: str = "doc_id", fields: tuple[str, ...] = ("body_html", "link_html"), site: str | None = None) -> DataFrame:
    """doc_id, field_name, piece_no of the pieces that belong to the main body of each field of each page.

    Pieces are numbered from 0 after the tags in CUTTING have cut the text, comments and DROPPED elements
    are gone, entities are decoded, white space is made single and empty pieces are left out. A null or
    empty field has no piece. Pages may be parts of pages, with tags unclosed or in capitals. site: see
    furniture_texts. Pages are parsed once; furniture meets their pieces in a join.
    """
    walked = _walked(pages, F.col(key), list(fields), site)
    own = walked.where("text IS NULL").unionByName(walked.where("text IS NOT NULL").join(_furniture(walked, pages, site), ["site", "text"], "left_anti"))
    return own.where("doc_id IS NOT NULL").select("doc_id", "field_name", "piece_no")
