"""Pages to sections, categories, links and facts, parametrised by the site's anchors."""

from __future__ import annotations

import html
import re
import urllib.parse
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import clean_cell
from .values import NAMESPACES

#: The site's landmarks (fixed values): what ends a body, how section ids look, where articles lie.
END_MARKS = ("이 저작물은", "CC BY-NC-SA 2.0 KR", "크리에이티브 커먼즈")
SECTION_ID = r"s-[0-9]+(?:\.[0-9]+)*"
CATEGORY_SPACE = "분류:"
#: Shortest page; shortest text before the first section that becomes one.
SHORTEST_PAGE, SHORTEST_LEAD = 500, 40
#: Labels of an infobox that name relations (fixed values).
PREDICATES = frozenset((
    "국적", "출생", "사망", "소속", "소속팀", "소속사", "직업", "학력", "가족", "배우자", "자녀", "부모", "형제", "감독", "제작사", "배급사",
    "개발", "유통", "장르", "원작", "주연", "출연", "작가", "작곡가", "소재지", "본사", "설립자", "창립자", "대표", "회장", "수도", "언어",
    "정치체제", "통화", "종교", "제조사", "엔진", "플랫폼", "출시", "전신", "후신", "상위 조직", "산하", "링크",
))
#: Links in a value cell that are no objects (fixed values).
NO_OBJECTS = frozenset((
    "음력", "양력", "전학", "유스", "현재", "당시", "예정", "미상", "불명", "이하", "이상", "년", "월", "일", "세", "명", "기타", "본문", "링크",
))
MOST_FACTS, LONGEST_VALUE = 60, 200

#: The site's markup of headings, titles, times, links and facts (fixed values).
_HEADING = re.compile(r"<(h[1-6])\b[^>]*>(.*?)</\1\s*>", re.S | re.I)
_TITLE = re.compile(r"<h1\b[^>]*>(.*?)</h1\s*>", re.S | re.I)
_TIME = re.compile(r'<time[^>]*\bdatetime="([^"]+)"', re.I)
_ANCHOR = re.compile(rf"""\bid=['"]({SECTION_ID})['"]""")
_CAPTION = re.compile(r"""<span[^>]*\bid=['"]([^'"]+)['"]""")
_HREF = re.compile(r"""href=['"](/w/[^'"#]+)['"]""")
_FACT = re.compile(r"<strong[^>]*>([^<]{1,20})</strong>\s*(?:</div>\s*)?</td>\s*<td[^>]*>(.*?)</td>", re.S | re.I)
_PAGE_LINK = re.compile(r"""<a[^>]*\bclass=['"]wiki-link(?:-internal)?['"][^>]*\btitle=['"]([^'"]+)['"]""")


@dataclass
class Page:
    title_html: str | None = None
    modified: str | None = None
    start: int = 0
    end: int = 0
    error: str | None = None
    sections: list[tuple[str | None, str | None, int, str]] = field(default_factory=list)  # id, heading, level, html


def bounds(source: str) -> tuple[int, int]:
    """Start and end of the body: from the first heading with a section anchor, else behind the time of
    the last edit, else 0; to the first of the end marks' last places, else the end."""
    last = [p for p in map(source.rfind, END_MARKS) if p >= 0]
    end = min(last, default=len(source))
    for m in _HEADING.finditer(source, 0, len(source)):
        if m.start() >= end:
            break
        if _ANCHOR.search(m.group(2)):
            return m.start(), end
    m = _TIME.search(source)
    if m is None:
        return 0, end
    closed = source.find("</time>", m.end())
    return (m.end() if closed < 0 else closed + len("</time>")), end


def split_page(source: str | None) -> Page:
    """A page's title, time and sections as HTML; error names what is wrong with it."""
    if not source or len(source) < SHORTEST_PAGE:
        return Page(error="short")
    page = Page()
    if m := _TITLE.search(source):
        page.title_html = m.group(1)
    if m := _TIME.search(source):
        page.modified = m.group(1)
    page.start, page.end = bounds(source)
    if page.start >= page.end:
        page.error = "bounds"
        return page
    body = source[page.start : page.end]
    marks = [(m, a.group(1)) for m in _HEADING.finditer(body) if (a := _ANCHOR.search(m.group(2)))]
    if not marks:
        page.sections.append((None, None, 0, body))
        return page
    page.sections.append((None, None, -1, body[: marks[0][0].start()]))
    stops = [m.start() for m, _ in marks[1:]] + [len(body)]
    for (m, section), stop in zip(marks, stops):
        caption = _CAPTION.search(m.group(2))
        heading = html.unescape(caption.group(1)).strip() if caption else clean_cell(m.group(2)).lstrip("0123456789. ").strip()
        page.sections.append((section, heading, section.count(".") + 1, body[m.end() : stop]))
    return page


def ancestors(section: str) -> list[str]:
    """s-1.2.3 -> s-1, s-1.2, s-1.2.3"""
    numbers = section.removeprefix("s-").split(".")
    return ["s-" + ".".join(numbers[: k + 1]) for k in range(len(numbers))]


def links(source: str | None) -> list[str]:
    """Titles of articles that a page links to, distinct in byte order, not normalised. Links with a
    fragment or a query are left out whole, and so are those to other namespaces."""
    found = set()
    for href in _HREF.findall(source or ""):
        rest = href[len("/w/") :]
        if "?" in rest:
            continue
        title = urllib.parse.unquote(rest)
        if title.strip() and not title.startswith(NAMESPACES):
            found.add(title)
    return sorted(found)


def categories(source: str | None) -> list[str]:
    """Categories from the targets of category links, in order, without repeats."""
    prefix = "|".join(map(re.escape, (CATEGORY_SPACE, urllib.parse.quote(CATEGORY_SPACE), urllib.parse.quote(CATEGORY_SPACE, safe=":"))))
    names = (urllib.parse.unquote(n).strip().removeprefix(CATEGORY_SPACE).strip() for n in re.findall(rf"""<a\b[^>]*\bhref=['"]/w/(?:{prefix})([^'"]+)['"]""", source or "", re.I))
    return list(dict.fromkeys(n for n in names if n))


def facts(source: str | None, labels: frozenset[str] | None = PREDICATES, most: int = MOST_FACTS) -> list[tuple[str, str, str, str]]:
    """(label, object, kind, evidence) of an infobox. A label counts once, in its first row, even if that
    row's value is empty; a row is finished before the limit ends the search. labels None takes any label."""
    done: set[str] = set()
    out: dict[tuple[str, str, str], str] = {}
    for label, value in _FACT.findall(source or ""):
        label = clean_cell(label)
        if label in done or labels is not None and label not in labels:
            continue
        done.add(label)
        evidence = clean_cell(value)[:LONGEST_VALUE]
        if not evidence:
            continue
        pages = [t for t in map(html.unescape, _PAGE_LINK.findall(value)) if t and not t.startswith(NAMESPACES[:4]) and t not in NO_OBJECTS]
        for name in dict.fromkeys(pages) or [evidence]:
            out.setdefault((label, name, "page" if pages else "literal"), evidence)
        if len(out) >= most:
            break
    return [(*key, evidence) for key, evidence in out.items()]


def _per_page(make: Callable[[str | None], list], schema: str, width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list = []
            rows: list[tuple] = []
            for key, source in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = make(source.as_py())
                keys += [key] * len(found)
                rows += found
            columns = list(zip(*rows)) or [()] * width
            yield pa.record_batch([pa.array(keys, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, _kinds(schema)))], ["doc_id", *_names(schema)])

    return work


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _kinds(schema: str) -> list[pa.DataType]:
    known = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    return [known[c.split()[1]] for c in schema.split(", ")]


def per_page(pages: DataFrame, key: str, source: str, make: Callable[[str | None], list], schema: str) -> DataFrame:
    """doc_id and the columns of schema: the rows that make gives of each page, by the tasks that read them."""
    width = schema.count(",") + 1
    return pages.select(F.col(key).cast("long"), source).mapInArrow(_per_page(make, schema, width), f"doc_id long, {schema}")


def section_rows(source: str | None) -> list[tuple[int, str | None, str | None, int, str, str, str | None]]:
    """place, id, heading, level, path, html, error of each section; a broken page gives one row with its error."""
    page = split_page(source)
    if page.error:
        return [(0, None, None, 0, "", "", page.error)]
    first: dict[str, str] = {}
    for section, heading, _, _ in page.sections:
        if section and heading:
            first.setdefault(section, heading)
    return [
        (k, section, heading, level, "\x1f".join(first[a] for a in ancestors(section) if a in first) if section else "", source_html, None)
        for k, (section, heading, level, source_html) in enumerate(page.sections)
    ]


SECTIONS = "place int, section_id string, heading string, level int, path string, html string, error string"
