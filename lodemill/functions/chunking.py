"""Sections to chunks that carry their context."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .text import breadcrumb, chunk_key, content_key

#: Characters aimed at, repeated between neighbours, and below which a piece joins the one before (fixed values).
TARGET, OVERLAP, LEAST = 850, 128, 200
MOST = TARGET * 3 // 2

#: Where paragraphs and sentences end (fixed values).
_PARAGRAPH = re.compile(r"\n\s*\n")
_SENTENCE = re.compile(r"(?<=[.!?。」』\n])\s+")


def _fill(units: Iterable[str], room: int, glue: str, overlap: int = 0) -> Iterator[str]:
    """Units joined by glue (one character) as long as they fit into room; one that is too long stays
    whole. What follows a full piece begins with that piece's last overlap characters and a space."""
    parts: list[str] = []
    size = 0
    for unit in units:
        if parts and size + 1 + len(unit) > room:
            full = glue.join(parts)
            yield full
            parts.clear()
            unit = (full[-overlap:] + " " + unit).lstrip() if overlap else unit
        size = size + 1 + len(unit) if parts else len(unit)
        parts.append(unit)
    if parts:
        yield glue.join(parts)


def split_long(text: str, target: int = TARGET, overlap: int = OVERLAP) -> list[str]:
    """Pieces of about target characters, cut between paragraphs, else between sentences. Each but the
    first begins with the last overlap characters of the one before and a space."""
    if len(text) <= target:
        return [text]

    def units() -> Iterator[str]:
        for paragraph in _PARAGRAPH.split(text):
            if paragraph := paragraph.strip():
                yield from (paragraph,) if len(paragraph) <= target else _fill(_SENTENCE.split(paragraph), target, " ")

    return list(_fill(units(), target, "\n", overlap))


@dataclass
class Piece:
    section: str | None
    path: str
    text: str

    def takes(self, section: str | None, text: str) -> bool:
        """Whether a short text of a section joins this piece."""
        return len(text) < LEAST and section == self.section and len(self.text) + len(text) <= MOST


def pieces_of(sections: list[tuple[str | None, str, str]]) -> list[Piece]:
    """Pieces of a document's (section, path, text) sections; a text under LEAST characters joins the piece
    before if that is of the same section and both fit into MOST."""
    out: list[Piece] = []
    for section, path, text in sections:
        for part in split_long(text) if text.strip() else ():
            if out and out[-1].takes(section, part):
                out[-1].text += "\n" + part
            else:
                out.append(Piece(section, path, part))
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, titles, seqs, ids, paths, bodies = [], [], [], [], [], []
        for key, title, sections in zip(*(batch.column(k).to_pylist() for k in range(3))):
            for seq, piece in enumerate(pieces_of([(s["id"], s["path"] or "", s["text"] or "") for s in sections or []])):
                keys.append(key), titles.append(title), seqs.append(seq), ids.append(piece.section), bodies.append(piece.text)
                paths.append(piece.path.split("\x1f") if piece.path else [])
        s = pa.string()
        yield pa.record_batch(
            [pa.array(keys, pa.int64()), pa.array(titles, s), pa.array(seqs, pa.int32()), pa.array(ids, s), pa.array(paths, pa.list_(s)), pa.array(bodies, s)],
            ["doc_id", "title", "seq", "section_id", "heading_path", "body"],
        )


def chunk(documents: DataFrame) -> DataFrame:
    """chunk_id, doc_id, seq, section_id, heading_path, text, content_hash.

    documents: doc_id, title, sections (an array of id, path, text). A document with no text has no chunk.
    """
    cut = documents.select("doc_id", "title", "sections").mapInArrow(_chunks, "doc_id long, title string, seq int, section_id string, heading_path array<string>, body string")
    text = breadcrumb(F.coalesce("title", F.lit("")), F.col("heading_path"), F.col("body"))
    made = cut.withColumn("text", text)
    return made.select(chunk_key(F.col("doc_id").cast("string"), F.col("seq")).alias("chunk_id"), "doc_id", "seq", "section_id", "heading_path", "text", content_key(F.col("text")).alias("content_hash"))


_RENDERED = re.compile(r"^== (.*) ==$", re.M)


def rendered_sections(text: str | None) -> list[tuple[str | None, str | None, str]]:
    """(id, heading, text) of a rendered text with lines '== heading =='; numbered s-1, s-2 and so on."""
    if not text:
        return []
    parts = _RENDERED.split(text)
    out: list[tuple[str | None, str | None, str]] = [(None, None, parts[0].strip())] if parts[0].strip() else []
    return out + [(f"s-{k}", parts[2 * k - 1].strip(), parts[2 * k].strip()) for k in range(1, len(parts) // 2 + 1)]


SECTION_TYPE = ArrayType(StructType([StructField(n, StringType()) for n in ("id", "path", "text")]))


@F.arrow_udf(SECTION_TYPE)
def sections(texts: pa.Array) -> pa.Array:
    """The sections of rendered texts, for chunk()."""
    kind = pa.list_(pa.struct([("id", pa.string()), ("path", pa.string()), ("text", pa.string())]))
    return pa.array([[{"id": i, "path": h or "", "text": b} for i, h, b in rendered_sections(t)] for t in texts.to_pylist()], kind)
