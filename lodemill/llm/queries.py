"""Queries p2, p4, p7, p8, p9 and p10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import link_entries
from ..session import table, tokenizer_dir
from .body import main_pieces
from .frequent import frequent_values
from .leaks import WINDOW, leaks
from .neardup import NearDuplicates
from .repetition import LEAST_WINDOWS, SHARE, profiles
from .tokens import encode

P2_SHARE, P2_LEAST = 0.004, 10
P9_EDITS = 2


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Values as stored that make up at least 0.4 % of all link entries."""
    return frequent_values(link_entries(spark, root), "value", share=P2_SHARE, least=P2_LEAST).select(F.col("value").alias("link_value"))


def p2_counts(spark: SparkSession, root: str) -> DataFrame:
    """The most frequent values with their counts."""
    return frequent_values(link_entries(spark, root), "value", share=P2_SHARE / 4).select(F.col("value").alias("link_value"), "n")


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """Pieces of the main body of every page."""
    return main_pieces(table(spark, root, "extracted_docs"), site="source")


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of chunks whose texts share at least 0.6 of their runs of five characters, copies included."""
    near = NearDuplicates(table(spark, root, "chunks"), "chunk_id", "text")
    return near.pairs().select(F.col("a").alias("chunk_a"), F.col("b").alias("chunk_b")).distinct()


def p7_classes(spark: SparkSession, root: str) -> DataFrame:
    """One row a chunk: the class it belongs to and the number of chunks it is linked with."""
    return NearDuplicates(table(spark, root, "chunks"), "chunk_id", "text").classes().withColumnRenamed("id", "chunk_id")


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    """Ids of every document's text by byte_bpe_50k."""
    return encode(table(spark, root, "documents"), "doc_id", "text", f"{tokenizer_dir()}/byte_bpe_50k.tiktoken")


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents and the items of which they hold at least 50 consecutive characters: of the passages
    that p9_edited finds those with such a run without edits."""
    return p9_edited(spark, root).where(F.col("exact") >= WINDOW).select("doc_id", "item_id")


def p9_edited(spark: SparkSession, root: str) -> DataFrame:
    """Documents and the items of which they hold 50 characters with up to two edits, and how many."""
    return leaks(table(spark, root, "documents"), table(spark, root, "eval_items"), edits=P9_EDITS)


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents at least 30 % of whose windows of five words repeat earlier ones."""
    return p10_profiles(spark, root).where((F.col("windows") >= LEAST_WINDOWS) & (F.col("repeated") * 100 >= F.col("windows") * int(100 * SHARE))).select("doc_id")


def p10_profiles(spark: SparkSession, root: str) -> DataFrame:
    """Share of repeated windows and distances from the language of every document."""
    return profiles(table(spark, root, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_counts, p4_found, p7_found, p7_classes, p8_ids, p9_found, p9_edited, p10_found, p10_profiles)}

_LINKS = """SELECT value FROM (SELECT unnest(outlinks) AS value FROM documents) WHERE value IS NOT NULL
    AND regexp_matches(value, '[^\\s\\x{A0}\\x{85}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{1C}-\\x{1F}]')"""

SQL = {
    "p2_found": f"""
        SELECT value AS link_value FROM (SELECT value, count(*) AS n, sum(count(*)) OVER () AS total FROM ({_LINKS}) GROUP BY value)
        WHERE n >= 0.004 * total AND n >= 10""",
    "p2_counts": f"""
        SELECT value AS link_value, n FROM (SELECT value, count(*) AS n, sum(count(*)) OVER () AS total FROM ({_LINKS}) GROUP BY value)
        WHERE n >= 0.001 * total""",
    "p7_found": """
        WITH t AS (SELECT chunk_id, lower(regexp_replace(text, '[ \\t\\r\\n\\x{A0}\\x{200B}]', '', 'g')) AS s FROM chunks),
             g AS (SELECT DISTINCT chunk_id, unnest(list_transform(range(1, length(s) - 3), lambda i: substr(s, i, 5))) AS g FROM t WHERE length(s) >= 5),
             n AS (SELECT chunk_id, count(*) AS n FROM g GROUP BY chunk_id),
             j AS (SELECT a.chunk_id AS ca, b.chunk_id AS cb, count(*) AS k FROM g a JOIN g b ON a.g = b.g AND a.chunk_id < b.chunk_id GROUP BY ALL)
        SELECT ca AS chunk_a, cb AS chunk_b FROM j JOIN n x ON x.chunk_id = ca JOIN n y ON y.chunk_id = cb WHERE k * 5 >= 3 * (x.n + y.n - k)""",
    "p9_found": """
        WITH d AS (SELECT doc_id, regexp_replace(lower(nfc_normalize(text)), '[^\\p{L}\\p{N}]', '', 'g') AS s FROM documents),
             e AS (SELECT item_id, regexp_replace(lower(nfc_normalize(text)), '[^\\p{L}\\p{N}]', '', 'g') AS s FROM eval_items),
             a AS (SELECT doc_id, unnest(list_transform(range(1, length(s) - 48), lambda i: substr(s, i, 50))) AS g FROM d WHERE length(s) >= 50),
             b AS (SELECT item_id, unnest(list_transform(range(1, length(s) - 48), lambda i: substr(s, i, 50))) AS g FROM e WHERE length(s) >= 50)
        SELECT DISTINCT doc_id, item_id FROM a JOIN b USING (g)""",
    "p10_found": """
        WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
             x AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w WHERE len(w) >= 24)
        SELECT doc_id FROM (SELECT doc_id, count(*) AS n, count(DISTINCT g) AS d FROM x GROUP BY doc_id) WHERE (n - d) * 10 >= n * 3""",
}
