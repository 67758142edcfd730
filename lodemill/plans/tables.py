"""Views of the corpus tables that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.titles import filled, name
from ..session import table


def link_entries(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """columns, pos and value: the elements of documents.outlinks that are neither null nor blank."""
    docs = table(spark, root, "documents")
    return docs.select(*columns, F.posexplode("outlinks").alias("pos", "value")).where(filled(F.col("value")))


def known_pages(spark: SparkSession, root: str) -> DataFrame:
    """name of all titles that a document or a seed provides."""
    docs, seeds = table(spark, root, "documents"), table(spark, root, "seed_titles")
    return docs.select("title").unionByName(seeds.select("title")).where("title IS NOT NULL").select(name(F.col("title")).alias("name"))


def alias_targets(spark: SparkSession, root: str) -> DataFrame:
    """name and target of all redirects."""
    redirects = table(spark, root, "redirects").select("alias", "canonical").distinct()
    return redirects.where("alias IS NOT NULL").select(name(F.col("alias")).alias("name"), name(F.col("canonical")).alias("target"))


def month(column: str):
    """yyyy-MM of a time without a zone, 'none' for a null."""
    return F.coalesce(F.substring(F.col(column).cast("string"), 1, 7), F.lit("none"))
