"""python -m lodemill QUERY --root FOLDER --out FOLDER: runs a query over corpus tables and writes its rows as Parquet."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import graphs, quality, relational, retrieval, states, texts, upkeep


def queries() -> dict:
    """The core's queries by name."""
    return {k: f for m in (upkeep, relational, graphs, texts, retrieval, states, quality) for k, f in m.QUERIES.items()}


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lodemill", description=__doc__)
    known = queries()
    parser.add_argument("query", choices=sorted(known), metavar="QUERY")
    parser.add_argument("--root", required=True, help="folder of the corpus tables")
    parser.add_argument("--out", help="folder to write to; without it the plan is shown")
    given = parser.parse_args(args)
    spark = SparkSession.builder.appName(f"lodemill {given.query}").getOrCreate()
    df = known[given.query](spark, given.root)
    if given.out:
        df.write.parquet(given.out)
    else:
        df.explain("formatted")


if __name__ == "__main__":
    main()
