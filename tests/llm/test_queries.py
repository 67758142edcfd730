"""Queries of the subpackage on tables that the test data don't hold."""

import base64

import tiktoken

from lodemill.llm import queries, tokens
from lodemill.session import tokenizer_dir


def test_p8_ids_of_long_texts(spark, tmp_path):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{tokenizer_dir()}/byte_bpe_50k.tiktoken", "rb"))}
    whole = tiktoken.Encoding("test", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    texts = [" ".join(f"word{i} 낱말{i % 97}, it's 12" for i in range(9000)), "x" * (3 * tokens.CHUNK), " \n" * tokens.CHUNK, "a b", "", None]
    assert sum(len(t or "") > tokens.CHUNK for t in texts) == 3
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.ids for r in queries.QUERIES["p8_ids"](spark, str(tmp_path)).collect()}
    assert got == {i: whole(t) if t else [] for i, t in enumerate(texts)}
