from collections import Counter

import pytest

from lodemill.llm import frequent


def brute(values, share, least=1):
    values = [v for v in values if v is not None]
    return {(v, n) for v, n in Counter(values).items() if n >= share * len(values) - 1e-9 and n >= least}


CASES = {
    "skewed": ["hot"] * 700 + [f"v{i % 300}" for i in range(900)] + [None] * 50,
    "ties": [f"v{i % 20}" for i in range(400)],
    "boundary": ["a"] * 4 + [f"u{i}" for i in range(996)],
    "one": ["x"],
    "odd": ["", " ", "a\nb", "é", "é", "z" * 5000, "", ""],
    "none": [None, None],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("run_rows", [frequent.RUN_ROWS, 7])
def test_frequent(spark, monkeypatch, case, run_rows):
    monkeypatch.setattr(frequent, "RUN_ROWS", run_rows)
    df = spark.createDataFrame([(v, 1) for v in CASES[case]], "value string, n int").repartition(5)
    got = {(r.value, r.n) for r in frequent.frequent_values(df, "value", share=0.004, ranges=4).collect()}
    assert got == brute(CASES[case], 0.004)


def test_least_and_empty(spark):
    df = spark.createDataFrame([("a",)] * 9 + [("b",)] * 10, "v string")
    assert [r.value for r in frequent.frequent_values(df, "v", share=0.1, least=10).collect()] == ["b"]
    assert frequent.frequent_values(df.limit(0), "v", share=0.1).collect() == []
