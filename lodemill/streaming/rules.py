"""Rules of the crawl as steps over a page's events: change detection, backoff, breaker, limiter."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampNTZType

from ..operators.fold import fold

#: Times of the crawl (fixed values): revisit after a fetch, after a 404, per failure; failures that end the tries.
REVISIT, GONE, RETRY, TRIES = timedelta(days=14), timedelta(days=90), timedelta(minutes=10), 5
#: Failures within the window that open the breaker, and for how long.
FAILURES, WINDOW, PAUSE = 5, timedelta(seconds=60), timedelta(seconds=600)


def backoff_step(state: dict, event: dict) -> tuple[dict, tuple]:
    """state: fails, hash, due. Outcome of a fetch: changed, unchanged, gone or failed.

    A success clears the failures; each failure waits ten minutes longer than the one before; a page
    with an unchanged hash has no effect downstream; a page that is gone is withdrawn.
    """
    now, fails, held = event["ts"], state["fails"], state["hash"]
    if event["kind"] == "gone":
        verdict, due = "gone", now + GONE
    elif event["kind"] == "failed":
        due, fails = now + RETRY * (fails + 1), fails + 1
        verdict = "failed"
    else:
        verdict = "unchanged" if held is not None and held == event["hash"] else "changed"
        fails, held, due = 0, event["hash"], now + REVISIT
    return {"fails": fails, "hash": held, "due": due}, (event["key"], event["seq"], verdict, fails, due, fails < TRIES)


def fetch_outcomes(events: DataFrame) -> DataFrame:
    """key, seq, verdict, fail_count, next_due_at, retried after each event (key, seq, ts, kind, hash).

    The rule of backoff_step over whole histories, by windows: failures are counted since the last success,
    a hash is compared with that of the last success. A null key is a key of its own.
    """
    order = Window.partitionBy("key").orderBy("ts", "seq")
    failed, gone = F.col("kind") == "failed", F.col("kind") == "gone"
    ok = ~(failed | gone)
    held = F.last(F.when(ok, F.struct("hash")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))["hash"]
    parts = events.select("key", "seq", "ts", "kind", "hash").withColumns({"__held": held, "__part": F.sum(ok.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    since = Window.partitionBy("key", "__part").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    counted = parts.withColumn("fail_count", F.sum(failed.cast("int")).over(since).cast("int"))
    verdict = F.when(gone, "gone").when(failed, "failed").when(F.col("__held") == F.col("hash"), "unchanged").otherwise("changed")
    wait = F.when(gone, _interval(GONE)).when(failed, F.make_dt_interval(mins=F.col("fail_count") * int(RETRY.total_seconds() // 60))).otherwise(_interval(REVISIT))
    return counted.select("key", "seq", verdict.alias("verdict"), "fail_count", (F.col("ts") + wait).alias("next_due_at"), (F.col("fail_count") < TRIES).alias("retried"))


def _interval(span: timedelta) -> Column:
    return F.make_dt_interval(days=F.lit(span.days))


def breaker_step(state: dict, event: dict) -> tuple[dict, tuple]:
    """state: the times of the last failures, at most FAILURES, and until when the breaker is open. It opens
    if the oldest of that many is within the window; then, and by a success, they are forgotten."""
    now, recent, until = event["ts"], state["recent"], state["until"]
    open_now = until is not None and now < until
    recent = [*recent, now][-FAILURES:] if event["kind"] == "failed" else []
    if len(recent) == FAILURES and now - recent[0] < WINDOW:
        until, recent = now + PAUSE, []
    return {"recent": recent, "until": until}, (event["key"], event["seq"], open_now, until)


BREAKER = StructType([StructField("key", LongType()), StructField("seq", LongType()), StructField("open", BooleanType()), StructField("open_until", TimestampNTZType())])


def breaker(events: DataFrame) -> DataFrame:
    """key, seq, open (as the event comes in) and open_until (after it)."""
    return fold(events.select("key", "seq", "ts", "kind"), "key", ["ts", "seq"], lambda: {"recent": [], "until": None}, breaker_step, BREAKER)
