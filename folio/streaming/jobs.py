"""Outcomes of jobs from their polled states: rows (job_id, status, at), as a batch or as a stream with a timer for each job.

A job ends with its earliest terminal status; of those of one moment the first by name counts. Without one until `wait` after its first row it
is expired then. A stream knows an outcome only when its watermark has passed that moment, so rows that come out of order don't change what was
told: rows that are later than the watermark are dropped, as Spark does. Repeated rows change nothing. A finished job is remembered
until `keep` after its first row, so a job's rows must end by then and ids must not be used again. Null ids, statuses and times don't count.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Statuses that end a job, and those of them that are a success.
TERMINAL, GOOD = ("ended", "completed", "canceled", "expired", "errored"), ("ended", "completed")
DAY = 86_400_000


def _known(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("job_id").isNotNull() & F.col("status").isNotNull() & F.col("at").isNotNull())


def _told(rows: DataFrame) -> DataFrame:
    return rows.select("job_id", "status", F.col("status").isin(*GOOD).alias("good"), F.timestamp_millis("ms").alias("at"))


def outcomes(rows: DataFrame, now: Column, wait: int = DAY) -> DataFrame:
    """Rows (job_id, status, good, at) of the jobs whose outcome lies before `now`; wait in milliseconds. Minima only, so Spark combines them before the shuffle."""
    ms = F.unix_millis("at")
    of = _known(rows).groupBy("job_id").agg(F.min(ms).alias("first"), F.min(F.when(F.col("status").isin(*TERMINAL), F.struct(ms.alias("ms"), "status"))).alias("end"))
    of = of.withColumn("x", F.when(F.col("end.ms") <= F.col("first") + wait, F.col("end")).otherwise(F.struct((F.col("first") + wait).alias("ms"), F.lit("expired").alias("status"))))
    return _told(of.select("job_id", "x.*").where(F.col("ms") < F.unix_millis(now)))


def outcome_stream(rows: DataFrame, late: str = "1 hour", wait: int = DAY, keep: int = 7 * DAY) -> DataFrame:
    """The rows of outcomes() of a stream, each once, when the watermark (`late` behind the newest row) has passed them."""
    if keep < wait:
        raise ValueError(f"keep ({keep}) must not be shorter than wait ({wait})")

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, end, status, done = state.get if state.exists else (None, None, None, False)
        for part in parts:
            for ms, name in zip(part["ms"].tolist(), part["status"].tolist(), strict=True):
                first = ms if first is None else min(first, ms)
                if name in TERMINAL and (end is None or (ms, name) < (end, status)):
                    end, status = ms, name
        mark = state.getCurrentWatermarkMs()
        limit = first + wait
        due, name = (end, status) if end is not None and end <= limit else (limit, "expired")
        if not done and due < mark:
            done = True
            yield pd.DataFrame({"job_id": [key[0]], "status": [name], "ms": [due]})
        at = first + keep if done else due
        if done and at <= mark:
            state.remove()
        else:
            state.update((first, end, status, done))
            state.setTimeoutTimestamp(max(at, mark + 1))

    kind = rows.schema["job_id"].dataType.simpleString()
    of = _known(rows).withWatermark("at", late).select("job_id", "status", "at", F.unix_millis("at").alias("ms"))
    return _told(of.groupBy("job_id").applyInPandasWithState(step, f"job_id {kind}, status string, ms long", "first long, end long, status string, done boolean", "append", GroupStateTimeout.EventTimeTimeout))
