"""Outcomes of jobs: the stream tells what the batch does, each once, over restarts, repeated rows and rows out of order."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from folio.streaming import jobs as m

START, HOUR = datetime(2024, 5, 1), 3_600_000
ROWS = "job_id long, status string, at timestamp"


def frame(spark, rows):
    return spark.createDataFrame([(j, s, None if h is None else START + timedelta(hours=h)) for j, s, h in rows], ROWS)


def told(df):
    return Counter((r.job_id, r.status, r.good, (r.at - START) / timedelta(hours=1)) for r in df.collect())


def test_batch(spark):
    rows = [
        (1, "submitted", 0), (1, "ended", 5), (1, "errored", 7), (2, "submitted", 0), (2, "ended", 30), (3, "submitted", 10), (4, "errored", 3), (4, "ended", 3),
        (5, "submitted", 47), (6, "ended", 40), (None, "ended", 1), (7, None, 1), (8, "ended", None), (1, "ended", 5),
    ]
    now = F.lit(START + timedelta(hours=40))
    want = {(1, "ended", True, 5): 1, (2, "expired", False, 24): 1, (3, "expired", False, 34): 1, (4, "ended", True, 3): 1}
    assert told(m.outcomes(frame(spark, rows), now)) == want
    assert m.outcomes(frame(spark, []), now).count() == 0
    with pytest.raises(ValueError):
        m.outcome_stream(frame(spark, rows), wait=2, keep=1)


def test_stream_equals_batch(spark, tmp_path):
    """Rows come in blocks of ten hours, shuffled within, some twice; the stream is stopped half way and goes on from its checkpoint."""
    rng = random.Random(3)
    rows = []
    for job in range(60):
        at = rng.uniform(0, 60)
        rows.append((job, "submitted", at))
        for _ in range(rng.randint(0, 4)):
            at += rng.uniform(0, 20)
            rows.append((job, rng.choice(["in_progress", *m.TERMINAL]), at))
    rows += rng.sample(rows, 30) + [(999, "submitted", 300.0)]
    blocks = {}
    for r in rows:
        blocks.setdefault(int(r[2] // 10), []).append(r)
    source, out, mark = (str(tmp_path / x) for x in ("source", "out", "mark"))

    def run(keys):
        for k in keys:
            block = blocks[k]
            rng.shuffle(block)
            frame(spark, block).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(source)
        query = m.outcome_stream(stream, late="10 hours", wait=24 * HOUR).writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
        query.awaitTermination()

    keys = sorted(blocks)
    run(keys[:5])
    run([])
    run(keys[5:])
    now = F.lit(START + timedelta(hours=290))
    got, want = told(spark.read.parquet(out)), told(m.outcomes(frame(spark, rows), now, wait=24 * HOUR))
    assert got == want and max(got.values()) == 1 and len(got) == 60 and {"expired", "ended", "errored"} <= {k[1] for k in got}
