"""Query of the jobs' outcomes, as a batch over the events as polled states of jobs; tests/test_jobs.py holds the stream against it."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.plans.catalogue import query, read
from folio.streaming import jobs

_STATUS = {"view": "submitted", "signup": "in_progress", "click": "ended", "purchase": "errored", "error": "canceled"}


@query(f"""
WITH e AS (SELECT event_id % 4001 AS job_id, CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _STATUS.items())} END AS status, epoch_us(ts) // 1000 AS ms FROM events),
f AS (SELECT job_id, min(ms) AS first, min((ms, status)) FILTER (status NOT IN ('submitted', 'in_progress')) AS fin FROM e GROUP BY 1),
x AS (SELECT job_id, CASE WHEN fin[1] <= first + 259200000 THEN fin ELSE (first + 259200000, 'expired') END AS o FROM f)
SELECT job_id, o[2] AS status, o[2] = 'ended' AS good, make_timestamp(o[1] * 1000) AS at FROM x WHERE o[1] < epoch_ms(TIMESTAMP '2024-01-25 00:00:00')
""")
def job_outcomes(spark, sf_dir):
    status = F.create_map(*[F.lit(x) for pair in _STATUS.items() for x in pair])[F.col("event_type")]
    rows = read(spark, sf_dir, "events").select((F.col("event_id") % 4001).alias("job_id"), status.alias("status"), F.to_timestamp(F.col("ts")).alias("at"))
    return jobs.outcomes(rows, F.to_timestamp(F.lit("2024-01-25 00:00:00")), 3 * jobs.DAY)
