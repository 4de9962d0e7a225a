"""Order-dependent checks: one pass over the sorted rows that holds running sums only."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _nesting(batches):
    """For mapInPandas over rows sorted by statement and row: batches are walked as they come, whatever a statement's size."""
    close = lambda a, b: abs(a - b) <= 1
    first, table = True, None
    for batch in batches:
        status = []
        for own, flag, amt in zip(batch["table_id"], batch["flag"], batch["amt"], strict=True):
            own = None if pd.isna(own) else own
            if first or own != table:
                first, table = False, own
                inner = since = totals = 0
                some = open_ = False  # items since the last total; totals since the last outer one
            amt = 0 if amt is None else amt
            verdict = None
            if flag == "DPG":
                inner, since, some = 0, 0, False
            elif flag == "DP":
                inner, since, some = inner + amt, since + amt, True
            elif flag == "CP":
                if some and (close(inner, amt) or close(since, amt)):
                    verdict, totals, open_, inner = "PASS", totals + amt, True, 0
                elif open_ and (close(totals, amt) or some and close(totals + since, amt)):
                    verdict, totals, open_ = "PASS", 0, False
                else:
                    verdict, totals, open_ = "FAIL", totals + amt, True
                since, some = 0, False
            status.append(verdict)
        yield batch.assign(status=pd.Series(status, index=batch.index, dtype=object))[["table_id", "row_order", "flag", "status"]]


def nested_totals(rows: DataFrame) -> DataFrame:
    """Totals that nest: each against its items, or the totals since the last outer one. The last two totals' failures are blanked.

    A statement is walked in order by one task, from a sort that spills; no statement is held in memory as a whole.
    """
    own = rows.selectExpr("table_id", "row_order", "flag", "cast(amt as decimal(38,4)) as amt")
    kind = own.schema["table_id"].dataType.simpleString()
    walked = own.repartition("table_id").sortWithinPartitions("table_id", "row_order").mapInPandas(_nesting, f"table_id {kind}, row_order int, flag string, status string")
    last = F.row_number().over(Window.partitionBy("table_id", F.col("status").isNull()).orderBy(F.desc("row_order"))) <= 2
    walked = walked.withColumn("last", last)
    return walked.select("table_id", "row_order", "flag", F.when(F.col("last") & (F.col("status") != "PASS"), "").otherwise(F.col("status")).alias("status"))
