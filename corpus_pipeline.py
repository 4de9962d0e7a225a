"""A corpus pipeline: quality rules, line dedup, near duplicates, decontamination, SentencePiece encoding.

Each stage takes all documents that its predecessor kept, written as Parquet and read again, and its decisions take
effect. All stages but the last return the columns of documents with the input's values; the last adds ids and n_tokens.
Columns of the operators' own names are kept as the input has them, but for ids and n_tokens in the last stage.

A stage's tables in the shared folder are scratch of the thread, the input folder and the stage. They are deleted when
a later stage begins on the same folder in the same thread, since the earlier ones' results are written by then.

Cases in all stages: empty tables give empty tables; null, empty and very long texts are ordinary texts; rows are judged
one by one where a stage doesn't say otherwise, so repeated rows share their fate.
"""

from __future__ import annotations

import threading
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import Scratch, documents, sized, stored
from folio.llm.op1_ngram_join import ngram_join
from folio.llm.op5_decontamination import contaminated
from folio.llm.op6_sentencepiece import encode
from folio.llm.op7_quality_rules import judge
from folio.llm.op10_line_dedup import line_dedup

#: Most ids that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
_scratch = threading.local()


def scratched(order: int):
    """Runs a stage in a scratch of its own, and deletes those of earlier stages on the same folder."""

    def around(stage):
        @wraps(stage)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            made = _scratch.__dict__.setdefault("made", [])
            for old in [m for m in made if m[0] == sf_dir and m[1] < order]:
                made.remove(old)
                old[2].delete()
            with Scratch(spark) as own:
                made.append((sf_dir, order, own))
                return stage(spark, docs, sf_dir)

        return run

    return around


def carried(docs: DataFrame, *own: str, but: str = "") -> DataFrame:
    """The operator's own columns and row_, the input's row (but one column), so that no column clashes with an operator's."""
    return docs.select(*own, F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != but]).alias("row_"))


@scratched(1)
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or their group's thresholds reject go. A null or empty text has no words and goes; null
    lang and source are a group like any other."""
    return judge(carried(docs, "text", "lang", "source"), ["row_"]).where("kept").select("row_.*")


@scratched(2)
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three or more documents stay in the largest doc_id only; text and n_chars are those of what is left.
    Rows of one doc_id are one document; rows without a doc_id lose nothing and count for nothing; a null text becomes empty."""
    out = line_dedup(carried(docs, "doc_id", "text", but="text"))
    text = {"text": F.col("deduped"), "n_chars": F.length("deduped").cast("long")}
    return out.select(*[(text[c] if c in text else F.col(f"row_.`{c}`")).alias(c) for c in docs.columns])


@scratched(3)
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles at a similarity of 0.8 or more, the document with the smallest doc_id stays.

    Rows with one doc_id are one document; of its equal texts one row stays, of any different ones each. Rows without a
    doc_id can't be told apart by it: of their equal texts one row stays, and none if a document has the same text. A text
    without words links with nothing and is compared as a text.
    """
    found = stored(ngram_join(docs.where("doc_id is not null"), 5, 80, 100), "found")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null")
    kept = named.join(sized(gone, BROADCAST_ROWS), "doc_id", "left_anti")
    twice = sized(stored(named.groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice"), BROADCAST_ROWS)
    once = kept.join(twice, "doc_id", "left_anti").unionByName(kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
    mark = F.xxhash64(F.coalesce("text", F.lit(""))), F.xxhash64(F.lit(3), F.coalesce("text", F.lit("")))
    bare = docs.where("doc_id is null").withColumns({"m1_": mark[0], "m2_": mark[1]}).dropDuplicates(["m1_", "m2_"])
    bare = bare.join(named.select(mark[0].alias("m1_"), mark[1].alias("m2_")), ["m1_", "m2_"], "left_anti")
    return once.select(docs.columns).unionByName(bare.select(docs.columns))


@scratched(4)
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; of rows with one doc_id all go if one holds it. Rows without a doc_id are judged by
    their texts. A benchmark without rows, or with null and empty ones only, takes nothing away."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    gone = stored(contaminated(docs.select("doc_id", "text"), benchmark).select("doc_id").distinct(), "gone")
    kept = docs.where("doc_id is not null").join(sized(gone, BROADCAST_ROWS), "doc_id", "left_anti").select(docs.columns)
    bare = docs.where("doc_id is null")
    if bare.isEmpty():
        return kept
    by_text = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = bare.select(by_text.alias("doc_id"), "text").dropDuplicates(["doc_id"])
    found = contaminated(texts, benchmark).select(F.col("doc_id").alias("mark_")).distinct()
    return kept.unionByName(bare.withColumn("mark_", by_text).join(found, "mark_", "left_anti").select(docs.columns))


@scratched(5)
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts; a null or empty text has none. An input's own ids and n_tokens are replaced."""
    return encode(docs.drop("ids", "n_tokens")).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]
#: SQL can't express SentencePiece's encoding; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not tokens:
            docs = stored(docs, name)
    return docs
