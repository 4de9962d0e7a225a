"""Quality rules with adaptive thresholds.

Measures of each document (as integers, so that sums and orders are exact) go into mergeable quantile sketches, one
for each measure, language and source: counts of logarithmic buckets, which merge by addition, give the same result in
any order, and bound the relative error of a quantile by 1 / 2^BITS. Each group's thresholds are fences around its
quantiles: above upper + spread * (upper - median), below lower - spread * (median - lower). Groups with fewer than
`least` documents take the fences of their language, and of all documents if that is small too. The thresholds join
the documents and filter them. A document that fails the fixed base rule is rejected in any case and is left out of
the sketches.

Repeated windows are found inside a row: its windows' hashes are sorted with their places and equal neighbours
marked. Everything is DataFrame operations; shuffled are only bucket counts, combined before the shuffle, so neither
a hot source nor a hot language weighs on one task, and the thresholds, bounded by the number of groups, join last.

Cases: null text has no words; null lang or source are groups of their own; repeated rows count as often as they
occur; in an empty table nothing is judged; other columns ride along in judge(), those with the names of its results
replaced, and are left out of the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, sized, stored, words

BITS = 6
#: Most groups of a language and a source whose thresholds are broadcast.
BROADCAST_ROWS = 200_000
#: Measure, its numerator and denominator: thousandths. Judged above the upper fence; those in BELOW below the lower one too.
MEASURES = {
    "word_len": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
#: Thousandths that each fence stands off besides its spread, so that a uniform group loses nobody.
SLACK = {"word_len": 1500, "symbols": 60, "dup_lines": 300, "repeats": 200}
BELOW = ["word_len"]
OUT = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed"]


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the array of words in words_ and the base measures of the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("words_", words(F.col(text)))
    out = out.withColumn("n_words", F.size("words_").cast("long"))
    out = out.withColumn("word_chars", F.length(F.translate(t, " \t\n\x0b\f\r", "")).cast("long"))
    out = out.withColumn("n_symbols", (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long"))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
    out = out.withColumn("lines_", lines).withColumn("n_lines", F.size("lines_").cast("long"))
    out = out.withColumn("n_dup_lines", (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"))
    w = F.col("words_")
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    out = out.withColumn("hashes_", F.when(F.size(w) >= 3, windows).otherwise(F.array().cast("array<bigint>")))
    # sorted (hash, place); a place whose hash equals a neighbour's starts a repeated window
    some = F.size(F.array_distinct("hashes_")) < F.size("hashes_")
    placed = F.array_sort(F.transform("hashes_", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("sorted_", F.when(some, placed))
    s = F.col("sorted_")
    marked = F.filter(F.transform(s, lambda x, i: F.when((x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"])), lambda x: x.isNotNull())
    out = out.withColumn("marked_", F.array_sort(marked))
    m = F.col("marked_")
    covered = F.aggregate(F.transform(m, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(m, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    out = out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    return out.drop("words_", "lines_", "hashes_", "sorted_", "marked_")


def bucket(v):
    """The sketch's bucket of a whole number v >= 0: exact below 2^BITS, then 2^BITS for each doubling."""
    shift = F.length(F.bin(v)) - (BITS + 1)
    return F.when(v < 2**BITS, v).otherwise(2**BITS * shift + F.call_function("shiftright", v, shift))


def bucket_value(b):
    """The smallest number of a bucket."""
    shift = F.floor(b / 2**BITS) - 1
    return F.when(b < 2 ** (BITS + 1), b).otherwise(F.call_function("shiftleft", (b - shift * 2**BITS).cast("long"), shift.cast("int")))


def sketch(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Sketches (groups, measure, bucket, n) of the documents that pass the base rule."""
    of = [F.struct(F.lit(m).alias("measure"), bucket(F.floor(1000 * F.col(a) / F.greatest(F.lit(1), F.col(b))).cast("long")).cast("long").alias("bucket")) for m, (a, b) in MEASURES.items()]
    return measured.where("not base_failed").select(*groups, F.explode(F.array(*of)).alias("x")).groupBy(*groups, "x.measure", "x.bucket").agg(F.count("*").alias("n"))


def fences(sketched: DataFrame, groups: list[str], spread: float, slack: dict[str, int]) -> DataFrame:
    """For each group and measure: its number of documents and its fences, from the 10th, 50th and 90th hundredths."""
    from pyspark.sql import Window

    merged = sketched.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*groups, "measure")
    ranked = merged.withColumn("upto", F.sum("n").over(by.orderBy("bucket"))).withColumn("total", F.sum("n").over(by))
    at = lambda q: bucket_value(F.min(F.when(100 * F.col("upto") >= q * F.col("total"), F.col("bucket"))))
    off = F.create_map(*[F.lit(x) for kv in slack.items() for x in kv])[F.col("measure")]
    out = ranked.groupBy(*groups, "measure").agg(F.max("total").alias("n"), at(10).alias("low"), at(50).alias("mid"), at(90).alias("high"))
    return out.select(*groups, "measure", "n", (F.col("low") - F.floor(spread * (F.col("mid") - F.col("low"))) - off).alias("floor"), (F.col("high") + F.floor(spread * (F.col("high") - F.col("mid"))) + off).alias("ceiling"))


def judge(docs: DataFrame, carry: list[str] | None = None, least: int = 100, spread: float = 0.5, slack: dict[str, int] | None = None) -> DataFrame:
    """The documents with their measures, base_failed and kept; see the module.

    carry: the columns of docs to return, all by default. slack: in place of SLACK. The measures are
    written to the shared folder, since both the sketches and the filter read them.
    """
    own = ["lang", "source"]
    carry = docs.columns if carry is None else carry
    slack = slack or SLACK
    carried = F.struct(*[F.col(f"`{c}`") for c in carry if c.lower() not in [*OUT, "kept"]])
    measured = stored(measures(docs.select(carried.alias("row_"), "text", *own)).select("row_", *own, *OUT), "measured")
    sketched = stored(sketch(measured, own), "sketch")
    levels = [(f"f{k}", own[:2 - k]) for k in range(3)]
    limits = sketched.select(*own).distinct().withColumn("one_", F.lit(1))
    for name, keys in levels:
        wide = fences(sketched, keys, spread, slack).groupBy(*keys).pivot("measure", list(MEASURES)).agg(F.first("n").alias("n"), F.first("floor").alias("floor"), F.first("ceiling").alias("ceiling"))
        wide = wide.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], *[F.col(f"{m}_{c}").alias(f"{name}_{m}_{c}") for m in MEASURES for c in ("n", "floor", "ceiling")])
        wide = wide.withColumn(f"{name}_one", F.lit(1))
        on = F.col("one_") == F.col(f"{name}_one")
        for k in keys:
            on &= F.col(k).eqNullSafe(F.col(f"{name}_{k}"))
        limits = limits.join(wide, on, "left")
    of = {}
    for m in MEASURES:
        for c in ("floor", "ceiling"):
            of[f"{m}_{c}_"] = F.when(F.col(f"f0_{m}_n") >= least, F.col(f"f0_{m}_{c}")).when(F.col(f"f1_{m}_n") >= least, F.col(f"f1_{m}_{c}")).otherwise(F.col(f"f2_{m}_{c}"))
    limits = sized(stored(limits.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), *[x.alias(n) for n, x in of.items()]), "limits"), BROADCAST_ROWS)
    out = measured.join(limits, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    bad = F.col("base_failed")
    for m, (a, b) in MEASURES.items():
        v = F.floor(1000 * F.col(a) / F.greatest(F.lit(1), F.col(b)))
        bad |= F.coalesce(v > F.col(f"{m}_ceiling_"), F.lit(False))
        if m in BELOW:
            bad |= F.coalesce(v < F.col(f"{m}_floor_"), F.lit(False))
    return out.withColumn("kept", ~bad).select("row_.*", *OUT, "kept")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    return judge(docs, ["doc_id", "lang", "source"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
