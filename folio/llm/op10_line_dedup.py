"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line stripped of white space at both ends, A-Z lower-cased. Long enough keys that are found in
at least `min_docs` documents lose all their lines but those of the largest doc_id that holds them.

The documents are cut into batches of about as many lines by descending doc_id. A store of sorted runs holds, for each key
hash, in how many documents it was found and the largest of them; a run is a table ordered by the hash within its files. Each
new batch is reduced to one row per key hash, anti-joins the settled keys of the runs (found often enough already: later
documents only lose them), and becomes a run of its own. Two runs of one level are compacted into one of the next by a merge
join. At the end all are compacted and mark the lines to drop. Runs are plain tables, so a join shuffles their rows again,
28 bytes a key; as bucketed tables they took more than 3000 MB of an executor on 0.51 GB of documents.

Keys are compared by 128 bits of xxHash. All of it is DataFrame operations: a key's documents are counted with partial
aggregation, so a key in a third of all documents sends one row per task; where lines join the keys to drop, it is a skewed
join key that adaptive execution splits; texts are shuffled once, when the dropped lines' places join them.

Cases: a null or empty text is one empty line; rows with the same doc_id count as one document, and the largest
doc_id keeps its lines in all its rows; rows with null doc_id lose nothing and count for nothing; other columns ride
along in line_dedup(), those with the names of its results replaced, and are left out of the query.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, documents, drop_stored, stored

HASH = ["h1", "h2"]
#: Ranges of ids in the histogram by which batches are cut.
CELLS = 1_000


def line_key(line):
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


class Runs:
    """Levelled sorted runs of (h1, h2, n_docs, keeper)."""

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.levels: list[DataFrame | None] = []

    def _write(self, rows: DataFrame) -> DataFrame:
        return stored(rows.sortWithinPartitions(*HASH), "run")

    def _merged(self, one: DataFrame, two: DataFrame) -> DataFrame:
        """Two runs as one, by a merge join; the old ones go."""
        both = one.join(two.select(*HASH, F.col("n_docs").alias("more"), F.col("keeper").alias("other")), HASH, "full_outer")
        n = F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))
        out = self._write(both.select(*HASH, n.alias("n_docs"), F.greatest("keeper", "other").alias("keeper")))
        drop_stored(one)
        drop_stored(two)
        return out

    def add(self, lines: DataFrame) -> None:
        """Adds the batch (h1, h2, doc_id), whose documents come before all of the runs' in the order of descending ids."""
        once = lines.groupBy(*HASH, "doc_id").count()
        new = once.groupBy(*HASH).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        for run in [r for r in self.levels if r is not None]:
            new = new.join(run.where(F.col("n_docs") >= self.min_docs).select(*HASH), HASH, "left_anti")
        self._put(self._write(new), 0)

    def _put(self, run: DataFrame, level: int) -> None:
        """A level holds one run; a second one is compacted with it into the next level."""
        if level == len(self.levels):
            self.levels.append(None)
        held, self.levels[level] = self.levels[level], run
        if held is not None:
            self.levels[level] = None
            self._put(self._merged(held, run), level + 1)

    def compact(self) -> DataFrame:
        whole = reduce(self._merged, [run for run in self.levels if run is not None])
        self.levels = [whole]
        return whole

    def frequent(self) -> DataFrame:
        """Rows (h1, h2, keeper) of the keys to drop."""
        return stored(self.compact().where(F.col("n_docs") >= self.min_docs).select(*HASH, "keeper"), "frequent")


def cut_points(lines: DataFrame, batches: int) -> list[int]:
    """Ids, descending, that cut the lines into about as many rows each, from their counts in CELLS equal ranges of ids."""
    low, high = lines.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None or batches < 2:
        return []
    width = -(-(high - low + 1) // CELLS)
    counts = sorted((int(r["cell"]), r["n"]) for r in lines.groupBy(F.floor((F.col("doc_id").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")).alias("cell")).agg(F.count("*").alias("n")).collect())
    share, seen, cuts = sum(n for _, n in counts) / batches, 0, []
    for cell, n in counts[:-1]:
        seen += n
        if seen >= share * (len(cuts) + 1):
            cuts.append(low + (cell + 1) * width - 1)
    return cuts[::-1]


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4) -> DataFrame:
    """The documents with n_lines, n_dropped and the new text in `deduped`; see the module for the method and cases."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.split(F.coalesce("text", F.lit("")), "\n").alias("line"))
    lines = texts.where("doc_id is not null").select("doc_id", F.posexplode("line").alias("at", "line"))
    lines = lines.where(F.length("line") >= min_chars).select("doc_id", "at", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    lines = stored(lines.select("doc_id", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(10), "key").alias("h2")), "lines")
    runs = Runs(min_docs)
    cuts = cut_points(lines, batches)
    for low, high in zip([*cuts, None], [None, *cuts], strict=True):
        own = lines.where("true" if low is None else f"doc_id > {low}").where("true" if high is None else f"doc_id <= {high}")
        runs.add(own.select(*HASH, "doc_id"))
    drops = lines.join(runs.frequent(), HASH).where("doc_id < keeper").groupBy("doc_id").agg(F.array_sort(F.collect_set("at")).alias("drops_"))
    rest = [c for c in docs.columns if c.lower() not in ("text", "n_lines", "n_dropped", "deduped")]
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row_"), "text", F.col("doc_id").cast("long").alias("key_")).join(drops.withColumnRenamed("doc_id", "key_"), "key_", "left").drop("key_")
    line = F.split(F.coalesce("text", F.lit("")), "\n")
    edge = F.concat(F.array(F.lit(-1)), F.col("drops_"), F.array(F.size("lines_")))
    pieces = F.transform(F.sequence(F.lit(1), F.size("edges_") - 1), lambda i: F.slice("lines_", F.element_at("edges_", i) + 2, F.element_at("edges_", i + 1) - F.element_at("edges_", i) - 1))
    out = out.withColumn("lines_", line).withColumn("n_lines", F.size("lines_").cast("long")).withColumn("n_dropped", F.coalesce(F.size("drops_"), F.lit(0)).cast("long"))
    out = out.withColumn("edges_", F.when(F.col("drops_").isNotNull(), edge))
    kept = F.when(F.col("drops_").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.flatten(pieces), "\n"))
    return out.withColumn("deduped", kept).select("row_.*", "text", "n_lines", "n_dropped", "deduped")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("deduped", "UTF-8"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, place, parts[place] AS line, translate(trim(parts[place], chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS place FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), f AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT l.*, f.key IS NOT NULL AND l.doc_id < f.keeper AS gone FROM l LEFT JOIN f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
