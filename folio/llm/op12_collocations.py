"""Phrase collocation mining: n-grams counted as rows, scored at their weakest cut, reduced to maximal phrases.

A text is cut at breaks (`.,;:!?` and line ends) into pieces and those into words, A-Z lower-cased. All is per language.

1. Level n explodes the n-grams of all texts into rows (language, prefix, word): the hash of the first n-1 words and of the last
   one. A hash-aggregate gives their counts, and those found often enough are kept. An n-gram can't be found more often than
   its two parts of n-1 words, so level n explodes only what is made of two frequent parts; the filter is a bitmap of hashes,
   sized by the number of frequent n-grams and 32 MB at most. A full bitmap passes more rows, never less, and counts stay exact.
2. Frequent n-grams carry the hashes of all prefixes and suffixes: the suffixes of an n-gram are those of its prefix, one word on.
3. Each cut of a candidate joins the counts of its first part and of its rest; scores are Decimal and the weakest cut counts.
4. A candidate inside a longer phrase of the same count is one inside a one-word extension of that count, as counts in between are
   between theirs; so an anti-join with the extensions' two parts drops all of them.
5. Ranks by score and count, ties included, cut each language, first in salted parts and then whole; a last pass over the texts
   spells what is left, and the phrases' order settles ties.

Phrases are compared by the 64-bit hashes of their prefix and of their last word. Counts cover all texts; no row of counts is
capped. Hot languages and phrases: each task sends one row for each n-gram it holds, and joins on a frequent word are skewed keys
that adaptive execution splits.

Cases: a null or empty text has no words; null lang is `und`; ties rank by phrase in UTF-8 order; repeated rows count as often as
they occur; doc_id isn't used; a very long text is read in parts that end at breaks; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, stored
from .marks import bitmap_of, chained, marked
from .textbytes import U, joined_words, word_table

#: What ends a piece, and what separates words in it.
BREAK = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\x0b\x0c\r"])
APART = BREAK | np.isin(np.arange(256), [0x20, 0x09])
#: Bytes of text in work at a time, if a break allows; parts of a ranking.
WORK, SALTS = 4_000_000, 64


def language_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little", signed=True)


def parts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' bytes and where texts end in them, about WORK bytes at a time; a part ends with a text or at a break."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = int(ends[0])
    while at < ends[-1]:
        to = min(at + WORK, int(ends[-1]))
        if to < ends[-1]:
            whole = int(ends[np.searchsorted(ends, to, side="right") - 1])
            if whole > at:
                to = whole
            else:  # inside a text of more than WORK bytes
                inside = np.flatnonzero(BREAK[data[at:to]])
                while not len(inside) and to < ends[-1]:
                    lo, to = to, min(to + WORK, int(ends[-1]))
                    inside = np.flatnonzero(BREAK[data[lo:to]]) + (lo - at)
                to = at + int(inside[-1]) + 1 if len(inside) else to
        inner = ends[(ends > at) & (ends < to)]
        yield data[at:to], np.concatenate([[at], inner, [to]]) - at
        at = to


class Grams:
    """The words of a part, and its n-grams as chained hashes."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, language: int):
        hashes, starts, _ = word_table(data, ends, apart=APART)
        self.data, self.ends = data, ends
        self.words = chained(np.array([language], np.int64).view(U), hashes) if len(hashes) else hashes
        self.piece = np.cumsum(BREAK[data])[starts] + np.searchsorted(ends, starts, side="right") if len(starts) else starts
        self.n, self.grams = 1, self.words

    def longer(self) -> None:
        self.n += 1
        self.grams = chained(self.grams[:-1], self.words[self.n - 1 :])

    def whole(self, n: int) -> np.ndarray:
        """Whether n words from here on are in one piece."""
        return self.piece[: len(self.piece) - n + 1] == self.piece[n - 1 :]


def _by_language(batches) -> Iterator[tuple[str, Grams]]:
    for batch in batches:
        for lang in pc.unique(batch.column("lang")).to_pylist():
            for data, ends in parts(batch.column("text").filter(pc.equal(batch.column("lang"), lang))):
                yield lang, Grams(data, ends, language_hash(lang))


def count_words(batches):
    """For mapInArrow over (lang, text): rows (language, prefix, word, n, lang) of the words of each part, and one with null word and lang for all of them."""
    for lang, part in _by_language(batches):
        words, n = np.unique(part.words, return_counts=True)
        rows = len(words) + 1
        yield pa.RecordBatch.from_arrays([pa.array([language_hash(lang)] * rows, pa.int64()), pa.array([0] * rows, pa.int64()), pa.array([*words.view(np.int64).tolist(), None], pa.int64()), pa.array([*n.tolist(), len(part.words)], pa.int64()), pa.array([None] * (rows - 1) + [lang])], ["language", "prefix", "word", "n", "lang"])


def count_grams(n: int, bitmap):
    """For mapInArrow over (lang, text): rows (language, prefix, word, n) of the n-grams of each part whose two parts of n-1 words are marked."""

    def run(batches):
        marks = np.frombuffer(bitmap.value, np.uint8)
        for lang, part in _by_language(batches):
            while part.n < n - 1 and len(part.grams):
                part.longer()
            if len(part.words) < n:
                continue
            known = marked(marks, part.grams)
            at = np.flatnonzero(part.whole(n) & known[:-1] & known[1:])
            prefix, word = part.grams[at], part.words[at + n - 1]
            _, first, count = np.unique(chained(prefix, word), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), language_hash(lang)), pa.int64()), pa.array(prefix[first].view(np.int64)), pa.array(word[first].view(np.int64)), pa.array(count, pa.int64())], ["language", "prefix", "word", "n"])

    return run


def spell(most: int, bitmap):
    """For mapInArrow over (lang, text): rows (gram, phrase) of the marked phrases of 2 to `most` words, once for each part."""

    def run(batches):
        marks = np.frombuffer(bitmap.value, np.uint8)
        for _, part in _by_language(batches):
            buffer = None
            while part.n < min(most, len(part.words)):
                part.longer()
                at = np.flatnonzero(part.whole(part.n) & marked(marks, part.grams))
                grams, first = np.unique(part.grams[at], return_index=True)
                if len(grams):
                    buffer, start, end, _ = buffer or joined_words(part.data, part.ends, APART)
                    buffer = buffer, start, end, None
                    lo, hi = start[at[first]].tolist(), end[at[first] + part.n - 1].tolist()
                    yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array([buffer[0][a:b] for a, b in zip(lo, hi, strict=True)], pa.binary()).cast(pa.string())], ["gram", "phrase"])

    return run


def frequent_grams(texts: DataFrame, most: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Rows (language, lang, n) of all words of each language; rows (language, length, gram, f, heads, tails) of all phrases of 1 to
    `most` words found `least` times or more, with the hashes of their first 1.. and last 1.. words."""
    counted = texts.mapInArrow(count_words, "language long, prefix long, word long, n long, lang string")
    level = counted.groupBy("language", "word").agg(F.sum("n").alias("f"), F.max("lang").alias("lang"))
    level = stored(level.where(F.col("word").isNull() | (F.col("f") >= least)), "words")
    totals = level.where("word is null").select("language", "lang", F.col("f").alias("n"))
    none = F.array().cast("array<long>")
    levels = [level.where("word is not null").select("language", F.lit(1).alias("length"), F.col("word").alias("gram"), "f", none.alias("heads"), none.alias("tails"))]
    for n in range(2, most + 1):
        bitmap = bitmap_of(levels[-1], "gram")
        found = texts.mapInArrow(count_grams(n, bitmap), "language long, prefix long, word long, n long")
        found = found.groupBy("language", "prefix", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        shorter = levels[-1].select("language", F.col("gram").alias("prefix"), "heads", "tails")
        heads = F.concat("heads", F.array("prefix"))
        tails = F.concat(F.array("word"), F.transform("tails", lambda t: F.xxhash64(t, "word")))
        level = found.join(shorter, ["language", "prefix"]).select("language", F.lit(n).alias("length"), F.xxhash64("prefix", "word").alias("gram"), "f", heads.alias("heads"), tails.alias("tails"))
        levels.append(stored(level, f"grams{n}"))
        bitmap.unpersist()
    return totals, reduce(DataFrame.union, levels)


def collocations(docs: DataFrame, most: int = 5, least: int = 100, first: int | None = 2000, scale: int = 1000) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score) of each language's first phrases; all with first=None. See the module for method and cases."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    totals, grams = frequent_grams(texts, most, least)
    phrases = grams.where("length > 1")
    counts = grams.select("language", "gram", "f")
    cuts = phrases.select("language", "gram", "length", F.col("f").alias("a"), "heads", "tails", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = cuts.select("language", "gram", "length", "a", "k", F.element_at("heads", F.col("k")).alias("head"), F.element_at("tails", F.col("length") - F.col("k")).alias("tail"))
    cuts = cuts.join(counts.select("language", F.col("gram").alias("head"), F.col("f").alias("l")), ["language", "head"])
    cuts = cuts.join(counts.select("language", F.col("gram").alias("tail"), F.col("f").alias("r")), ["language", "tail"]).join(F.broadcast(totals), "language")
    exact = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    cuts = cuts.withColumns({"over_": F.lit(scale).cast("decimal(4,0)") * exact["a"] * exact["n"], "under_": exact["l"] * exact["r"]})
    cuts = cuts.withColumn("score", F.expr("over_ div under_"))
    scored = cuts.groupBy("language", "gram").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("lang").alias("lang"), F.first("n").alias("n"))
    parts_ = phrases.where("length > 2").select("language", F.explode(F.array(F.element_at("heads", -1), F.element_at("tails", -1))).alias("gram"), F.col("f").alias("a"))
    scored = scored.join(parts_, ["language", "gram", "a"], "left_anti").select("lang", "gram", "a", "cut.l", "cut.r", "n", "cut.score")
    best = [F.desc("score"), F.desc("a")]
    if first:
        salted = scored.withColumn("salt_", F.pmod(F.xxhash64("gram"), F.lit(SALTS)))
        for keys in (["lang", "salt_"], ["lang"]):
            salted = salted.withColumn("place_", F.rank().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("place_") <= first)
        scored = salted.drop("salt_", "place_")
    scored = stored(scored, "scored")
    spelt = texts.mapInArrow(spell(most, bitmap_of(scored, "gram")), "gram long, phrase string").groupBy("gram").agg(F.min("phrase").alias("phrase"))
    out = scored.join(spelt, "gram")
    if not first:
        return out.select("lang", F.lit(None).cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase")).cast("long")).where(F.col("rank") <= first)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p
), g AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size
), f AS (
  SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY lang, size, phrase
), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND f >= 100
), cut AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, size)) AS k FROM c)
), s AS (
  SELECT cut.*, x.f AS l, y.f AS r, n.n, ((1000::HUGEINT * a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN n USING (lang) JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = tail
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), m AS (
  SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.size > b.size AND c.a >= b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m) WHERE rank <= 2000
"""
