"""Language identification by multilingual mixture inference.

Learning: the letters' GRAM-byte strings (words lower-cased and parted by one space) of all labelled texts are counted
for each language, hashed to BINS bins; counts are added in tasks and combined before the one shuffle. A language's
model is the smoothed share of each bin; its size is bounded by BINS times the languages.

Inference: a text is a mixture of languages. Expectation maximisation estimates the proportions from the bins'
likelihoods. Starting from all languages, the one of least proportion is dropped as long as that does not lower the
likelihood less a penalty of half the log of the text's strings for each language kept. The prediction is the language
of the largest proportion, and its score that proportion. Only the text is looked at.

Numbers of any script (½, Ⅳ, ①) are no letters. The model goes to the driver and the tasks: BINS x languages numbers, 65 MB of
float32 in a task and twice that at the driver for the most languages allowed; more raise an error before anything is fetched.

Cases: a text that is null or has no letter gives und and score 0, as does every text if nothing could be learned;
rows with null lang teach nothing; ties go to the language first in the alphabet; repeated rows count as often as they
occur; a null doc_id hashes as the empty text; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stored
from .textbytes import BYTE, U, mix

GRAM, BINS, ROUNDS = 4, 1 << 15, 12
#: Most languages that can be learned: bounds the model at BINS times as many rows.
LANGUAGES = 500
OTHER = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")


def bins_of(text: str) -> np.ndarray:
    """The bins of a text's strings, in order; empty if it has no letter."""
    own = OTHER.sub(" ", text.lower()).strip()
    if not LETTER.search(own):
        return np.zeros(0, np.int64)
    h = BYTE[np.frombuffer(f" {own} ".encode(), np.uint8)]
    out = h[: max(1, len(h) - GRAM + 1)].copy()
    for j in range(1, min(GRAM, len(h))):
        out = out * U(0x9E3779B97F4A7C15) + h[j : j + len(out)]
    return (mix(out) & U(BINS - 1)).astype(np.int64)


def counted(batches):
    """For mapInArrow over (text, lang): counts (lang, bin, n) of the task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums.setdefault(lang, np.zeros(BINS, np.int64))
            sums[lang] += np.bincount(bins_of(text), minlength=BINS)
    for lang, n in sums.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "bin", "n"])


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages and log(share of each bin), bins x languages, from all rows (text, lang) with a language and a text."""
    rows = labelled.where("lang is not null and text is not null").select("text", "lang")
    sums = stored(rows.mapInArrow(counted, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")), "sums")
    if (found := sums.select("lang").distinct().count()) > LANGUAGES:
        raise ValueError(f"{found} languages; the model is bounded at {LANGUAGES}")
    got = sums.toPandas()
    names = sorted(got["lang"].unique())
    table = np.zeros((BINS, len(names)))
    if names:
        table[got["bin"], [names.index(x) for x in got["lang"]]] = got["n"]
    table += 0.5
    return names, np.log(table / table.sum(axis=0))


def mixture(grams: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """The proportion of each language in a text with the given bins."""
    at, n = np.unique(grams, return_counts=True)
    rows = logs[at]
    top = rows.max(axis=1)
    like, total = np.exp(rows - top[:, None]), n.sum()

    def fit(kept: np.ndarray) -> tuple[float, np.ndarray]:
        own = like[:, kept]
        share = np.full(len(kept), 1 / len(kept))
        if len(kept) > 1:
            for _ in range(ROUNDS):
                parts = own * share
                share = (n / parts.sum(axis=1)) @ parts / total
        return float(n @ np.log(np.maximum(own @ share, 1e-300))) - 0.5 * len(kept) * np.log(total), share

    kept = np.arange(logs.shape[1])
    value, share = fit(kept)
    while len(kept) > 1:
        fewer = np.delete(kept, len(kept) - 1 - int(np.argmin(share[::-1])))
        new, part = fit(fewer)
        if new < value:
            break
        kept, value, share = fewer, new, part
    out = np.zeros(logs.shape[1])
    out[kept] = share
    return out


def predict(docs: DataFrame, names: list[str], logs: np.ndarray) -> DataFrame:
    """Rows (doc_id, lang_pred, score, langs): the main language, its proportion, and all languages kept with theirs."""
    logs = logs.astype(np.float32)

    def run(batches):
        for batch in batches:
            main, score, langs = [], [], []
            for text in batch.column(1).to_pylist():
                grams = bins_of(text or "")
                if not len(grams) or not names:
                    main.append("und")
                    score.append(0.0)
                    langs.append([])
                    continue
                share = mixture(grams, logs)
                k = int(np.argmax(share))
                main.append(names[k])
                score.append(float(min(1.0, share[k])))
                langs.append([(names[i], float(share[i])) for i in np.flatnonzero(share)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(main, pa.string()), pa.array(score, pa.float64()), pa.array([[{"lang": a, "share": b} for a, b in x] for x in langs], pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))], ["doc_id", "lang_pred", "score", "langs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, langs array<struct<lang:string,share:double>>")


def fold(doc_id, folds: int):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    names, logs = learn(docs.where(fold(F.col("doc_id"), 5) != 0))
    return predict(docs, names, logs).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")
