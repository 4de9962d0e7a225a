"""LM scoring with a hidden Markov language model.

Tokens are the words, A-Z lower-cased, and one end for each text.

1. Counts of all training tokens, combined before the shuffle, give the base score and the emissions of rare words; this
   table grows with the corpus and stays distributed.
2. The most frequent words, at most SYMBOLS, are symbols of their own; a rarer word is the symbol of its length in bytes (up
   to CLASSES) times its smoothed share among that class's words, (count + 1) / (tokens + words + 1); the end is a symbol.
   Which words are frequent is a threshold on counts, found in a histogram of them, so only those words go to the driver.
3. Baum-Welch: in each round every task runs the scaled forward and backward recursions over its whole training texts and
   adds up expected counts and the log likelihood; these are summed across tasks and give the next parameters. Rounds go on
   until the likelihood of a token gains less than TOLERANCE of itself, or ROUNDS. The model is bounded by the states times
   the symbols, whatever the corpus.
4. Scores: the scaled forward recursion over each whole text gives the exact log likelihood of its symbols, to which
   the rare words' shares are added. Counts of the most frequent words, at most HEAD, go to the tasks; those of rarer words
   are joined by hash and summed for each text.

Words are compared by 64-bit hashes. The rows of a batch run together, longest first, so a long text costs its own steps only;
a text of more than BLOCK tokens keeps its forward probabilities at a few places and runs forward from them again.

Cases: a null text is empty and has its end only; repeated rows are scored each and count as often as they occur; a
null doc_id hashes as the empty text; without training texts every token has base probability 1 and the model's
emissions are uniform; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stored
from .textbytes import U, chunks, mix, spread, word_table

STATES, SYMBOLS, CLASSES, HEAD = 6, 65_536, 16, 200_000
ROUNDS, TOLERANCE, BLOCK = 8, 0.002, 250_000
#: Most bytes of texts in work at a time in a task, a longer text on its own.
CHUNK = 1_000_000
LN10 = float(np.log(10))


def fold(doc_id, folds: int):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def worded(texts: pa.Array):
    """Hashes, byte lengths and text bounds of the words, a few texts at a time."""
    for lo, hi, data, ends in chunks(texts, CHUNK):
        h, starts, bounds = word_table(data, ends)
        space = np.isin(data, [32, 9, 10, 11, 12, 13])
        stops = np.append(np.flatnonzero(space), len(data))
        stop = stops[np.searchsorted(stops, starts)] if len(starts) else starts
        stop = np.minimum(stop, ends[np.searchsorted(ends, starts, side="right")]) if len(starts) else starts
        yield lo, hi, h.view(np.int64), stop - starts, bounds


def counted(batches):
    """For mapInArrow over (text): counts (word, size, n) of the words, combined for each batch."""
    for batch in batches:
        for _, _, h, size, _ in worded(batch.column("text")):
            if len(h):
                own, at, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.minimum(size[at], CLASSES).astype(np.int32)), pa.array(n)], ["word", "size", "n"])


class Head:
    """The most frequent words in the order of their hashes, with counts; those counted `least` times or more are symbols."""

    def __init__(self, words: np.ndarray, n: np.ndarray, least: int):
        order = np.argsort(words, kind="stable")
        self.words, self.n = words[order], n[order]
        own = self.n >= least
        self.kinds = int(own.sum())
        self.end = self.kinds + CLASSES
        self.symbol = np.where(own, np.cumsum(own) - 1, -1).astype(np.int32)
        self.mask = np.int64((1 << max(10, int(len(words)).bit_length() + 3)) - 1)
        self.slots = np.zeros(int(self.mask) + 1, np.int32)
        slot = self.words & self.mask
        self.slots[slot] = np.arange(len(words), dtype=np.int32)
        self.crowded = np.flatnonzero(self.slots[slot] != np.arange(len(words)))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each word, or -1: a table by the hash's low bits holds most words, a sorted list the few that share a slot."""
        if not len(self.words):
            return np.full(len(h), -1)
        at = self.slots[h & self.mask]
        at = np.where(self.words[at] == h, at, -1)
        if len(self.crowded):
            rest = np.flatnonzero(at < 0)
            k = np.minimum(np.searchsorted(self.words[self.crowded], h[rest]), len(self.crowded) - 1)
            hit = self.words[self.crowded[k]] == h[rest]
            at[rest[hit]] = self.crowded[k[hit]]
        return at

    def symbols(self, h: np.ndarray, size: np.ndarray) -> np.ndarray:
        at = self.find(h)
        own = np.where(at >= 0, self.symbol[at] if len(self.symbol) else -1, -1)
        return np.where(own >= 0, own, self.kinds + np.clip(size, 1, CLASSES) - 1)


def sequences(batch: pa.Array, head: Head):
    """The symbols of all texts of a batch one after the other, an end after each, the texts' bounds, and the words' parts (lo, hi, hashes, bounds)."""
    parts, symbols, ends = [], [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for lo, hi, h, size, bounds in worded(batch):
        own = np.insert(head.symbols(h, size), bounds[1:], head.end).astype(np.int32)
        parts.append((lo, hi, h, bounds))
        ends.append(ends[-1][-1] + (bounds + np.arange(len(bounds)))[1:])
        symbols.append(own)
    return np.concatenate(symbols), np.concatenate(ends), parts


class Model:
    """first: probabilities of the state at a text's start; move: of the next state; emit: symbols x states."""

    def __init__(self, first, move, emit):
        self.first, self.move, self.emit = first, move, emit

    @classmethod
    def start(cls, share: np.ndarray, states: int = STATES, seed: int = 7):
        rng = np.random.default_rng(seed)
        emit = share[:, None] * rng.uniform(0.5, 1.5, (len(share), states))
        move = rng.uniform(0.5, 1.5, (states, states)) + 2 * np.eye(states)
        return cls(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def sums(self) -> np.ndarray:
        """Room for expected counts: rows of symbols, then of moves, the first states, and the log likelihood."""
        return np.zeros((len(self.emit) + len(self.move) + 2, len(self.move)))

    def expected(self, symbols: np.ndarray, bounds: np.ndarray, sums: np.ndarray) -> None:
        """Adds the expected counts of whole texts to sums, a block of at most BLOCK tokens or one text at a time."""
        size = np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        done = np.cumsum(size[order])
        lo = 0
        while lo < len(order):
            hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + BLOCK, side="right")))
            self._block(symbols, bounds[:-1][order[lo:hi]], size[order[lo:hi]], sums)
            lo = hi

    def _block(self, symbols, start, size, sums) -> None:
        """Texts in the order of falling sizes; row t of a stretch holds the texts that still go on."""
        steps, states = int(size[0]), len(self.move)
        live = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
        done = np.append(0, np.cumsum(live))
        cuts = [0]
        while cuts[-1] < steps:
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(done, done[cuts[-1]] + BLOCK, side="right")) - 1))

        # States first, so that every operation runs along the texts.
        given, move, back_move = np.ascontiguousarray(self.emit.T), np.ascontiguousarray(self.move.T), self.move

        def forward(lo, hi, before):
            of = np.repeat(np.arange(lo, hi), live[lo:hi])
            text = np.arange(len(of)) - np.repeat(done[lo:hi] - done[lo], live[lo:hi])
            sym = symbols[start[text] + of]
            emit, ahead, scale = np.take(given, sym, axis=1), np.empty((states, len(of))), np.empty(len(of))
            for t in range(lo, hi):
                i, j, m = done[t] - done[lo], done[t + 1] - done[lo], live[t]
                a = (move @ before[:, :m] if t else self.first[:, None]) * emit[:, i:j]
                s = a.sum(axis=0)
                a /= s
                ahead[:, i:j], scale[i:j], before = a, s, a
            return sym, text, emit, ahead, scale, before

        befores, before = [], None
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            befores.append(before)
            run = forward(lo, hi, before)
            before = run[-1]
            sums[-1, 0] += np.log(run[4]).sum()
        back = np.ones((states, len(start)))
        moves = np.zeros((states, states))
        for k in range(len(cuts) - 2, -1, -1):
            lo, hi = cuts[k], cuts[k + 1]
            sym, text, emit, ahead, scale, _ = run if k == len(cuts) - 2 else forward(lo, hi, befores[k])
            emit /= scale
            after = np.empty_like(ahead)
            for t in range(hi - 1, lo - 1, -1):
                i, j, m = done[t] - done[lo], done[t + 1] - done[lo], live[t]
                after[:, i:j] = back[:, :m]
                emit[:, i:j] *= back[:, :m]
                back[:, :m] = back_move @ emit[:, i:j]
            first = live[lo]
            if k:
                moves += befores[k][:, :first] @ emit[:, :first].T
            steps_of = np.repeat(np.arange(lo, hi), live[lo:hi])[first:]
            moves += np.take(ahead, done[steps_of - 1] - done[lo] + text[first:], axis=1) @ emit[:, first:].T
            after *= ahead
            if k == 0:
                sums[-2] += after[:, :first].sum(axis=1)
            for s in range(states):
                sums[: len(self.emit), s] += np.bincount(sym, weights=after[s], minlength=len(self.emit))
        sums[len(self.emit) : -2] += moves * self.move

    @classmethod
    def fitted(cls, sums: np.ndarray, prior: np.ndarray):
        """prior: counts added to those of each symbol, dealt to the states by how often they are in use."""
        used = sums[: len(prior)].sum(axis=0) + 1e-9
        emit = sums[: len(prior)] + prior[:, None] * used / used.sum()
        move = sums[len(prior) : -2] + 0.1
        first = sums[-2] + 0.1
        return cls(first / first.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def log_likelihood(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The log of each text's probability, by the scaled forward recursion."""
        size = np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        size, start = size[order], bounds[:-1][order]
        out = np.zeros(len(order))
        given, move = np.ascontiguousarray(self.emit.T), np.ascontiguousarray(self.move.T)
        a = np.repeat(self.first[:, None], len(order), axis=1)
        live = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right") if len(size) else []
        for t, m in enumerate(live):
            a = (move @ a[:, :m] if t else a[:, :m]) * np.take(given, symbols[start[:m] + t], axis=1)
            s = a.sum(axis=0)
            out[:m] += np.log(s)
            a /= s
        back = np.zeros(len(order))
        back[order] = out
        return back


def train(training: DataFrame, head: Head, counts: np.ndarray, prior: np.ndarray, states: int = STATES, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[Model, list[float]]:
    """Baum-Welch over all rows (text), and the log likelihood before each round; expected counts are summed in tasks, then across them."""
    share = counts + prior
    model, seen = Model.start(share / share.sum(), states), []
    columns = [f"s{i}" for i in range(states)]
    for _ in range(rounds):

        def run(batches, model=model):
            sums = model.sums()
            for batch in batches:
                symbols, bounds, _ = sequences(batch.column("text"), head)
                model.expected(symbols, bounds, sums)
            at = np.flatnonzero(sums.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(sums[at, i]) for i in range(states)]], ["row", *columns])

        got = training.mapInArrow(run, "row long, " + ", ".join(f"{c} double" for c in columns)).groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
        sums = model.sums()
        sums[got["row"]] = got[columns]
        seen.append(float(sums[-1, 0]))
        model = Model.fitted(sums, prior)
        if len(seen) > 1 and seen[-1] - seen[-2] <= tolerance * abs(seen[-2]):
            break
    return model, seen


#: Steps of the histogram of counts in one doubling.
STEPS = 16


def thresholds(counts: DataFrame, *most: int) -> list[int]:
    """For each bound the least count, 2 or more, that at most so many words reach, by a histogram of counts in steps of a sixteenth of a doubling."""
    step = F.floor(F.log2("n") * STEPS).cast("int")
    got = sorted(((r["step"], r["least"], r["words"]) for r in counts.where("n > 1").groupBy(step.alias("step")).agg(F.min("n").alias("least"), F.count("*").alias("words")).collect()), reverse=True)
    out = []
    for bound in most:
        least, words = 1 << 62, 0
        for _, n, more in got:
            words += more
            if words > bound:
                break
            least = n
        out.append(least)
    return out


def lm_scores(docs: DataFrame, held_out, states: int = STATES) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); held_out: a column of docs' rows to learn nothing from."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    training = docs.where(~F.col("held_out")).select("text")
    counts = stored(training.mapInArrow(counted, "word long, size int, n long").groupBy("word").agg(F.min("size").alias("size"), F.sum("n").alias("n")), "counts")
    texts = training.count()
    by_size = counts.groupBy("size").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    reach, least = thresholds(counts, HEAD, SYMBOLS)
    top = counts.where(F.col("n") >= reach).select("word", "size", "n").toPandas()
    head = Head(top["word"].to_numpy(np.int64), top["n"].to_numpy(np.int64), least)
    tokens, kinds = sum(r.n for r in by_size) + texts, sum(r.v for r in by_size) + (texts > 0)
    rare_n, rare_v = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for r in by_size:
        rare_n[r["size"]], rare_v[r["size"]] = r.n, r.v
    own = top[top["n"] >= least]
    np.subtract.at(rare_n, own["size"].to_numpy(int), own["n"].to_numpy(float))
    np.subtract.at(rare_v, own["size"].to_numpy(int), 1)
    seen = np.concatenate([head.n[head.symbol >= 0], rare_n[1:], [texts]]).astype(float)
    # One more count for each known word, and one for an unknown word of each class: with one state this is the base score's smoothing.
    prior = np.concatenate([np.ones(head.kinds), rare_v[1:] + 1, [1.0]])
    model, _ = train(training, head, seen, prior, states)
    base_whole = float(np.log10(tokens + 1 * (kinds + 1)))
    rare_whole = np.log10(rare_n + rare_v + 1)
    end_base = float(np.log10(texts + 1))

    def run(batches):
        for batch in batches:
            whole, ends, parts = sequences(batch.column("text"), head)
            likely = model.log_likelihood(whole, ends)
            for lo, hi, h, bounds in parts:
                at = head.find(h)
                text = np.repeat(np.arange(hi - lo), np.diff(bounds))
                gain = np.log10(np.where(at >= 0, head.n[at] if len(head.n) else 0, 0) + 1.0)
                size = np.diff(bounds)
                base = np.bincount(text, weights=gain, minlength=hi - lo) + end_base - (size + 1) * base_whole
                own = whole[ends[lo] : ends[hi]]
                words = np.delete(own, ends[lo + 1 : hi + 1] - ends[lo] - 1)
                rare = words >= head.kinds
                score = likely[lo:hi] / LN10
                score += np.bincount(text[rare], weights=gain[rare] - rare_whole[words[rare] - head.kinds + 1], minlength=hi - lo)
                known = np.bincount(text[at >= 0], minlength=hi - lo) + (texts > 0)
                mark = np.add.reduceat(np.append(mix(h.view(U) + mix(np.arange(len(h), dtype=U))), U(0)), np.minimum(bounds[:-1], len(h))) * (size > 0)
                tail_of, tail_n = [], []
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    own, n = np.unique(h[a:b][at[a:b] < 0], return_counts=True)
                    tail_of.append(own)
                    tail_n.append(n)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("held_out").slice(lo, hi - lo), pa.array(size + 1), pa.array(known), pa.array(base), pa.array(score), pa.array(mark.view(np.int64)), spread(tail_of, pa.int64()), spread(tail_n, pa.int64())], ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "mark", "rare", "times"])

    scored = stored(docs.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, mark long, rare array<long>, times array<long>"), "scored")
    key = ["doc_id", "mark", "n_tokens"]
    rare = scored.where("size(rare) > 0").dropDuplicates(key).select(*key, F.explode(F.arrays_zip("rare", "times")).alias("x")).select(*key, F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    rare = rare.join(counts.select("word", "n").hint("shuffle_hash"), "word").groupBy(*key).agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("gain"), F.sum("times").alias("seen"))
    rare = rare.withColumnsRenamed({k: f"{k}_" for k in key})
    on = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("mark") == F.col("mark_")) & (F.col("n_tokens") == F.col("n_tokens_"))
    out = scored.drop("rare", "times").join(rare, on, "left")
    gain = F.coalesce("gain", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"), (F.col("base") + gain).alias("base_score"), (F.col("score") + gain).alias("score"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return lm_scores(docs, fold(F.col("doc_id"), 7) == 2)
