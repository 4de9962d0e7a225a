"""Edit-aware token counts.

Each document keeps a segment tree over its pre-tokens: a leaf stands for LEAF pre-tokens and holds their characters
and tokens; inner nodes hold the sums. An edit (replace characters start to stop by a text) goes down the tree to the
leaves it touches. Whether a pre-token ends where it does hangs on at most CONTEXT characters after it, and on none
before its start; so encoding starts again at the last leaf border at least CONTEXT characters before the edit and
stops at the first pre-token end that falls on a leaf border after it. New leaves take the old ones' place: if they are
as many, only the sums on their paths change, else the sums are made anew from the leaves.

Trees are a table of their own, so that later edits find them; text, tree and edits of a document are joined by its
id and checksum. Edits of one document apply in the order of seq, each to the text its predecessor left. Texts and
trees are shuffled once; a task holds one document's at a time.

Cases: a null text is empty; edits beyond the text's end are cut off there, and null edits' texts are empty; edits
without a document are dropped; rows with one doc_id all get its edits; rows with null doc_id get none; repeated rows
are counted each; other columns of the inputs are ignored. The vocabulary's path is a parameter, read by the driver.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stored

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the vocabulary's pattern of pre-tokens.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF, CONTEXT, KEPT = 32, 3, 500_000


class Counter:
    """Counts the tokens of pre-tokens, and keeps the counts."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.pattern, self.kept = regex.compile(PATTERN), {}

    def count(self, pre: str) -> int:
        n = self.kept.get(pre)
        if n is None:
            if len(self.kept) > KEPT:
                self.kept.clear()
            n = self.kept[pre] = len(self.encoding.encode_ordinary(pre))
        return n

    def leaves(self, pres: list[str]) -> np.ndarray:
        """Rows (characters, tokens) of the leaves of some pre-tokens."""
        if not pres:
            return np.zeros((0, 2), np.int64)
        own = np.array([(len(p), self.count(p)) for p in pres], np.int64)
        return np.add.reduceat(own, np.arange(0, len(own), LEAF))


_counters: dict = {}


def counter(ranks: bytes) -> Counter:
    key = hashlib.sha256(ranks).digest()
    if key not in _counters:
        _counters[key] = Counter(ranks)
    return _counters[key]


class Tree:
    """A segment tree over leaves (characters, tokens); node 1 is the root, node k has the children 2k and 2k + 1."""

    def __init__(self, leaves: np.ndarray):
        self.n = len(leaves)
        self.size = 1 << max(0, self.n - 1).bit_length()
        self.nodes = np.zeros((2 * self.size, 2), np.int64)
        self.nodes[self.size : self.size + self.n] = leaves
        half = self.size // 2
        while half:
            self.nodes[half : 2 * half] = self.nodes[2 * half : 4 * half : 2] + self.nodes[2 * half + 1 : 4 * half : 2]
            half //= 2

    @property
    def leaves(self) -> np.ndarray:
        return self.nodes[self.size : self.size + self.n]

    def locate(self, at: int) -> tuple[int, int]:
        """The last leaf that begins at or before the character, and where it begins."""
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            if begin + self.nodes[node, 0] <= at and self.nodes[node + 1, 0] > 0:
                begin += int(self.nodes[node, 0])
                node += 1
        return node - self.size, begin

    def replace(self, lo: int, hi: int, new: np.ndarray) -> Tree:
        if len(new) != hi - lo:
            return Tree(np.concatenate([self.leaves[:lo], new, self.leaves[hi:]]))
        self.nodes[self.size + lo : self.size + hi] = new
        a, b = (self.size + lo) // 2, (self.size + hi - 1) // 2
        while a and len(new):
            for k in range(a, b + 1):
                self.nodes[k] = self.nodes[2 * k] + self.nodes[2 * k + 1]
            a, b = a // 2, b // 2
        return self


def edited(text: str, tree: Tree, start: int, stop: int, new: str, own: Counter) -> tuple[str, Tree, int]:
    """The text and tree after an edit, and how many pre-tokens were encoded again."""
    start = min(max(0, start), len(text))
    stop = min(max(start, stop), len(text))
    grown = len(new) - (stop - start)
    out = text[:start] + new + text[stop:]
    lo, begin = tree.locate(max(0, start - CONTEXT)) if tree.n else (0, 0)
    hi, end = lo, begin  # old leaves lo to hi are replaced; end is where hi begins in the old text
    pres, place = [], begin
    for m in own.pattern.finditer(out, begin):
        while hi < tree.n and (end < stop or end + grown < place):
            end += int(tree.leaves[hi, 0])
            hi += 1
        if end >= stop and end + grown == place and place >= start + len(new):
            break
        pres.append(m[0])
        place = m.end()
    else:
        hi = tree.n
    return out, tree.replace(lo, hi, own.leaves(pres)), len(pres)


def build_trees(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Rows (doc_id, mark, n_tokens, leaves): each text's checksum, tokens and leaves as pairs of 32-bit numbers."""
    with open(ranks, "rb") as f:
        table = f.read()

    def run(batches):
        own = counter(table)
        for batch in batches:
            ids, marks, sums, leaves = batch.column(0), batch.column(1), [], []
            for text in batch.column(2).to_pylist():
                part = own.leaves(own.pattern.findall(text or ""))
                sums.append(int(part[:, 1].sum()))
                leaves.append(part.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([ids, marks, pa.array(sums, pa.int64()), pa.array(leaves, pa.binary())], ["doc_id", "mark", "n_tokens", "leaves"])

    return marked(docs).mapInArrow(run, "doc_id long, mark long, n_tokens long, leaves binary")


def marked(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def apply_edits(docs: DataFrame, trees: DataFrame, edits: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Rows (doc_id, n_tokens, text, mark, n_tokens_after, n_pretokens_encoded, leaves) after edits (doc_id, seq, start, stop, new)."""
    with open(ranks, "rb") as f:
        table = f.read()
    lists = edits.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("seq", "start", "stop", F.coalesce("new", F.lit("")).alias("new")))).alias("edits"))
    own_trees = trees.dropDuplicates(["doc_id", "mark"]).select(F.col("doc_id").alias("tree_id"), F.col("mark").alias("tree_mark"), "n_tokens", "leaves")
    # The edits get the trees' checksums, so that texts, trees and edits meet on the same keys after one shuffle each.
    keyed = trees.select("doc_id", "mark").distinct().join(lists, "doc_id").select(F.col("doc_id").alias("list_id"), F.col("mark").alias("list_mark"), "edits")
    rows = marked(docs).join(own_trees.hint("shuffle_hash"), F.expr("doc_id <=> tree_id and mark = tree_mark"))
    rows = rows.join(keyed.hint("shuffle_hash"), F.expr("doc_id <=> list_id and mark = list_mark"), "left")

    def run(batches):
        own = counter(table)
        for batch in batches:
            out = []
            for doc, text, n, leaves, changes in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "n_tokens", "leaves", "edits")), strict=True):
                tree, again = Tree(np.frombuffer(leaves, "<i4").astype(np.int64).reshape(-1, 2)), 0
                for e in changes or []:
                    text, tree, k = edited(text, tree, e["start"], e["stop"], e["new"], own)
                    again += k
                out.append((doc, n, text, int(tree.nodes[1, 1]), again, tree.leaves.astype("<i4").tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()], strict=True)], ["doc_id", "n_tokens", "text", "n_tokens_after", "n_pretokens_encoded", "leaves"])

    rows = rows.select("doc_id", "text", "n_tokens", "leaves", "edits")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, text string, n_tokens_after long, n_pretokens_encoded long, leaves binary")


def sample_edits(docs: DataFrame) -> DataFrame:
    """Three edits of each document: a replacement at a quarter, an insertion at the middle, a deletion at three quarters."""
    n = F.length(F.coalesce("text", F.lit(""))).cast("int")
    each = [(0, n / 4, n / 4 + 10, "[edited]"), (1, n / 2, n / 2, " (revised) "), (2, 3 * n / 4, 3 * n / 4 + 5, "")]
    edits = F.array(*[F.struct(F.lit(k).alias("seq"), F.floor(a).cast("int").alias("start"), F.floor(b).cast("int").alias("stop"), F.lit(t).alias("new")) for k, a, b, t in each])
    return docs.select("doc_id", F.explode(edits).alias("e")).select("doc_id", "e.*").dropDuplicates(["doc_id", "seq"])


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    trees = stored(build_trees(docs), "trees")
    out = apply_edits(docs, trees, sample_edits(docs))
    return out.select("doc_id", "n_tokens", "n_tokens_after", F.length("text").cast("long").alias("n_chars_after"), "n_pretokens_encoded")
