"""SimHash near-duplicates by covering locality-sensitive hashing.

1. A text's words, A-Z lower-cased, give k-word shingles, repeats included; a text with fewer words has its whole sequence as
   one. Each bit of the fingerprint is 1 if it is set in over half of the shingles' XXH64 values (seed 42).
2. Documents with one fingerprint are one node. Each of the 64 bits gets a vector of radius + 1 bits, every vector but zero
   about as often. For each vector v but zero, the mask of table v keeps the bits whose vector has an odd product with v. The
   vectors of at most `radius` differing bits leave some v with even products only, so the pair agrees on that table's whole
   mask: no link is missed. A mask keeps about half of the bits, so other pairs seldom meet.
3. Nodes that agree on a mask form a bucket. Buckets of up to TILE nodes are dealt by key and walked in sorted order; larger
   ones are cut by salt, and each pair of salts is a tile of at most about 2 * TILE nodes, so none is held by one task. A
   bucket or tile is searched breadth-first: each node is compared with those not yet reached, by bit counts of XOR. Its
   rows are a spanning forest of its links, one less than its nodes at most, and near copies are soon all reached.
4. The forests' connected components are those of all links.

Cases: a null or empty text, or one without words, has fingerprint zero and links like any other; rows with one doc_id are
nodes of their own texts with one id, so they join the components of both; a row with null doc_id takes its component from
rows with its fingerprint and else has none; very long texts are read in whole, about a million bytes of short texts at a
time; ties can't occur, half of the shingles isn't over half; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, documents, stored
from .textbytes import U, chunks, joined_words

BITS = 64
#: Most nodes of a bucket that one task compares whole, and about the nodes of one salt of a larger one.
TILE = 32_768


def fingerprints(k: int, seed: int):
    """For mapInArrow over (doc_id, text): the number of shingles and the fingerprint, as a signed 64-bit number."""

    def run(batches):
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for lo, hi, data, ends in chunks(batch.column("text"), 1_000_000):
                buffer, start, end, bounds = joined_words(data, ends)
                size = np.diff(bounds)
                text, at = np.repeat(np.arange(hi - lo), size), np.arange(len(start))
                last = bounds[1:][text]
                opens = (at + k <= last) | (size[text] < k) & (at == bounds[:-1][text])
                close = end[np.minimum(at + k, last) - 1]
                hashes = np.array([digest(buffer[a:b], seed) for a, b in zip(start[opens].tolist(), close[opens].tolist(), strict=True)], U)
                n = np.bincount(text[opens], minlength=hi - lo)
                found, prints = np.flatnonzero(n), np.zeros(hi - lo, U)
                if len(found):
                    places = np.append(0, np.cumsum(n[found]))[:-1]
                    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    over = 2 * np.add.reduceat(bits, places, axis=0, dtype=np.int64) > n[found][:, None]
                    prints[found] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(prints.view(np.int64))], ["doc_id", "n_shingles", "print"])

    return run


def masks(radius: int) -> list[int]:
    """The masks of the covering tables, one for each vector of radius + 1 bits but zero, as signed 64-bit numbers."""
    vectors = (1 << radius + 1) - 1
    of_bit = [1 + i % vectors for i in range(BITS)]
    kept = [sum(1 << i for i, p in enumerate(of_bit) if (p & v).bit_count() & 1) for v in range(1, vectors + 1)]
    return [m - (1 << BITS) if m >> BITS - 1 else m for m in kept]


def forest(prints: np.ndarray, ids: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs of ids that span the links of the given fingerprints."""
    links, rest, names = [], prints, ids
    while len(rest) > 1:
        reached = [(rest[0], names[0])]
        rest, names = rest[1:], names[1:]
        while reached and len(rest):
            own, name = reached.pop()
            near = np.bitwise_count(rest ^ own) <= radius
            if near.any():
                reached += list(zip(rest[near], names[near], strict=True))
                links += [(int(name), other) for other in names[near].tolist()]
                rest, names = rest[~near], names[~near]
    return links


def _pairs(links: list[tuple[int, int]]) -> dict:
    return {"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())}


def bucket_links(radius: int):
    """For mapInArrow over (table, kept, node, print), sorted by table and kept: the links of each bucket. A bucket may go on in the next batch."""

    def run(batches):
        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("table", "kept", "node", "print")]
            if held:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            table, kept, node, prints = now
            if not len(table):
                continue
            starts = np.flatnonzero(np.append(True, (table[1:] != table[:-1]) | (kept[1:] != kept[:-1]))).tolist()
            links = []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                links += forest(prints[a:b].view(U), node[a:b], radius)
            held = [x[starts[-1] :] for x in now]
            yield pa.RecordBatch.from_pydict(_pairs(links))
        if held:
            yield pa.RecordBatch.from_pydict(_pairs(forest(held[3].view(U), held[2], radius)))

    return run


def tile_links(radius: int):
    """For applyInArrow over a tile of a large bucket."""

    def run(tile: pa.Table) -> pa.Table:
        return pa.table(_pairs(forest(tile.column("print").to_numpy().view(U), tile.column("node").to_numpy(), radius)))

    return run


def near_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between nodes (node, print) of different fingerprints; their components are those of all pairs within the radius."""
    tables = [F.struct(F.lit(t).alias("table"), F.col("print").bitwiseAND(F.lit(m).cast("long")).alias("kept")) for t, m in enumerate(masks(radius))]
    keyed = nodes.select("node", "print", F.explode(F.array(*tables)).alias("key")).select("key.*", "node", "print")
    sizes = keyed.groupBy("table", "kept").agg(F.count("*").alias("n")).where("n > 1")
    # Spark takes both sides for no larger than the nodes' file, of which each row is here once for each table; so no side is broadcast.
    met = stored(keyed.join(sizes.hint("merge"), ["table", "kept"]), "met")
    small = met.where(F.col("n") <= TILE).select("table", "kept", "node", "print").repartition("table", "kept").sortWithinPartitions("table", "kept")
    salts = F.ceil(F.col("n") / TILE).cast("int")
    large = met.where(F.col("n") > TILE).withColumn("salt", F.pmod(F.xxhash64("print"), salts).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), salts - 1)))
    large = large.select("table", "kept", F.least("salt", "other").alias("s1"), F.greatest("salt", "other").alias("s2"), "node", "print")
    tiles = large.groupBy("table", "kept", "s1", "s2").applyInArrow(tile_links(radius), "a long, b long")
    return stored(small.mapInArrow(bucket_links(radius), "a long, b long").union(tiles).distinct(), "links")


def simhash(docs: DataFrame, k: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """Rows (doc_id, n_shingles, print, component_id): component_id is the smallest doc_id reachable by links of fingerprints
    that differ in at most `radius` bits. See the module for the method and for the cases."""
    prints = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(fingerprints(k, seed), "doc_id long, n_shingles long, print long"), "prints")
    named = prints.where("doc_id is not null")
    nodes = stored(named.groupBy("print").agg(F.min("doc_id").alias("node")), "nodes")
    # A doc_id with several fingerprints is one document: its fingerprints' nodes are linked.
    several = named.groupBy("doc_id").agg(F.min("print").alias("x"), F.max("print").alias("y")).where("x <> y").select("doc_id")
    twice = named.join(several, "doc_id", "left_semi").join(nodes, "print").where("doc_id <> node").select("doc_id", "node")
    joined = components(near_links(nodes, radius).union(twice))
    classes = nodes.join(joined.withColumnsRenamed({"node": "n_", "component": "c_"}), F.col("node") == F.col("n_"), "left").select("print", F.coalesce("c_", "node").alias("component_id"))
    return prints.join(classes, "print", "left").select("doc_id", "n_shingles", "print", F.coalesce("component_id", "doc_id").alias("component_id"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(documents(spark, sf_dir)).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", "n_shingles")
