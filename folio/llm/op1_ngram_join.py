"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact intersection of sorted arrays.

Two texts link when the Jaccard similarity of their sets of k-word shingles is at least num / den.

1. A text's shingles become 64-bit hashes, sorted. Sizes fall into bands [e, e * den // num]; a linked pair lies in
   one band or in two neighbouring ones, so tile b holds the bands b and b + 1.
   The text's parity bitmap has a bit for each cell of the hash range that holds an odd number of its shingles.
2. A linked pair of tile b differs in at most d_b shingles. The hash range is cut into d_b + 1 + spare parts, so at
   least one non-empty part is the same in both. The parts' hashes are the tile's keys; only texts that share a key
   can link. A text with more than `spare` empty parts also gives keys for those, so no pair is lost.
3. Keys are sorted by range over (key, id), so a key of very many texts lies in several partitions and none is held in
   memory; texts of one tile that share a key form stars around the smallest id, and connected stars are the tile's blocks.
4. Blocks are searched by bitmaps alone, about a byte for each shingle. The bits of two XORed bitmaps are at most the
   shingles in which the texts differ, so they bound the overlap from above. A block is walked breadth-first over the pairs that pass, each
   text against those not yet reached and of fitting size; large blocks are cut by salt into tiles of bounded size first. What it
   reaches spans all pairs that can link, and connected, it is a group: chains of chance keys end here, before an array is made.
5. Arrays are made of the groups' texts only: a bounded bitmap of their ids filters the scan. A large group is cut by size band
   and salt, and pairs of tiles are compared: pairs that pass the bitmap bound are decided by the exact intersection of
   their sorted arrays. Without `count`, a pair whose ends the tile has already joined is skipped, so links grow with the
   texts and not with their square; components stay those of all links. With `count` every pair is decided and the tile gives
   each text's number of links, still with a spanning forest, so work but not rows grows with the square of a group's size. A
   pair of texts is in one tile only, so sums are exact.

Texts with equal sets are collapsed to their smallest doc_id before step 2. Shingles are compared by 64-bit hashes.

Cases: null or wordless texts have no shingles and link with nothing; a text with fewer than k words has its whole
sequence as one shingle; rows with one doc_id are one node; a row with null doc_id takes its component from equal
texts and else has none; other columns of the input are ignored.
"""

from __future__ import annotations

from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, documents, drop_stored, sized, stored
from .marks import bitmap_of, hashed, marked
from .textbytes import U, chunks, mix, spread, word_table

#: Most shingles and texts of one side of a tile.
TILE_SHINGLES, TILE_TEXTS = 4_000_000, 4_096
#: Most texts and bytes of bitmaps of a block that one task compares whole, and about those of one salt of a larger one.
BLOCK_TEXTS, BLOCK_BYTES = 8_192, 32_000_000
#: Most copies whose ids are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def shingle_sets(texts: pa.Array, k: int):
    """The sorted distinct shingle hashes of each text."""
    for _, _, data, ends in chunks(texts, 1_000_000):
        hashes, _, bounds = word_table(data, ends)
        if len(hashes) >= k:
            rolled = np.zeros(len(hashes) - k + 1, U)
            for j in range(k):
                rolled = rolled * U(0xC2B2AE3D27D4EB4F) + hashes[j : j + len(rolled)]
            rolled = mix(rolled)
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            if hi - lo >= k:
                own = np.sort(rolled[lo : hi - k + 1])
                yield own[np.append(True, own[1:] != own[:-1])]
            elif hi > lo:
                whole = U(hi - lo)
                for h in hashes[lo:hi]:
                    whole = mix(np.array([whole], U) * U(0xC2B2AE3D27D4EB4F) + h)[0]
                yield np.array([whole], U)
            else:
                yield np.zeros(0, U)


class Bands:
    """Size bands and the number of parts of each tile, for the threshold num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edges = [1]
        self.parts: dict[int, tuple[int, int]] = {}

    def band(self, n: int) -> int:
        while self.edges[-1] <= n:
            self.edges.append(self.edges[-1] * self.den // self.num + 1)
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def cut(self, tile: int) -> tuple[int, int]:
        """Parts of a tile, and how many of them may be empty without a key."""
        if tile not in self.parts:
            self.band(self.edges[min(tile, len(self.edges) - 1)])
            low = self.edges[tile]
            high = low * self.den // self.num
            differ = high * (self.den - self.num) // self.num
            spare = 0 if differ == 0 else ceil(2.5 * differ * exp(-low / (differ + 1))) + 2
            self.parts[tile] = differ + 1 + spare, spare
        return self.parts[tile]

    def keys(self, own: np.ndarray) -> list[np.ndarray]:
        """The keys of a set of sorted hashes: those of its own band's tile, and of the tile below if it can link there."""
        n, out = len(own), []
        band = self.band(n) if n else -1
        for tile in (band, band - 1):
            if tile < 0 or tile < band and n > (self.edges[band] - 1) * self.den // self.num:
                out.append(np.zeros(0, U))
                continue
            k, spare = self.cut(tile)
            part = ((own >> U(32)) * U(k)) >> U(32)
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            there = part[at]
            sums = np.add.reduceat(mix(own ^ U(0xA0761D6478BD642F)), at)
            if k - len(at) > spare:
                empty = np.setdiff1d(np.arange(k, dtype=U), there)
                there, sums = np.append(there, empty), np.append(sums, np.zeros(len(empty), U))
            out.append(mix(sums + mix(there * U(0xE7037ED1A0B428DB) + U((tile + 1) * 0x8EBC6AF09C88C6E3 & 0xFFFFFFFFFFFFFFFF))))
        return out


def parity(own: np.ndarray) -> bytes:
    """The parity bitmap of a set, of about four to eight bits for each hash."""
    bits = 1 << min(16, max(8, (4 * len(own)).bit_length()))
    return np.packbits(np.bincount((own & U(bits - 1)).astype(np.int64), minlength=bits) & 1 == 1, bitorder="little").tobytes()


def folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps of several sizes at the size of the smallest, one in a row: halves are XORed, which keeps parities."""
    width = min(len(x) for x in maps)
    out = np.empty((len(maps), width // 8), U)
    for i, x in enumerate(maps):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(x, U).reshape(-1, width // 8), axis=0)
    return out


def text_sets(k: int, num: int, den: int):
    """For mapInArrow over (doc_id, text): the set's size, band, 128-bit hash and bitmap, and its keys in two tiles."""

    def run(batches):
        bands = Bands(num, den)
        for batch in batches:
            sizes, band, one, two, maps, keys = [], [], [], [], [], []
            for own in shingle_sets(batch.column("text"), k):
                sizes.append(len(own))
                band.append(bands.band(len(own)) if len(own) else -1)
                maps.append(parity(own))
                one.append(np.add.reduce(mix(own), dtype=U))
                two.append(np.add.reduce(mix(own ^ U(0x589965CC75374CC3)), dtype=U))
                keys.append(bands.keys(own))
            if sizes:
                own, below = (spread(list(x), pa.int64()) for x in zip(*keys, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(band, pa.int32()), pa.array(np.array(one, U).view(np.int64)), pa.array(np.array(two, U).view(np.int64)), pa.array(maps, pa.binary()), own, below], ["doc_id", "n_shingles", "band", "s1", "s2", "map", "own", "below"])

    return run


def stars_of(batches):
    """For mapInArrow over a partition's (key, doc_id), sorted: (a, b, null) for the first id a of a key and each other id b,
    and (null, b, key) for the first id of the partition's first and last key, which may go on in other partitions."""
    last, first, opened = None, None, False
    for batch in batches:
        key, doc = batch.column("key").to_numpy(), batch.column("doc_id").to_numpy()
        if not len(key):
            continue
        starts = np.flatnonzero(np.append(last is None or key[0] != last, key[1:] != key[:-1]))
        own = np.repeat(doc[starts], np.diff(np.append(starts, len(key))))
        if len(starts) == 0 or starts[0]:
            own = np.append(np.full(starts[0] if len(starts) else len(key), first, np.int64), own)
        last, first = key[-1], own[-1]
        apart = own != doc
        edge = [] if opened else [(key[0], own[0])]
        opened = True
        yield pa.RecordBatch.from_arrays([pa.array(own[apart].tolist() + [None] * len(edge), pa.int64()), pa.array(doc[apart].tolist() + [x[1] for x in edge], pa.int64()), pa.array([None] * int(apart.sum()) + [x[0] for x in edge], pa.int64())], ["a", "b", "edge"])
    if opened:
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([first], pa.int64()), pa.array([last], pa.int64())], ["a", "b", "edge"])


def stars(keyed: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all ids of each key, from rows (key, doc_id). At most two rows of each partition meet again by key."""
    found = stored(keyed.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id").mapInArrow(stars_of, "a long, b long, edge long").distinct(), "stars")
    edges = found.where("edge is not null")
    across = edges.join(edges.groupBy("edge").agg(F.min("b").alias("least")), "edge").select(F.col("least").alias("a"), "b").where("a <> b")
    return found.where("edge is null").select("a", "b").union(across)


def reachable(n: np.ndarray, maps: np.ndarray, ids: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of ids that span all pairs whose overlap, bounded by the bitmaps, reaches the threshold. n ascends."""
    links, rest = [], np.arange(len(n))
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            i = reached.pop()
            size = n[rest]
            lo, hi = np.searchsorted(size * den, n[i] * num), np.searchsorted(size * num, n[i] * den, side="right")
            window = rest[lo:hi]
            apart = np.bitwise_count(maps[window] ^ maps[i]).sum(axis=1, dtype=np.int64)
            over = (n[i] + n[window] - apart) // 2
            may = over * den >= (n[i] + n[window] - over) * num
            if may.any():
                near = window[may]
                reached += near.tolist()
                links += [(int(ids[i]), other) for other in ids[near].tolist()]
                rest = np.concatenate([rest[:lo], window[~may], rest[hi:]])
    return links


def _block_pairs(rows: pa.Table, num: int, den: int) -> dict:
    rows = rows.sort_by([("n", "ascending"), ("doc_id", "ascending")])
    pairs = reachable(rows.column("n").to_numpy(), folded(rows.column("map").to_pylist()), rows.column("doc_id").to_numpy(), num, den)
    return {"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())}


def only_marked(column: str, bitmap):
    """For mapInArrow: the rows whose hash in the column is marked, so that few others meet the shuffle of a join."""

    def run(batches):
        there = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(marked(there, batch.column(column).to_numpy().view(U))))

    return run


def block_pairs(num: int, den: int):
    """For mapInArrow over (block, doc_id, n, map), sorted by block: pairs that span the possible links of each block. A block may go on in the next batch."""

    def run(batches):
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([held, now]).combine_chunks() if held is not None else now
            if not len(now):
                continue
            block = now.column("block").to_numpy()
            starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist()
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                yield pa.RecordBatch.from_pydict(_block_pairs(now.slice(a, b - a), num, den))
            held = now.slice(starts[-1])
        if held is not None and len(held):
            yield pa.RecordBatch.from_pydict(_block_pairs(held, num, den))

    return run


def salted_pairs(num: int, den: int):
    """For applyInArrow over a tile of a large block."""
    return lambda tile: pa.table(_block_pairs(tile, num, den))


def possible_links(blocks: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) that span all pairs of the rows (block, doc_id, n, map) of a block that can link by size and bitmap."""
    sizes = blocks.groupBy("block").agg(F.count("*").alias("texts"), F.sum(F.length("map")).alias("bytes"))
    salts = F.ceil(F.greatest(F.col("texts") / BLOCK_TEXTS, F.col("bytes") / BLOCK_BYTES)).cast("int")
    # Stored, since a sort above a merge join on the same key is left out, and adaptive execution may still make that join another.
    rows = stored(blocks.join(sizes, "block").withColumn("salts", salts).drop("texts", "bytes"), "salted")
    small = rows.where("salts = 1").select("block", "doc_id", "n", "map").repartition("block").sortWithinPartitions("block")
    large = rows.where("salts > 1").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    large = large.select("block", F.least("salt", "other").alias("t1"), F.greatest("salt", "other").alias("t2"), "doc_id", "n", "map")
    tiles = large.groupBy("block", "t1", "t2").applyInArrow(salted_pairs(num, den), "a long, b long")
    return small.mapInArrow(block_pairs(num, den), "a long, b long").union(tiles).distinct()


def hash_arrays(k: int, num: int, den: int, members):
    """For mapInArrow over (doc_id, text): the sorted hashes of each text whose doc_id is marked, with its band."""

    def run(batches):
        bands, there = Bands(num, den), np.frombuffer(members.value, np.uint8)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(marked(there, hashed(ids.view(U)))))
            sets = list(shingle_sets(batch.column("text"), k))
            band = [bands.band(len(s)) if len(s) else -1 for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(band, pa.int32()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "band", "n", "hashes"])

    return run


def tile_links(num: int, den: int, count: bool = False):
    """For applyInArrow over a tile (doc_id, side, n, hashes): links that join all its texts that links join.

    Rows (a, b, n), n null; with count also (a, null, n) for each text with n links in the tile.
    """

    def run(tile: pa.Table) -> pa.Table:
        tile = tile.sort_by([("n", "ascending"), ("doc_id", "ascending")])
        ids, sides = tile.column("doc_id").to_numpy(), tile.column("side").to_numpy()
        sets = [np.frombuffer(x.as_py(), U) for x in tile.column("hashes")]
        n = np.array([len(s) for s in sets])
        bits = 1 << int(np.clip(np.ceil(np.log2(max(1, n.max()) * 2)), 8, 14))
        maps = np.stack([np.packbits((np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(U) for s in sets])
        crossing = bool((sides != sides[0]).any())
        root = list(range(len(sets)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        links, degree = [], np.zeros(len(sets), np.int64)
        if count:
            places, inverse = np.unique(np.concatenate(sets), return_inverse=True)
            starts, held, label = np.append(0, np.cumsum(n)), np.zeros(len(places), bool), np.arange(len(sets))
        lows = np.searchsorted(n * den, n * num)  # the first whose size is not too small
        for i in range(1, len(sets)):
            lo = lows[i]
            if lo >= i or n[i] == 0:
                continue
            apart = np.bitwise_count(maps[lo:i] ^ maps[i]).sum(axis=1, dtype=np.int64)
            over = (n[i] + n[lo:i] - apart) // 2
            may = over * den >= (n[i] + n[lo:i] - over) * num
            if crossing:
                may &= sides[lo:i] != sides[i]
            there = np.flatnonzero(may)
            if count and len(there):
                first, last = lo + there[0], lo + there[-1] + 1
                held[inverse[starts[i] : starts[i + 1]]] = True
                both = np.add.reduceat(held[inverse[starts[first] : starts[last]]], starts[first:last] - starts[first], dtype=np.int64)[there - there[0]]
                held[inverse[starts[i] : starts[i + 1]]] = False
                there += lo
                to = there[(both * den >= (n[i] + n[there] - both) * num) & (ids[there] != ids[i])]
                degree[i] += len(to)
                degree[to] += 1
                others, at = np.unique(label[to], return_index=True)
                for other, j in zip(others.tolist(), to[at].tolist(), strict=True):
                    if other != label[i]:
                        label[label == other] = label[i]
                        links.append((ids[i], ids[j]))
                continue
            for j in (there[np.argsort(apart[there], kind="stable")] + lo).tolist():
                if find(i) == find(j):
                    continue
                at = np.searchsorted(sets[i], sets[j])
                at[at == len(sets[i])] = 0
                both = int((sets[i][at] == sets[j]).sum())
                if both * den >= (int(n[i]) + int(n[j]) - both) * num:
                    root[find(i)] = find(j)
                    links.append((ids[i], ids[j]))
        of = np.flatnonzero(degree)
        none = [None]
        return pa.table({"a": pa.array([x[0] for x in links] + ids[of].tolist(), pa.int64()), "b": pa.array([x[1] for x in links] + none * len(of), pa.int64()), "n": pa.array(none * len(links) + degree[of].tolist(), pa.int64())})

    return run


def ngram_join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, count: bool = False) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, n_copies): the component of each document under the links of its texts.

    component_id is the smallest doc_id reachable; n_copies counts the rows with the same set. With count there is also
    n_links, the number of other sets that the document's set links with. See the module for the method and for the cases.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keys = stored(docs.mapInArrow(text_sets(k, num, den), "doc_id long, n_shingles long, band int, s1 long, s2 long, map binary, own array<long>, below array<long>"), "keys")
    sets = stored(keys.select("doc_id", "n_shingles", "s1", "s2"), "sets")
    copies = stored(sets.where("n_shingles > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"), F.max("n_shingles").alias("n")), "copies")
    others = stored(sets.join(copies.where("n_copies > 1").select("s1", "s2", "rep"), ["s1", "s2"]).where("doc_id <> rep").select("doc_id", "s1", "s2").distinct(), "others")
    reps = keys.where("n_shingles > 0 and doc_id is not null").join(sized(others, BROADCAST_ROWS), ["doc_id", "s1", "s2"], "left_anti")
    # A text is a node of its own band's tile and of the one below; stars and blocks never cross tiles.
    tiles = F.explode(F.array(F.struct(F.col("band").alias("tile"), F.col("own").alias("keys")), F.struct((F.col("band") - 1).alias("tile"), F.col("below").alias("keys")))).alias("t")
    node = F.xxhash64("doc_id", "t.tile")
    keyed = reps.select("doc_id", tiles).select(node.alias("doc_id"), F.explode("t.keys").alias("key"))
    blocks = stored(components(stars(keyed)).withColumnsRenamed({"component": "block"}), "blocks")
    nodes = reps.select("doc_id", F.col("n_shingles").alias("n"), "map", tiles).select(node.alias("node"), "doc_id", "n", "map")
    nodes = nodes.mapInArrow(only_marked("node", bitmap_of(blocks, "node")), nodes.schema)
    groups = components(possible_links(stored(nodes.join(blocks, "node").drop("node"), "maps"), num, den))
    groups = stored(groups.withColumnsRenamed({"node": "doc_id", "component": "block"}), "groups")
    drop_stored(keys)

    members = bitmap_of(groups.select(F.xxhash64("doc_id").alias("mark")), "mark")
    named = docs.where("doc_id is not null").mapInArrow(hash_arrays(k, num, den, members), "doc_id long, band int, n long, hashes binary")
    arrays = stored(named.where("n > 0").join(groups, "doc_id").dropDuplicates(["doc_id", "hashes"]), "arrays")
    links = stored(tile_pairs(arrays).groupBy("block", "t1", "t2").applyInArrow(tile_links(num, den, count), "a long, b long, n long"), "links")
    drop_stored(arrays)
    joined = stored(components(links.where("b is not null").select("a", "b")), "joined")
    out = sets.select("doc_id", "n_shingles", "s1", "s2").join(copies.select("s1", "s2", "rep", "n_copies"), ["s1", "s2"], "left")
    out = out.join(joined.withColumnsRenamed({"node": "rep"}), "rep", "left")
    columns = ["doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies")]
    if count:
        degrees = links.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n_links"))
        out = out.join(degrees, "rep", "left")
        columns.append(F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return out.select(*columns)


def tile_pairs(arrays: DataFrame) -> DataFrame:
    """Deals the texts of each block to tiles: one for a block of bounded size, else one for each pair of salted bands."""
    sized = arrays.groupBy("block", "band").agg(F.sum("n").alias("shingles"), F.count("*").alias("texts"))
    sized = sized.withColumn("salts", F.ceil(F.greatest(F.col("shingles") / TILE_SHINGLES, F.col("texts") / TILE_TEXTS)).cast("int"))
    whole = sized.groupBy("block").agg((F.greatest(F.sum("shingles") / TILE_SHINGLES, F.sum("texts") / TILE_TEXTS) > 1).alias("large"))
    near = sized.select("block", "band", "salts")
    sized = near.alias("x").join(near.select("block", (F.col("band") - 1).alias("band"), F.col("salts").alias("above")), ["block", "band"], "left")
    sized = sized.join(near.select("block", (F.col("band") + 1).alias("band"), F.col("salts").alias("below")), ["block", "band"], "left").join(whole, "block")
    dealt = arrays.join(sized, ["block", "band"])
    salt = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("salts")).cast("int")
    own = F.concat_ws(":", "band", salt)
    named = lambda shift: lambda i: F.concat_ws(":", F.col("band") + shift, i)
    upto = lambda c: F.when(F.coalesce(c, F.lit(0)) > 0, F.sequence(F.lit(0), c - 1)).otherwise(F.array().cast("array<int>"))
    same = F.transform(upto(F.col("salts")), lambda i: F.struct(F.concat_ws(":", "band", F.least(i, salt)).alias("t1"), F.concat_ws(":", "band", F.greatest(i, salt)).alias("t2"), F.when(i < salt, 1).otherwise(0).alias("side")))
    up = F.transform(upto(F.col("above")), lambda i: F.struct(own.alias("t1"), named(1)(i).alias("t2"), F.lit(0).alias("side")))
    down = F.transform(upto(F.col("below")), lambda i: F.struct(named(-1)(i).alias("t1"), own.alias("t2"), F.lit(1).alias("side")))
    one = F.array(F.struct(F.lit("").alias("t1"), F.lit("").alias("t2"), F.lit(0).alias("side")))
    tiles = F.when(F.col("large"), F.concat(same, up, down)).otherwise(one)
    return dealt.withColumn("tile", F.explode(tiles)).select("block", "tile.t1", "tile.t2", "tile.side", "doc_id", "n", "hashes")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir), k=3, num=90, den=100, count=True)
