"""Suffix dedup: removes every byte covered by a `width`-byte string that also starts earlier in the corpus.

The method here is content-sampled window fingerprints, not the external induced sorting asked for, whose disk-backed
queues carry a tuple for every suffix. By calculation, not measurement, a tuple for each of the corpus's bytes takes over
ten times the input on disk. So hashes of sampled windows are sorted; there is no suffix order (README):

1. Sampled suffixes are chosen by content, as the recursion of induced sorting does with its local minima: each window
   of `width` bytes selects the leftmost smallest of the hashes of the GRAM-byte strings in it, so equal windows select
   the same place. The window starts that select one place are its domain, at most width - GRAM + 1 of them.
2. The sampled suffixes, as tuples (gram, span, doc_id, place), are sorted externally: Spark's range partitioning and
   spilling sort are the disk-backed queues. span is a hash of the whole domain's bytes, its common prefix. Range
   partitioning cuts through a frequent gram, so no task gets a group whole. One pass over neighbours follows: a
   domain equal to an earlier one of its task induces that all its windows are repeats; a first of its kind is a
   candidate if its gram has other rows, or stands at an edge of the task's range.
3. Candidates of one gram share less than their domains. Their windows are compared themselves, and each window but
   the earliest of its kind is a repeat: grams with at most GROUP candidates in blocks of bounded size, the others as
   rows of a shuffle, pre-aggregated.

Strings are compared by 128 bits of hashes.

Cases: null is the empty text; matches never cross rows; "earlier" is by (doc_id, start), so repeated rows with one
doc_id aren't earlier than one another at the same start; rows with null doc_id are left whole and count for nothing;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stored
from .textbytes import BASE, BYTE, U, chunks, mix

GRAM, STEP = 28, 400_000
#: Texts of a batch that a task holds copies of at a time.
ROWS = 256
#: Most candidates of a gram that are compared in a block, and candidates of a block on average.
GROUP, BLOCK = 4_096, 20_000
LOW20 = (1 << 20) - 1


def doubled(h: np.ndarray, power: int, size: int) -> tuple[np.ndarray, int]:
    """Hashes of strings of 2 * size bytes from those of size bytes; power is the base to the size."""
    return h[: len(h) - size] * U(power) + h[size:], power * power & 0xFFFFFFFFFFFFFFFF


def string_hashes(data: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """For each size, the hash of the string of so many bytes from each place."""
    table, h, power, size = {}, BYTE[data], int(BASE | U(1)), 1
    while size <= max(sizes):
        table[size] = h
        if len(h) <= size:
            break
        h, power = doubled(h, power, size)
        size *= 2
    out = []
    for n in sizes:
        part = max((s for s in table if s <= n), default=1)
        ends = len(data) - n + 1
        h = table[part]
        out.append(np.zeros(0, U) if ends <= 0 else h[:ends] if part == n else mix(h[:ends] + mix(h[n - part : n - part + ends])))
    return out


def pieces(texts: pa.Array, width: int):
    """Slices of the texts' bytes: (row of each window start or -1 where it would cross rows, its offset in the row, bytes)."""
    for lo, hi, data, ends in chunks(texts, STEP):
        starts = len(data) - width + 1
        for at in range(0, max(0, starts), STEP):
            upto = min(starts, at + STEP)
            p = np.arange(at, upto)
            row = np.searchsorted(ends, p, side="right") - 1
            yield lo + row, p - ends[row], p + width <= ends[row + 1], data[at : upto + width - 1]


def parts(batches):
    """The batches, cut into pieces of ROWS rows."""
    for batch in batches:
        for lo in range(0, len(batch), ROWS):
            yield batch.slice(lo, ROWS)


def domains(width: int):
    """For mapInArrow over (doc_id, text): the domains as (gram, span, doc_id, place), place = start << 28 | length << 20 | part of the text's checksum."""
    reach = width - GRAM + 1

    def run(batches):
        for batch in parts(batches):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            texts = batch.column("text").cast(pa.large_string())
            marks = np.array([zlib.crc32(x.as_buffer() or b"") & LOW20 if x.is_valid else 0 for x in texts], dtype=np.int64)
            for row, offset, valid, data in pieces(texts, width):
                if not valid.any():
                    continue
                grams, long = string_hashes(data, [GRAM, 64])
                low = ((grams ^ (grams >> U(33))) * U(0xC2B2AE3D27D4EB4F)) & U(~LOW20 & 0xFFFFFFFFFFFFFFFF) | np.arange(len(grams), dtype=U)
                size = 1
                while size * 2 <= reach:
                    low, size = np.minimum(low[:-size], low[size:]), size * 2
                if size < reach:
                    low = np.minimum(low[: len(low) - (reach - size)], low[reach - size :])
                p = np.flatnonzero(valid)
                chosen = (low[p] & U(LOW20)).astype(np.int64)
                new = np.append(True, (chosen[1:] != chosen[:-1]) | (p[1:] != p[:-1] + 1))
                at = np.flatnonzero(new)
                first, last = p[at], p[np.append(at[1:], len(p)) - 1]
                length = last - first + width
                span = mix(long[first] + mix(long[first + (length - 64) // 2] + mix(long[first + length - 64] + ((length << 20) + chosen[at] - first).astype(U))))
                doc = row[first]
                place = (offset[first] << 28) | (length << 20) | marks[doc]
                yield pa.RecordBatch.from_arrays([pa.array(mix(grams[chosen[at]]).view(np.int64)), pa.array(span.view(np.int64)), pa.array(ids[doc].astype(np.int64)), pa.array(place)], ["gram", "span", "doc_id", "place"])

    return run


def neighbours(batches):
    """For mapInArrow over sorted (gram, span, doc_id, place): rows (kind, gram, doc_id, place), kind 1 for repeats and 0 for candidates."""
    edge, held = None, None
    names = ["gram", "span", "doc_id", "place"]

    def decided(rows, first, follows):
        """rows: 4 x n; first: the first (doc_id, place) of the kind that rows[0] goes on, or None; follows: the gram after the last."""
        gram, span, doc, place = rows
        new = np.append(first is None, (gram[1:] != gram[:-1]) | (span[1:] != span[:-1]))
        at = np.maximum.accumulate(np.where(new, np.arange(len(gram)), -1))
        first_doc, first_place = doc[at], place[at]
        if first is not None:
            first_doc, first_place = np.where(at < 0, first[0], first_doc), np.where(at < 0, first[1], first_place)
        repeat = ~new & ((doc > first_doc) | ((doc == first_doc) & (place >> 28 > first_place >> 28)))
        after = np.append(gram[1:], follows if follows is not None else gram[-1])
        before = np.append(gram[0] if first is not None or lead else gram[0] + 1, gram[:-1])
        alone = new & ~((before == gram) | (after == gram) | (gram == edge))
        keep = repeat | (new & ~alone)
        return pa.RecordBatch.from_arrays([pa.array(repeat[keep].astype(np.int32)), pa.array(gram[keep]), pa.array(doc[keep]), pa.array(place[keep])], ["kind", "gram", "doc_id", "place"]), (first_doc[-1], first_place[-1])

    last = None  # of the row before held: gram, span and the first of its kind
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy() for c in names])
        if not rows.shape[1]:
            continue
        rows = rows if held is None else np.concatenate([held, rows], axis=1)
        edge = rows[0, 0] if edge is None else edge
        held = rows[:, -1:]
        if rows.shape[1] > 1:
            own = rows[:, :-1]
            same = last is not None and last[0] == own[0, 0] and last[1] == own[1, 0]
            lead = last is not None and last[0] == own[0, 0]
            out, first = decided(own, last[2] if same else None, held[0, 0])
            last = own[0, -1], own[1, -1], first
            yield out
    if held is not None:
        same = last is not None and last[0] == held[0, 0] and last[1] == held[1, 0]
        lead = last is not None and last[0] == held[0, 0]
        yield decided(held, last[2] if same else None, None)[0]


def cut(batches):
    """For mapInArrow over (doc_id, text, mark, spans): the bytes of each listed domain."""
    for batch in parts(batches):
        for doc, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True):
            data = zlib.decompress(text)
            place = [s["place"] for s in spans]
            yield pa.RecordBatch.from_arrays([pa.array([s["gram"] for s in spans], pa.int64()), pa.array([s["n"] for s in spans], pa.int64()), pa.array([doc] * len(spans), pa.int64()), pa.array(place, pa.int64()), pa.array([data[p >> 28 : (p >> 28) + ((p >> 20) & 255)] for p in place], pa.binary())], ["gram", "n", "doc_id", "place", "bytes"])


def windows_of(table, width: int):
    """The windows of domains (gram, doc_id, place, bytes): arrays gram, hash, doc_id, place."""
    place = table.column("place").to_numpy()
    length = (place >> 20) & 255
    begin = np.cumsum(length) - length
    data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    count = length - width + 1
    own = np.repeat(np.arange(len(place)), count)
    step = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    (h,) = string_hashes(data, [width])
    at = (((place[own] >> 28) + step) << 28) | (width << 20) | (place[own] & LOW20)
    return table.column("gram").to_numpy()[own], h[begin[own] + step].view(np.int64), table.column("doc_id").to_numpy()[own], at


def block_repeats(width: int):
    """For applyInArrow over a block of whole grams: the windows that start earlier too."""

    def run(table: pa.Table) -> pa.Table:
        gram, h, doc, place = windows_of(table, width)
        order = np.lexsort((place, doc, h, gram))
        gram, h, doc, place = gram[order], h[order], doc[order], place[order]
        new = np.append(True, (gram[1:] != gram[:-1]) | (h[1:] != h[:-1]))
        first = np.maximum.accumulate(np.where(new, np.arange(len(gram)), 0))
        repeat = (doc > doc[first]) | ((doc == doc[first]) & (place >> 28 > place[first] >> 28))
        return pa.table({"doc_id": doc[repeat], "place": place[repeat]})

    return run


def windows(width: int):
    """For mapInArrow over domains (gram, doc_id, place, bytes): their windows as rows."""

    def run(batches):
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in windows_of(batch, width)], ["gram", "span", "doc_id", "place"])

    return run


def packed(docs: DataFrame) -> DataFrame:
    """Texts as compressed bytes, for the shuffles."""

    def run(batches):
        for batch in parts(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([zlib.compress(x.as_buffer() or b"", 6) if x.is_valid else zlib.compress(b"") for x in batch.column("text").cast(pa.large_string())], pa.binary()), pa.array([zlib.crc32(x.as_buffer() or b"") & LOW20 if x.is_valid else 0 for x in batch.column("text").cast(pa.large_string())], pa.int64())], ["doc_id", "text", "mark"])

    return docs.mapInArrow(run, "doc_id long, text binary, mark long")


def without(batches):
    """For mapInArrow over (doc_id, text, places): what is left of each text, with counts."""
    for batch in parts(batches):
        out = []
        for doc, text, places in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "places")), strict=True):
            data = zlib.decompress(text)
            kept, spans = data, np.zeros((0, 2), np.int64)
            if places:
                place = np.sort(np.array(places, np.int64))
                lo, hi = place >> 28, np.maximum.accumulate((place >> 28) + ((place >> 20) & 255))
                new = np.append(True, lo[1:] > hi[:-1])
                spans = np.stack([lo[new], hi[np.append(new[1:], True)]], axis=1)
                edges = [0, *spans.ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            out.append((doc, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, spans.tolist()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.list_(pa.list_(pa.int64()))], strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])


def later(rows: DataFrame, name: str) -> DataFrame:
    """The rows (gram, span, doc_id, place) with whether an equal (gram, span) starts earlier."""
    first = rows.groupBy("gram", "span").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n")).where("n > 1")
    start = F.shiftright("place", 28)
    return rows.join(first.hint(name), ["gram", "span"], "left").withColumn("repeat", F.coalesce((F.col("doc_id") > F.col("first.doc_id")) | ((F.col("doc_id") == F.col("first.doc_id")) & (start > F.shiftright("first.place", 28))), F.lit(False))).drop("first", "n")


def suffix_dedup(docs: DataFrame, width: int = 100) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans): the bytes left of each text and the removed runs [from, to)."""
    if not 64 + GRAM <= width <= 108:
        raise ValueError(f"width must be from {64 + GRAM} to 108 bytes")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shape = "gram long, span long, doc_id long, place long"
    order = ["gram", "span", "doc_id", "place"]
    places = docs.where("doc_id is not null").mapInArrow(domains(width), shape)
    judged = stored(places.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(neighbours, "kind int, gram long, doc_id long, place long"), "judged")
    mark = F.col("place").bitwiseAND(LOW20).alias("mark")
    texts = packed(docs)
    candidates = judged.where("kind = 0").distinct()
    shared = candidates.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    todo = candidates.join(shared.hint("shuffle_hash"), "gram").groupBy("doc_id", mark).agg(F.collect_list(F.struct("gram", "n", "place")).alias("spans"))
    domain = stored(texts.join(todo.hint("shuffle_hash"), ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"]).select("doc_id", "text", "spans").mapInArrow(cut, "gram long, n long, doc_id long, place long, bytes binary"), "domains")
    blocks = domain.count() // BLOCK + 1
    small = domain.where(F.col("n") <= GROUP).groupBy(F.pmod(F.xxhash64("gram"), F.lit(blocks)).alias("block")).applyInArrow(block_repeats(width), "doc_id long, place long")
    large = later(domain.where(F.col("n") > GROUP).mapInArrow(windows(width), shape), "shuffle_hash").where("repeat").select("doc_id", "place")
    repeats = judged.where("kind = 1").select("doc_id", "place").union(small).union(large)
    repeats = repeats.groupBy("doc_id", mark).agg(F.collect_list("place").alias("places"))
    out = texts.join(repeats, ["doc_id", "mark"], "left").select("doc_id", "text", "places")
    return out.mapInArrow(without, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<array<long>>")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir), 100).drop("kept", "spans")
