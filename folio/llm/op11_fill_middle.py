"""Fill-in-middle transformation: a text cut at two line ends into prefix, middle and suffix, which change places.

The cuts are counted in units, `[^\\n]*\\n|[^\\n]+`; which ones they are follows from a hash of the doc_id.

1. One small automaton reads a text: its state is whether the next character opens a unit, and how much of a mark (`<P>`,
   `<S>`, `<M>`) stands before it or whether one was found. A chunk of CHUNK code points emits its transition function, the
   end state for each start state, and the number of units that it opens from each start state.
2. Functions and counts compose associatively. A text of one chunk is resolved where it lies. A giant text's chunks are rows:
   FAN neighbours are composed into one row, and these again, until one is left; that one gives the number of units and the
   form. Only functions and counts move, about a hundred bytes a chunk.
3. Selection goes the other way: for each cut the row of FAN neighbours that holds it is known, their counts from the entry state
   tell which of them opens the unit, down to the chunk, which alone looks for the character. So no task walks a giant text.
4. The chunks' shares of the three pieces are put together in a row again, as the document came in one.

Cases: a null or empty text is plain and comes out empty; a text that holds a mark is plain; null doc_id is hashed as empty
text; repeated rows are cut alike; cuts that coincide give an empty piece; a text of one unit may be cut before or after it
only; a very long text goes by chunks; an empty table gives an empty table; of the input's other columns none is returned.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, stored

#: The marks.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points of a chunk, and chunks or rows composed into one.
CHUNK, FAN = 65_536, 64
#: States: 4 * (0 if the next character opens a unit, else 1) + (0 to 2 characters of a mark, 3 once one was found).
STATES, FOUND = 8, 3


def _mark_step(state: int, c: str) -> int:
    if state == FOUND:
        return FOUND
    if state == 2 and c == ">":
        return FOUND
    if state == 1 and c in "PSM":
        return 2
    return 1 if c == "<" else 0


def transitions(chunk: str) -> tuple[list[int], list[int]]:
    """For each start state, the end state and the number of units that the chunk opens."""
    if not chunk:
        return list(range(STATES)), [0] * STATES
    found = any(m in chunk for m in (PREFIX, SUFFIX, MIDDLE))
    tail = reduce(_mark_step, chunk[-2:], 0)
    heads = [reduce(_mark_step, chunk[:2], state) for state in range(4)]  # after two characters the start is forgotten, unless a mark was found
    ends = [FOUND if found or head == FOUND else head if len(chunk) <= 2 else tail for head in heads]
    after = 0 if chunk[-1] == "\n" else 4
    opened = chunk.count("\n") - (chunk[-1] == "\n")  # units opened after the first character
    return [after + e for e in ends] * 2, [opened + 1] * 4 + [opened] * 4


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The first four 32-bit numbers of the document's hash."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _place(chunk: str, unit: int, opens: bool) -> int:
    """Where the unit 0, 1, .. of those that the chunk opens begins; opens: whether its first character does."""
    at = 0
    for _ in range(unit if opens else unit + 1):
        at = chunk.index("\n", at) + 1
    return at


def _assembled(form: str, prefix: str, middle: str, suffix: str) -> str:
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}" if form == "psm" else f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def one_chunk(seed: int, rate: int, spm: int, rows: int = 2_000):
    """For mapInArrow over (doc_id, text) of one chunk at most: the whole transformation."""

    def cut(doc_id, text):
        to, units = transitions(text)
        n, h = units[0], draws(doc_id, seed)
        if not text or to[0] % 4 == FOUND or h[2] % 100 >= rate:
            return n, "plain", None, None, text
        form = "spm" if h[3] % 100 < spm else "psm"
        lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        a, b = (len(text) if u == n else _place(text, u, True) for u in (lo, hi))
        return n, form, a, b - a, _assembled(form, text[:a], text[a:b], text[b:])

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), rows):
                ids, texts = (batch.column(i).slice(lo, rows).to_pylist() for i in (0, 1))
                n, form, prefix, middle, out = zip(*[cut(i, t or "") for i, t in zip(ids, texts, strict=True)], strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, rows), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out)], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def into_chunks(size: int):
    """For mapInArrow over (row, doc_id, text): rows (row, doc_id, no, text, to, units), one for each chunk."""

    def run(batches):
        for batch in batches:
            for row, doc_id, text in zip(*[batch.column(i) for i in range(3)], strict=True):
                row, doc_id, text = row.as_py(), doc_id.as_py(), text.as_py()
                for no, at in enumerate(range(0, len(text), size)):
                    chunk = text[at : at + size]
                    to, units = transitions(chunk)
                    yield pa.RecordBatch.from_pydict({"row": pa.array([row], pa.int64()), "doc_id": pa.array([doc_id], pa.int64()), "no": pa.array([no], pa.int64()), "text": [chunk], "to": pa.array([to], pa.list_(pa.int32())), "units": pa.array([units], pa.list_(pa.int64()))})

    return run


def _composed(kids):
    """The function and counts of neighbours in order."""
    start = F.struct(F.sequence(F.lit(0), F.lit(STATES - 1)).cast("array<int>").alias("to"), F.array_repeat(F.lit(0).cast("long"), STATES).alias("units"))

    def step(done, kid):
        to = F.transform(done["to"], lambda s: F.element_at(kid["to"], s + 1))
        units = F.transform(F.arrays_zip(done["to"].alias("s"), done["units"].alias("n")), lambda x: x["n"] + F.element_at(kid["units"], x["s"] + 1))
        return F.struct(to.alias("to"), units.alias("units"))

    return F.aggregate(kids, start, step)


def composed(chunks: DataFrame, fan: int) -> list[DataFrame]:
    """Levels of rows (row, no, kids, to, units) above the chunks (row, no, to, units); the last has one for each text."""
    levels, below = [], chunks.select("row", "no", "to", "units")
    while not levels or levels[-1].where("no > 0").take(1):
        above = below.groupBy("row", F.floor(F.col("no") / fan).alias("no")).agg(F.array_sort(F.collect_list(F.struct("no", "to", "units"))).alias("kids"))
        above = above.withColumn("all_", _composed(F.col("kids"))).select("row", "no", "kids", "all_.to", "all_.units")
        levels.append(stored(above, "composed"))
        below = levels[-1]
    return levels


def _chosen(kids, state, unit):
    """The child of a row that opens the unit (counted from the row's start, entered in `state`), its entry state and the unit counted from its own start."""
    start = F.struct(F.lit(-1).cast("long").alias("no"), state.alias("state"), unit.alias("unit"), F.lit(False).alias("there"))

    def step(done, kid):
        own = F.element_at(kid["units"], done["state"] + 1)
        here = done["unit"] < own
        on = F.struct(F.lit(-1).cast("long").alias("no"), F.element_at(kid["to"], done["state"] + 1).alias("state"), (done["unit"] - own).alias("unit"), F.lit(False).alias("there"))
        return F.when(done["there"], done).when(here, F.struct(kid["no"].alias("no"), done["state"].alias("state"), done["unit"].alias("unit"), F.lit(True).alias("there"))).otherwise(on)

    return F.aggregate(kids, start, step)


def cut_places(chunks: DataFrame, levels: list[DataFrame], wanted: DataFrame, size: int) -> DataFrame:
    """Rows (row, cut, at): the code point where the unit of each wanted (row, cut, unit) begins, found from the top level down."""
    at = wanted.withColumns({"no": F.lit(0).cast("long"), "state": F.lit(0)})
    for level in reversed(levels):
        at = at.join(level.select("row", "no", "kids"), ["row", "no"])
        at = at.withColumn("kid_", _chosen(F.col("kids"), F.col("state"), F.col("unit"))).select("row", "cut", "kid_.no", "kid_.state", "kid_.unit")
    found = at.join(chunks.select("row", "no", "text"), ["row", "no"])
    ends = F.col("unit") + F.when(F.col("state") >= 4, 1).otherwise(0)
    within = F.when(ends == 0, 0).otherwise(F.length(F.call_function("substring_index", F.col("text"), F.lit("\n"), ends.cast("int"))) + 1)
    return found.select("row", "cut", (F.col("no") * size + within).alias("at"))


def many_chunks(docs: DataFrame, seed: int, rate: int, spm: int) -> DataFrame:
    """The transformation of texts of several chunks."""
    size = CHUNK
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    chunks = stored(rows.mapInArrow(into_chunks(size), "row long, doc_id long, no long, text string, to array<int>, units array<long>"), "chunks")
    levels = composed(chunks, FAN)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, i, 8), 16, 10).cast("long") for i in (1, 9, 17, 25)]
    whole = chunks.where("no = 0").select("row", "doc_id").join(levels[-1].select("row", F.element_at("units", 1).alias("n"), F.element_at("to", 1).alias("end")), "row")
    plain = (F.col("end") % 4 == FOUND) | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    whole = stored(whole.select("row", "doc_id", "n", form.alias("form"), F.least(h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)).alias("lo"), F.greatest(h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)).alias("hi")), "whole")
    cuts = whole.where("form <> 'plain'").select("row", "n", F.explode(F.create_map(F.lit("lo"), "lo", F.lit("hi"), "hi")).alias("cut", "unit"))
    places = cut_places(chunks, levels, cuts.where("unit < n").select("row", "cut", "unit"), size)
    places = places.groupBy("row").agg(*[F.max(F.when(F.col("cut") == c, F.col("at"))).alias(f"{c}_at") for c in ("lo", "hi")])
    near = F.coalesce("lo_at", F.lit(2**62)), F.coalesce("hi_at", F.lit(2**62))  # a cut at the end has no unit behind it
    shares = chunks.select("row", "no", "text").join(places, "row", "left")
    edge = [F.least(F.greatest(x - F.col("no") * size, F.lit(0)), F.length("text")).cast("int") for x in near]
    pieces = F.struct("no", F.substring("text", F.lit(1), edge[0]).alias("p"), F.substring("text", edge[0] + 1, edge[1] - edge[0]).alias("m"), F.substring("text", edge[1] + 1, F.length("text")).alias("s"))
    put = shares.groupBy("row").agg(F.array_sort(F.collect_list(pieces)).alias("parts"))
    whole_piece = lambda c: F.array_join(F.transform("parts", lambda x: x[c]), "")
    out = whole.join(put, "row").withColumns({c: whole_piece(c) for c in "pms"})
    moved = F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), "p", F.lit(SUFFIX), "s", F.lit(MIDDLE), "m")).when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), "s", F.lit(PREFIX), "p", F.lit(MIDDLE), "m")).otherwise(F.concat("p", "m", "s"))
    cut = F.col("form") != "plain"
    return out.select("doc_id", "n", "form", F.when(cut, F.length("p")).cast("long").alias("prefix_chars"), F.when(cut, F.length("m")).cast("long").alias("middle_chars"), moved.alias("output"))


def fill_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """Rows (doc_id, n, form, prefix_chars, middle_chars, output): the number of units, `plain`, `psm` or `spm`, the pieces' code
    points (null if plain) and the new text. Of 100 documents `rate` are cut, and of 100 of those `spm` have the suffix first.
    See the module for the method and for the cases."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    short = docs.where(F.col("text").isNull() | (F.length("text") <= CHUNK))
    out = short.mapInArrow(one_chunk(seed, rate, spm), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.unionByName(many_chunks(docs.where(F.length("text") > CHUNK), seed, rate, spm))


def restored(output, form):
    """The text that an output of the given form was made from."""
    after = lambda mark, c: F.substring(c, F.instr(c, mark) + F.lit(len(mark)), F.length(c))
    before = lambda mark, c: F.substring(c, F.lit(1), F.instr(c, mark) - 1)
    psm = F.concat(before(SUFFIX, after(PREFIX, output)), after(MIDDLE, output), before(MIDDLE, after(SUFFIX, output)))
    spm = F.concat(before(MIDDLE, after(PREFIX, output)), after(MIDDLE, output), before(PREFIX, after(SUFFIX, output)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle(documents(spark, sf_dir))
    hexed = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", hexed(F.col("output")).alias("output_sha256"), hexed(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), d AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, coalesce(array_to_string(u[1:least(x, y)], ''), '') AS p, coalesce(array_to_string(u[least(x, y) + 1:greatest(x, y)], ''), '') AS m, coalesce(array_to_string(u[greatest(x, y) + 1:], ''), '') AS s FROM d
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
