"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The normaliser (a space in front, spaces to the model's mark), the pieces and the byte fallback are compiled into one
transducer. A state is the piece read last; an arc reads the next piece. The model merges pairs by rank, so its
segmentation isn't the one of least summed piece weights. What holds instead is local: a segmentation is the model's
if and only if each two neighbouring pieces, merged on their own, come apart as just these two. An arc between pieces
for which that holds weighs 0, else infinity; a character without a piece goes through its bytes and fits anything.
Composed with a text, the path of least weight in the tropical semiring is then the model's segmentation, and each
prefix of the text has one best last piece, which the search keeps (it is the shortest-path recursion with one finite
path per state). Weights of pairs are worked out by merging on first use and kept.

No piece reads past a mark that follows another character, nor a line end, so texts are cut there into units; the units of
a batch that are new are searched together, position by position, with numpy. Texts are independent: there is no
shuffle, and a long unit is searched on its own.

Decoding joins the pieces' bytes, turns marks into spaces and drops the space in front; bytes that aren't UTF-8 become
U+FFFD. A text comes back as it was unless it holds the mark U+2581 itself, which comes back as a space.

Cases: null and empty texts have no tokens; repeated rows are encoded each; other columns ride along in encode().
The model's path is a parameter; it is read by the driver, and its pieces go to the tasks with the function.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents
from .textbytes import BASE, U

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
#: Longer units are searched one by one; most units kept between batches.
LONG, KEPT = 48, 800_000


def pieces_of(path: str) -> tuple[list[str], list[float], list[int]]:
    """Pieces, scores and the ids of the 256 byte pieces of a model file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [m.id_to_piece(i) for i in range(len(m))]
    whole = [not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)) for i in range(len(m))]
    return [n if w else "" for n, w in zip(names, whole, strict=True)], [m.get_score(i) for i in range(len(m))], [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


class Transducer:
    """The compiled transducer of a model."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int]):
        self.pieces, self.byte_ids = pieces, np.array(byte_ids, np.int32)
        self.score = {p: s for p, s in zip(pieces, scores, strict=True) if p}
        self.fits: dict[int, bool] = {}
        self.other = len(pieces)  # the id of a character without a piece
        own = {p: i for i, p in enumerate(pieces) if p}
        self.id = {p: i for p, i in own.items() if len(p) == 1 or self.merged(p) == [p]}
        self.longest = max(map(len, self.id))
        self.length = np.array([len(p) for p in pieces] + [1], np.int64)
        codes, ids = zip(*sorted((int(self._hash(p)), i) for p, i in self.id.items()), strict=True)
        self.codes, self.ids = np.array(codes, U), np.array(ids, np.int64)
        self.some = np.zeros(1 << 20, bool)  # a table that most strings that are no piece miss
        self.some[(self.codes >> U(44)).astype(np.int64)] = True
        self.known, self.known_fit = np.zeros(0, np.int64), np.zeros(0, bool)
        of_byte = {int(i): bytes([b]) for b, i in enumerate(byte_ids)}
        self.bytes = [of_byte.get(i, p.replace(MARK, " ").encode()) for i, p in enumerate(pieces)]
        self.is_byte = np.zeros(len(pieces) + 1, bool)
        self.is_byte[self.byte_ids] = True
        self.kept: dict[str, bytes] = {}

    @staticmethod
    def _hash(p: str) -> np.uint64:
        h = 0
        for c in p:
            h = (h * int(BASE | U(1)) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return U(h)

    def merged(self, text: str) -> list[str]:
        """The model's merges on a short text: the best pair first, of equals the leftmost."""
        own = list(text)
        while len(own) > 1:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(own, own[1:], strict=False)) if a + b in self.score), default=None)
            if best is None:
                break
            i = -best[1]
            own[i : i + 2] = [own[i] + own[i + 1]]
        return own

    def fit(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a; -1 is the start."""
        if a < 0 or a == self.other or b == self.other:
            return True
        code = a * (self.other + 1) + b
        if code not in self.fits:
            x, y = self.pieces[a], self.pieces[b]
            self.fits[code] = self.merged(x + y) == [x, y]
        return self.fits[code]

    def fit_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        codes = a * (self.other + 1) + b
        out = (a < 0) | (a == self.other) | (b == self.other)
        todo = np.flatnonzero(~out)
        if len(self.fits) > 1.3 * len(self.known) + 1000:
            self.known = np.array(sorted(self.fits), np.int64)
            self.known_fit = np.array([self.fits[c] for c in self.known.tolist()])
        own = codes[todo]
        there = np.zeros(len(todo), bool)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
            there = self.known[at] == own
            out[todo[there]] = self.known_fit[at[there]]
        if not there.all():
            new, back = np.unique(own[~there], return_inverse=True)
            fit = np.array([self.fit(c // (self.other + 1), c % (self.other + 1)) for c in new.tolist()])
            out[todo[~there]] = fit[back]
        return out

    def path(self, unit: str) -> list[int]:
        """The best path through one unit."""
        last = [-1]
        for j in range(1, len(unit) + 1):
            for n in range(min(j, self.longest), 0, -1):
                i = self.id.get(unit[j - n : j], self.other if n == 1 else -1)
                if i >= 0 and last[j - n] != -2 and self.fit(last[j - n], i):
                    last.append(i)
                    break
            else:
                last.append(-2)
        out, j = [], len(unit)
        while j:
            out.append(last[j])
            j -= int(self.length[last[j]])
        return out[::-1]

    def paths(self, units: list[str]) -> list[list[int]]:
        """The best paths through units of at most LONG characters, searched together."""
        size = np.array([len(u) for u in units])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        most = int(size[0])
        chars = np.zeros((len(units), most), U)
        flat = np.frombuffer("".join(units[i] for i in order).encode("utf-32-le"), np.uint32)
        chars[np.arange(most) < size[:, None]] = flat
        prefix = np.zeros((most + 1, len(units)), U)
        power = np.full(self.longest + 1, BASE | U(1), U)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        last = np.full((most + 1, len(units)), -1, np.int64)
        for j in range(1, most + 1):
            n = int(np.searchsorted(-size, -j, side="right"))  # units with at least j characters
            prefix[j, :n] = prefix[j - 1, :n] * power[1] + chars[:n, j - 1] + U(1)
            left = np.arange(n)
            last[j, :n] = -2
            for k in range(min(j, self.longest), 0, -1):
                code = prefix[j, left] - prefix[j - k, left] * power[k]
                may = np.flatnonzero(self.some[(code >> U(44)).astype(np.int64)]) if k > 1 else np.arange(len(left))
                at = np.minimum(np.searchsorted(self.codes, code[may]), len(self.codes) - 1)
                piece = np.where(self.codes[at] == code[may], self.ids[at], self.other if k == 1 else -1)
                before = last[j - k, left[may]]
                good = (piece >= 0) & (before != -2)
                may, piece, before = may[good], piece[good], before[good]
                good = self.fit_all(before, piece)
                may, piece = may[good], piece[good]
                last[j, left[may]] = piece
                left = np.delete(left, may)
                if not len(left):
                    break
        out = [[] for _ in units]
        place, alive = size.copy(), np.arange(len(units))
        steps = []
        while len(alive):
            piece = last[place[alive], alive]
            steps.append((alive, piece))
            place[alive] -= self.length[piece]
            alive = alive[place[alive] > 0]
        for rows, piece in reversed(steps):
            for r, p in zip(order[rows].tolist(), piece.tolist(), strict=True):
                out[r].append(p)
        return out

    def emitted(self, unit: str, path: list[int]) -> bytes:
        """The ids of a path as little-endian 32-bit numbers, characters without a piece through their bytes."""
        if self.other in path:
            ids, j = [], 0
            for p in path:
                n = int(self.length[p])
                ids += self.byte_ids[list(unit[j : j + n].encode())].tolist() if p == self.other else [p]
                j += n
            path = ids
        return np.array(path, "<i4").tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut = [UNIT.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.kept) > KEPT:
            self.kept.clear()
        new = {u for units in cut for u in units if u not in self.kept}
        short = [u for u in new if len(u) <= LONG]
        for at in range(0, len(short), 50_000):
            some = short[at : at + 50_000]
            for u, p in zip(some, self.paths(some), strict=True):
                self.kept[u] = self.emitted(u, p)
        for u in new:
            if len(u) > LONG:
                self.kept[u] = self.emitted(u, self.path(u))
        return [np.frombuffer(b"".join([self.kept[u] for u in units]), "<i4") for units in cut]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.bytes[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_compiled: dict = {}


def compiled(pieces) -> Transducer:
    """One transducer for each model and worker."""
    key = hashlib.sha256(repr(pieces).encode()).digest()
    if key not in _compiled:
        _compiled[key] = Transducer(*pieces)
    return _compiled[key]


def encode(docs: DataFrame, model: str = MODEL, column: str = "ids", rows: int = 400) -> DataFrame:
    """The documents with the token ids of text in `column`; a column of that name is replaced."""
    pieces = pieces_of(model)
    docs = docs.drop(column)
    at = docs.columns.index("text")
    kind = T.StructType([*docs.schema.fields, T.StructField(column, T.ArrayType(T.IntegerType()))])

    def run(batches):
        machine = compiled(pieces)
        for batch in batches:
            for lo in range(0, len(batch), rows):
                part = batch.slice(lo, rows)
                ids = machine.encode(part.column(at).to_pylist())
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))], [*part.schema.names, column])

    return docs.mapInArrow(run, kind)


def decode(rows: DataFrame, model: str = MODEL, column: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the text of the ids in `column`."""
    pieces = pieces_of(model)
    rows = rows.drop(into)
    at = rows.columns.index(column)
    kind = T.StructType([*rows.schema.fields, T.StructField(into, T.StringType())])

    def run(batches):
        machine = compiled(pieces)
        for batch in batches:
            ids = batch.column(at).fill_null([])
            flat, ends = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.asarray(pa.compute.list_value_length(ids)))]) if len(ids) else [0]
            texts = [machine.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    return rows.mapInArrow(run, kind)


def digests(docs: DataFrame, model: str = MODEL, rows: int = 400) -> DataFrame:
    """Rows (doc_id, n_tokens, n_byte_tokens, ids_sha256, round_trip): the ids as little-endian 32-bit numbers; whether decoding gives the text back."""
    pieces = pieces_of(model)

    def run(batches):
        machine = compiled(pieces)
        for batch in batches:
            for lo in range(0, len(batch), rows):
                texts = batch.column(1).slice(lo, rows).to_pylist()
                out = [(len(ids), int(machine.is_byte[ids].sum()), hashlib.sha256(ids.tobytes()).hexdigest(), machine.decode(ids) == (t or "")) for t, ids in zip(texts, machine.encode(texts), strict=True)]
                n, b, h, r = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, rows), pa.array(n, pa.int64()), pa.array(b, pa.int64()), pa.array(h), pa.array(r)], ["doc_id", "n_tokens", "n_byte_tokens", "ids_sha256", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, n_byte_tokens long, ids_sha256 string, round_trip boolean")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
