"""SentencePiece encoding and decoding as weighted finite-state transduction.

Three transducers meet. The normaliser rewrites text (the model's character map, leftmost longest match first; blanks
become the mark, one mark is put in front). The piece transducer is a trie over bytes: it reads the bytes of a piece and
writes its id at the piece's cost. Byte fallback reads one character that is no piece and writes an id per byte. Composed
with an input they give a lattice, whose arcs are pieces, and its shortest path in the tropical semiring (costs add
along a path, the least total wins) is the encoding.

For a unigram model an arc costs the negated piece score. A model of merges has a fourth machine, over pairs of pieces:
an arc after another costs nothing if merging their characters would leave just these two, and else infinitely much.
A state is then a position and its last piece; as merging what lies before a position ends in one way only, each
position has one such state.

A text is cut wherever no piece holds the two characters side by side, since every path has a border there; the distinct
segments of a block of texts are composed and relaxed together, offset by offset, in arrays.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.llm.common import gathered, map_arrow, slices
from groundmill.llm.repeats import lists

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text that are encoded at once.
BLOCK = 2 << 20
#: Longer segments (in bytes) are relaxed one by one, since few others share their offsets.
LONG = 256
#: Slots for remembered verdicts of the pair machine.
SLOTS = 1 << 20
#: Stands between segments; no UTF-8 text holds it.
GAP = 0xFF


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class PieceModel:
    """What a model file says: pieces with scores and types, and the normaliser's settings."""

    pieces: list[str]
    scores: np.ndarray
    types: list[int]
    unigram: bool
    dummy_prefix: bool
    squeeze: bool
    charsmap: bytes

    @staticmethod
    def parse(data: bytes) -> PieceModel:
        pieces, scores, types, trainer, normal = [], [], [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                got = dict(_fields(value))
                pieces.append(got[1].decode())
                scores.append(np.frombuffer(got.get(2, b"\0\0\0\0"), "<f4")[0])
                types.append(got.get(3, 1))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        return PieceModel(pieces, np.array(scores, np.float64), types, trainer.get(3, 1) == 1, bool(normal.get(3, 1)), bool(normal.get(4, 1)), normal.get(2, b""))


#: Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def character_map(data: bytes) -> dict[str, str]:
    """What a model's compiled character map rewrites: the strings its double-array trie accepts, with what they become."""
    if not data:
        return {}
    size = int.from_bytes(data[:4], "little")
    units, texts = np.frombuffer(data[4 : 4 + size], "<u4").tolist(), data[4 + size :]
    found, todo = {}, [(0, b"")]
    step = lambda at: at ^ (units[at] >> 10 << ((units[at] & 512) >> 6))
    while todo:
        at, read = todo.pop()
        base = step(at)
        for byte in range(1, 256):
            child = base ^ byte
            if child < len(units) and units[child] & 0x800000FF == byte:
                if units[child] >> 8 & 1:
                    begin = units[step(child)] & 0x7FFFFFFF
                    found[(read + bytes([byte])).decode()] = texts[begin : texts.index(b"\0", begin)].decode()
                todo.append((child, read + bytes([byte])))
    return found


class Transducer:
    """The compiled model: normaliser, piece trie, byte fallback and, for merges, the pair machine."""

    def __init__(self, model: PieceModel):
        self.model = model
        ids = {p.replace(MARK, " ").encode(): i for i, (p, t) in enumerate(zip(model.pieces, model.types, strict=True)) if t in (NORMAL, USER)}
        count = len(model.pieces)
        #: Stands for a character that is no piece.
        self.other = count
        self.cost = np.zeros(count + 1)
        if model.unigram:
            self.cost[:count] = -model.scores
            self.cost[count] = 10 - float(model.scores[list(ids.values())].min())
        else:
            ids = self._compile_pairs(ids)
        self._compile_trie(ids)
        self.rewrites = character_map(model.charsmap)
        self.firsts, self.widest = {k[0] for k in self.rewrites}, max(map(len, self.rewrites), default=0)
        found = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types, strict=True)) if t == BYTE}
        self.fallback = np.array([found[f"<0x{b:02X}>"] for b in range(256)], np.int32) if len(found) == 256 else None
        self.unknown = model.types.index(UNKNOWN)
        text = {BYTE: lambda p: bytes([int(p[3:5], 16)]), UNKNOWN: lambda p: " \u2047 ".encode(), CONTROL: lambda p: b""}
        self.written = pa.array([text.get(t, lambda p: p.replace(MARK, " ").encode())(p) for p, t in zip(model.pieces, model.types, strict=True)], pa.large_binary())

    def _compile_trie(self, ids: dict[bytes, int]) -> None:
        """``next[state, byte]`` (0: none, 1: the root) and the piece that each state writes; and which bytes may meet inside a piece."""
        nodes: dict[tuple[int, int], int] = {}
        ends = [-1, -1]
        self.meet = np.zeros((256, 256), bool)
        for piece, i in ids.items():
            at = 1
            for k, byte in enumerate(piece):
                if k and byte & 0xC0 != 0x80:
                    self.meet[piece[k - 1], byte] = True
                to = nodes.get((at, byte))
                if to is None:
                    to = nodes[at, byte] = len(ends)
                    ends.append(-1)
                at = to
            ends[at] = i
        self.next = np.zeros((len(ends), 256), np.uint16 if len(ends) < 1 << 16 else np.int32)
        self.next[tuple(np.array(list(nodes), np.int64).reshape(-1, 2).T)] = list(nodes.values())
        self.ends = np.array(ends, np.int32)

    def _compile_pairs(self, ids: dict[bytes, int]) -> dict[bytes, int]:
        """The pair machine's tables; returns the pieces that merging can give.

        ``rank`` orders merges, best first; ``left`` and ``right`` are the halves of a piece's last merge; ``pairs``
        are the pieces that can merge, with the rank of what they become.
        """
        count = len(self.model.pieces)
        _, rank = np.unique(-self.model.scores, return_inverse=True)
        self.left, self.right, self.last_rank = np.full(count + 1, -1), np.full(count + 1, -1), np.full(count + 1, -1)
        joins, made = {}, {}
        for piece, i in ids.items():
            text = piece.decode()
            for k in range(1, len(text)):
                a, b = ids.get(text[:k].encode()), ids.get(text[k:].encode())
                if a is not None and b is not None:
                    joins[a, b] = int(rank[i])
        for piece, i in ids.items():
            text = piece.decode()
            halves = _last_merge([ids.get(c.encode(), -1) for c in text], joins, ids, text)
            if len(text) == 1 or halves:
                made[piece] = i
            if halves:
                self.left[i], self.right[i], self.last_rank[i] = *halves, rank[i]
        keys = np.array([a * (count + 1) + b for a, b in joins], np.int64)
        by = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[by], np.array(list(joins.values()), np.int64)[by]
        self.known_keys, self.known = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)
        return made

    def fits(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether the pair machine has an arc from each piece to the next; -1 before is a start, which fits all."""
        keys = before.astype(np.int64) * (self.other + 1) + piece
        slot = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        fine = self.known[slot] | (before < 0)
        new = np.flatnonzero((self.known_keys[slot] != keys) & (before >= 0))
        if len(new):
            fine[new] = self.stay_apart(before[new], piece[new])
            self.known_keys[slot[new]] = keys[new]
            self.known[slot[new]] = fine[new]
        return fine

    def stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of a and b gives a and b again.

        Merges are undone from the last one back, on the right flank of a and the left flank of b. The border was
        crossed if what then touches it could merge before the merge just undone; of equal ranks the left one is first.
        """
        out, live = np.ones(len(a), bool), np.arange(len(a))
        a, b, limit = a.astype(np.int64), b.astype(np.int64), np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            keys = a * (self.other + 1) + b
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            crossed = (self.pair_keys[at] == keys) & (2 * self.pair_ranks[at] < limit)
            out[live[crossed]] = False
            of_a, of_b = self.last_rank[a], self.last_rank[b]
            on = ~crossed & ((of_a >= 0) | (of_b >= 0))
            live, a, b, of_a, of_b = live[on], a[on], b[on], of_a[on], of_b[on]
            first = of_a > of_b
            limit = np.where(first, 2 * of_a, 2 * of_b + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def normalise(self, text: str) -> bytes:
        if self.rewrites and not self.firsts.isdisjoint(text):
            out, at = [], 0
            while at < len(text):
                reach = next((k for k in range(min(self.widest, len(text) - at), 0, -1) if text[at : at + k] in self.rewrites), 0) if text[at] in self.firsts else 0
                out.append(self.rewrites[text[at : at + reach]] if reach else text[at])
                at += reach or 1
            text = "".join(out)
        text = text.replace(MARK, " ")
        if self.model.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        return (" " + text if self.model.dummy_prefix and text else text).encode()

    def _lattice(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(start, length, piece)`` of every arc that the text, with a GAP after each segment, has in the composed machine."""
        border = np.flatnonzero(text & 0xC0 != 0x80)
        inner = text[border] != GAP
        chars, width = border[inner], np.diff(np.append(border, len(text)))[inner]
        lone = np.zeros(len(text), bool)
        at, wide, state, k, found = chars, width, np.ones(len(chars), np.int32), 0, []
        while len(at):
            state = self.next[state, text[at + k]]
            on = np.flatnonzero(state)
            at, wide, state, k = at[on], wide[on], state[on], k + 1
            piece = self.ends[state]
            ends = np.flatnonzero(piece >= 0)
            lone[at[ends[wide[ends] == k]]] = True
            found.append((at[ends], np.full(len(ends), k), piece[ends]))
        rest = ~lone[chars]
        found.append((chars[rest], width[rest], np.full(rest.sum(), self.other)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _paths(self, segments: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: ids of the shortest paths of all segments, one after another, and where each one's end."""
        sizes = np.array([len(x) for x in segments]) if isinstance(segments, list) else np.diff(np.frombuffer(segments.buffers()[1], np.int32, len(segments) + 1, 4 * segments.offset))
        data = np.frombuffer(b"".join(segments if isinstance(segments, list) else segments.to_pylist()), np.uint8)
        number = np.repeat(np.arange(len(sizes)), sizes)
        text = np.full(len(data) + len(sizes), GAP, np.uint8)
        text[np.arange(len(data)) + number] = data
        begins = np.cumsum(sizes + 1) - sizes - 1
        start, length, piece = self._lattice(text)
        owner = np.repeat(np.arange(len(sizes)), sizes + 1)[start]
        offset = start - begins[owner]
        cost, last, step = np.full(len(text), inf), np.full(len(text), -1), np.zeros(len(text), np.int64)
        cost[begins] = 0.0
        slow = sizes[owner] > LONG
        by = np.flatnonzero(~slow)[np.argsort(offset[~slow].astype(np.uint16), kind="stable")]
        bounds = np.searchsorted(offset[by], np.arange(offset[by[-1]] + 2)) if len(by) else []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):  # arcs that leave one offset of every segment
            arcs = by[lo:hi]
            s, e, p = start[arcs], start[arcs] + length[arcs], piece[arcs]
            total = cost[s] + self.cost[p]
            better = np.flatnonzero(total < cost[e])
            if not self.model.unigram:
                better = better[self.fits(last[s[better]], p[better])]
            e = e[better]
            cost[e], last[e], step[e] = total[better], p[better], length[arcs[better]]
        if slow.any():
            self._relax(start[slow], length[slow], piece[slow], cost, last, step)
        at, path = begins + sizes, np.zeros(len(text), bool)
        at = at[sizes > 0]
        while len(at):
            path[at] = True
            at = at - step[at]
            at = at[step[at] > 0]
        ends = np.flatnonzero(path)
        chosen, took = last[ends], step[ends]
        if self.fallback is None:
            ids, times = np.where(chosen == self.other, self.unknown, chosen), np.ones(len(ends), np.int64)
        else:
            times = np.where(chosen == self.other, took, 1)
            ids = np.repeat(chosen, times)
            inner = np.arange(len(ids)) - np.repeat(np.cumsum(times) - times, times)
            spelt = ids == self.other
            ids[spelt] = self.fallback[text[(np.repeat(ends - took, times) + inner)[spelt]]]
        bounds = np.concatenate([[0], np.cumsum(times)])
        return ids.astype(np.int32), bounds[np.searchsorted(ends, begins + sizes, "right")]

    def _relax(self, start: np.ndarray, length: np.ndarray, piece: np.ndarray, cost: np.ndarray, last: np.ndarray, step: np.ndarray) -> None:
        """The same relaxation, arc by arc, for long segments."""
        by = np.argsort(start, kind="stable")
        far: dict[int, float] = {}
        came: dict[int, tuple[int, int]] = {}
        fine: dict[tuple[int, int], bool] = {}
        for s, n, p in zip(start[by].tolist(), length[by].tolist(), piece[by].tolist(), strict=True):
            here = far.get(s, 0.0 if cost[s] == 0.0 else inf)
            total = here + self.cost[p]
            if total < far.get(s + n, inf):
                before = came.get(s, (-1, 0))[0]
                if not self.model.unigram and before >= 0:
                    if (before, p) not in fine:
                        fine[before, p] = bool(self.fits(np.array([before]), np.array([p]))[0])
                    if not fine[before, p]:
                        continue
                far[s + n], came[s + n] = total, (p, n)
        at = np.fromiter(came, np.int64, len(came))
        last[at], step[at] = np.array(list(came.values()), np.int64).reshape(-1, 2).T

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Equal segments of the texts are composed once."""
        normal = [self.normalise(t) for t in texts]
        sizes = np.array([len(t) for t in normal], np.int64)
        data = np.frombuffer(b"".join(normal), np.uint8)
        if not len(data):
            return [np.zeros(0, np.int32) for _ in texts]
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.meet[data[:-1], data[1:]] & (data[1:] & 0xC0 != 0x80)
        begins = np.cumsum(sizes) - sizes
        cut[begins[sizes > 0]] = True
        at = np.append(np.flatnonzero(cut), len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        ids, ends = self._paths(pieces.dictionary)
        which = pieces.indices.to_numpy()
        starts = np.concatenate([[0], ends])[which]
        counts = ends[which] - starts
        done = np.cumsum(counts)
        flat = ids[np.repeat(starts - (done - counts), counts) + np.arange(done[-1])]
        until = np.concatenate([[0], done])[np.searchsorted(at[:-1], begins + sizes)]
        found = np.split(flat, until[:-1])
        if self.fallback is None:  # neighbours that are no pieces share one id
            found = [f[np.append(True, (f[1:] != self.unknown) | (f[:-1] != self.unknown))[: len(f)]] for f in found]
        return found

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, ids: list[np.ndarray]) -> list[str]:
        """The text of each list of ids: the transducer read backwards. Ids of control pieces write nothing."""
        wrote = self.written.take(pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]), pa.int32()))
        at = np.frombuffer(wrote.buffers()[1], np.int64, len(wrote) + 1)[np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)] if len(wrote) else np.zeros(len(ids) + 1, np.int64)
        data = wrote.buffers()[2].to_pybytes() if len(wrote) else b""
        out = [data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]
        return [t[1:] if self.model.dummy_prefix and t.startswith(" ") else t for t in out]

    def decode(self, ids: list[int]) -> str:
        return self.decode_all([np.array(ids, np.int32)])[0]


def _last_merge(part: list[int], joins: dict[tuple[int, int], int], ids: dict[bytes, int], text: str) -> tuple[int, int] | None:
    """The halves of the merge that completes ``text`` when its best-ranked neighbours merge, leftmost first; None if they do not."""
    spans = [(k, k + 1) for k in range(len(part))]
    while len(part) > 1:
        ranks = [joins.get(pair, inf) for pair in zip(part, part[1:], strict=False)]
        k = min(range(len(ranks)), key=ranks.__getitem__)
        if ranks[k] == inf:
            return None
        if len(part) == 2:
            return part[0], part[1]
        spans[k : k + 2] = [(spans[k][0], spans[k + 1][1])]
        part[k : k + 2] = [ids[text[slice(*spans[k])].encode()]]
    return None


_compiled: dict[int, Transducer] = {}


def compiled(data: bytes) -> Transducer:
    key = hash(data)
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(PieceModel.parse(data))
    return _compiled[key]


def model_bytes(path: str = MODEL) -> bytes:
    """A model file's bytes, read on the driver and sent with the tasks; such files are of a few MB at most."""
    with open(path, "rb") as f:
        return f.read()


def encode_pieces(docs: DataFrame, model: bytes) -> DataFrame:
    """``docs`` with ``ids``, the piece ids of each whole text, and ``decoded``, the text read back from them.

    A null text encodes as an empty one, which has no ids. Columns named ``ids`` or ``decoded`` are replaced.
    Equal rows give equal results.
    """
    rest = docs.drop("ids", "decoded")
    names, schema = rest.columns, rest.schema.simpleString()[len("struct<") : -1]
    shared = rest.sparkSession.sparkContext.broadcast(model)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(shared.value)
        for batch in gathered(batches, "text", BLOCK):
            for part in slices([pa.RecordBatch.from_arrays([*batch.columns, batch["text"].cast(pa.large_binary())], [*names, "weight of text"])], ["weight of text"], BLOCK):
                found = machine.encode_all([t or "" for t in part["text"].to_pylist()])
                back = pa.array(machine.decode_all(found), pa.string())
                yield pa.RecordBatch.from_arrays([*(part[c] for c in names), lists(found, pa.int32()), back], [*names, "ids", "decoded"])

    return map_arrow(rest, body, f"{schema},ids:array<int>,decoded:string")


def op7_sentencepiece(spark: SparkSession, sf_dir: str, path: str = MODEL) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = encode_pieces(docs.select("doc_id", "text"), model_bytes(path))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))
