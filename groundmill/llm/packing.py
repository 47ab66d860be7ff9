"""Packing: documents become token sequences of one length by sum-of-squares online packing."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.llm.common import gathered, map_arrow, slices

#: Bytes of text whose distinct words are encoded together, how many words one call encodes, how many a worker remembers.
BLOCK, CALL, REMEMBERED = 16 << 20, 200, 500_000
#: Open windows a task holds at most; beyond, they are completed by cutting documents.
MOST_OPEN = 4096
END_ID = 1
STOPS = ".,;:!?"
#: Sequence ids count up from the task's number times this.
PER_TASK = 1 << 36


_known: dict[str, dict[str, bytes]] = {}


def _listed(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _ragged(pool: np.ndarray, begin: np.ndarray, take: np.ndarray) -> np.ndarray:
    """The runs ``pool[begin : begin + take]``, one after another."""
    ends = np.cumsum(take)
    return pool[np.repeat((begin - (ends - take)).astype(np.int32), take) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]


class WordTokens:
    """Token ids of texts, those of a public tokenizer with byte-level pieces, by encoding each distinct word once.

    Before a space that a visible character follows this tokenizer always cuts, since no piece holds a space but as its
    first character or in a run of white space; and it cuts between a letter or digit and the stops ``.,;:!?``. So a
    text's ids are those of its parts between such places, one after another. ``special`` strings of the tokenizer
    inside a text become their one id, as the library does by default.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = _known.setdefault(path, {})
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(names.values()) + 1, np.int32)  # bytes of each id's string: its characters stand for bytes
        self.width[list(names.values())] = [len(x) for x in names]

    def _each(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``parts``, one after another, and how many each has."""
        ids = [np.array(e.ids, np.uint32) for at in range(0, len(parts), CALL) for e in self.tokenizer.encode_batch_fast(parts[at : at + CALL], add_special_tokens=False)]
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), np.array([len(x) for x in ids], np.int64)

    def _spaced(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_each``, of a space and each word; many words are one call, told apart by the bytes that ids stand for.

        The first REMEMBERED words that a worker meets are kept for its later blocks and tasks.
        """
        listed = _listed(words)
        found = list(map(self.known.get, listed))
        new = [i for i, x in enumerate(found) if x is None]
        for at in range(0, len(new), CALL):
            some = new[at : at + CALL]
            told = [listed[i] for i in some]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(told)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum([len(w.encode()) + 1 for w in told])
            cuts = (4 * (np.searchsorted(np.cumsum(self.width[ids], dtype=np.int64), ends) + 1)).tolist()
            held = ids.tobytes()
            for i, begin, end in zip(some, [0, *cuts], cuts, strict=False):
                found[i] = held[begin:end]
            if len(self.known) < REMEMBERED:
                self.known.update(zip(told, (found[i] for i in some), strict=True))
        return np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts``, one after another, and how many each has; null texts have none."""
        split = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), " ")
        sizes = np.diff(split.offsets.to_numpy())
        words = split.flatten().dictionary_encode()
        place, names = words.indices.to_numpy(), words.dictionary
        visible = pc.match_substring_regex(names, r"^[!-~\p{L}\p{N}]").to_numpy(zero_copy_only=False)
        # Each word as a stem and its stops, where it can be cut there.
        stem = pc.utf8_rtrim(names, characters=STOPS)
        stem = pc.if_else(pc.match_substring_regex(stem, r"[\p{L}\p{N}]$"), stem, names)
        known, tails = stem.dictionary_encode(), pa.array([n[len(b) :] for n, b in zip(_listed(names), _listed(stem), strict=True)], pa.string()).dictionary_encode()
        stem_ids, stem_counts = self._spaced(known.dictionary)
        tail_ids, tail_counts = self._each(_listed(tails.dictionary))
        begin = np.concatenate([np.cumsum(stem_counts) - stem_counts, len(stem_ids) + np.cumsum(tail_counts) - tail_counts])
        both = np.stack([known.indices.to_numpy(), len(stem_counts) + tails.indices.to_numpy()], axis=1).ravel()
        counts = np.concatenate([stem_counts, tail_counts])[both]
        pool, held = _ragged(np.concatenate([stem_ids, tail_ids]), begin[both], counts), counts.reshape(-1, 2).sum(axis=1)
        # A part that starts a text has no space before it; one that may not be cut off is encoded with those before it.
        first = np.zeros(len(place) + 1, bool)
        first[np.cumsum(sizes) - sizes] = True
        first = first[:-1]
        starts = np.flatnonzero(first | visible[place])
        length = np.diff(np.append(starts, len(place)))
        own = first[starts] | (length > 1)
        runs = [("" if first[s] else " ") + " ".join(_listed(names.take(pa.array(place[s : s + n])))) for s, n in zip(starts[own].tolist(), length[own].tolist(), strict=True)]
        run_ids, run_counts = self._each(runs)
        begin, take = (np.cumsum(held) - held)[place[starts]], held[place[starts]]
        begin[own], take[own] = len(pool) + np.cumsum(run_counts) - run_counts, run_counts
        ends = np.concatenate([[0], np.cumsum(take)])[np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))]
        return _ragged(np.concatenate([pool, run_ids]), begin, take), np.diff(ends)


class SquarePacker:
    """Places items into windows of ``size`` tokens so that the sum of squared counts of partly filled windows stays least.

    ``level[h]`` counts the open windows filled to ``h``. An item of ``s`` tokens moves a window from some level h to
    h + s, or opens one (h = 0); of all levels that hold a window and have room the one whose move leaves the smallest
    sum of ``level[h] ** 2`` is taken, the fuller of two alike. A window filled to ``size`` is closed and counts no more.
    """

    def __init__(self, size: int):
        self.size = size
        self.level = np.zeros(size + 1, np.int64)
        self.at: list[list[list]] = [[] for _ in range(size + 1)]
        self.open = 0

    def choose(self, s: int) -> int:
        """The fill level that an item of ``s`` tokens goes to."""
        room = self.size - s
        after = 2 * self.level[s:] + 1
        after[-1] = 0  # full windows are closed
        cost = after[: room + 1] - 2 * self.level[: room + 1] + 1
        cost[0] = after[0]
        cost[1:][self.level[1 : room + 1] == 0] = np.iinfo(np.int64).max
        return room - int(cost[::-1].argmin())

    def place(self, piece: tuple) -> list | None:
        """Put ``(document, start, ids)`` away; the window's pieces if it is full now."""
        s = len(piece[2])
        h = self.choose(s)
        window = self.at[h].pop() if h else []
        window.append(piece)
        self.level[h] -= h > 0
        self.open += h == 0
        if h + s == self.size:
            self.open -= 1
            return window
        self.level[h + s] += 1
        self.at[h + s].append(window)
        return None

    def complete(self) -> Iterator[list]:
        """All open windows as full ones and sequences of powers of two: the emptiest are cut up to fill the fullest."""
        held = [(h, w) for h in range(self.size - 1, 0, -1) for w in self.at[h]]
        self.level[:], self.at, self.open = 0, [[] for _ in range(self.size + 1)], 0
        spare: list[tuple] = []
        lo, hi = 0, len(held)
        while lo < hi:
            h, window = held[lo]
            lo += 1
            gap = self.size - h
            while gap and (spare or lo < hi):
                if not spare:
                    hi -= 1
                    spare = held[hi][1][::-1]
                doc, start, ids = spare.pop()
                window.append((doc, start, ids[:gap]))
                if len(ids) > gap:
                    spare.append((doc, start + gap, ids[gap:]))
                gap -= len(window[-1][2])
            if not gap:
                yield window
            else:
                spare = window[::-1]
        rest = sum(len(p[2]) for p in spare)
        while rest:
            part, wanted = [], 1 << (rest.bit_length() - 1)
            rest -= wanted
            while wanted:
                doc, start, ids = spare.pop()
                part.append((doc, start, ids[:wanted]))
                if len(ids) > wanted:
                    spare.append((doc, start + wanted, ids[wanted:]))
                wanted -= len(part[-1][2])
            yield part


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = END_ID, most_open: int = MOST_OPEN) -> DataFrame:
    """``(doc_id, start, ids, doc_tokens, sequence_id, offset, sequence_tokens)``: where each piece of each document goes.

    A document is the ids of its text by the tokenizer in the file ``tokenizer``, then ``end_id``; a null or empty text
    is ``end_id`` alone. ``ids`` are little-endian unsigned 32-bit ids; ``start`` counts the document's ids before the
    piece, ``offset`` the sequence's. Full windows are cut off long documents; what is left goes to a window by
    ``SquarePacker``, whole. When a task ends, or holds ``most_open`` windows, the emptiest windows are cut up to fill
    the fullest, and what then is left becomes sequences whose lengths are powers of two; so every sequence has
    ``size`` tokens or a power of two, and no padding is needed.

    Each task packs the rows it reads, in their order, without a shuffle: a lost task is packed again alike. Repeated
    rows and rows without doc_id are documents of their own. Extra columns are left aside.
    """

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = WordTokens(tokenizer), SquarePacker(size)
        number = TaskContext.get().partitionId() * PER_TASK
        total: dict[int, tuple] = {}
        pieces: dict[int, int] = {}
        key = 0
        out: list[tuple] = []

        def emit(window: list) -> None:
            nonlocal number
            offset, tokens = 0, sum(len(p[2]) for p in window)
            for doc, start, ids in window:
                doc_id, length = total[doc]
                out.append((doc_id, start, ids.tobytes(), length, number, offset, tokens))
                offset += len(ids)
                pieces[doc] -= len(ids)
                if not pieces[doc]:
                    del pieces[doc], total[doc]
            number += 1

        def flush() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            done = pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], k) for c, k in enumerate(kinds)], ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens"])
            out.clear()
            return done

        for batch in gathered(slices(batches, ["body"], BLOCK), "body", BLOCK):
            ids, counts = encoder.encode(batch["body"].cast(pa.string()))
            at = 0
            for doc_id, n in zip(batch["doc_id"].to_pylist(), counts.tolist(), strict=True):
                doc = np.append(ids[at : at + n], np.uint32(end_id))
                at, n, key = at + n, n + 1, key + 1
                total[key], pieces[key] = (doc_id, n), n
                whole = n - n % size
                for start in range(0, whole, size):
                    emit([(key, start, doc[start : start + size])])
                if whole < n and (window := packer.place((key, whole, doc[whole:]))):
                    emit(window)
                if packer.open >= most_open:
                    for window in packer.complete():
                        emit(window)
                if len(out) >= 4096:
                    yield flush()
        for window in packer.complete():
            emit(window)
        yield flush()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    return map_arrow(texts, body, "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long")


def op12_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), str(public_tokenizers.path("byte_bpe_50k.json")))
    return found.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens")
