"""Suffix-array dedup: suffixes sorted bucket by bucket, long ties resolved by the ranks of a difference cover."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.llm import repeats
from groundmill.llm.common import free, map_arrow, slices, sorted_groups, stored

#: Any two residues modulo PERIOD have a shift below PERIOD that takes both into COVER.
PERIOD, COVER = 7, (0, 1, 3)
#: Bytes of text that are sorted at once.
BUCKET = 4 << 20
#: An anchor with more distinct surroundings than this is cut into single windows, each with a bucket key of its own.
CROWD = 20_000

_bytes = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_units(text: bytes) -> np.ndarray:
    return _bytes[np.frombuffer(text, np.uint8)]


def _shift(r: int, s: int) -> int:
    return next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER and (s + d) % PERIOD in COVER)


def _heads(text: np.ndarray) -> np.ndarray:
    """The PERIOD bytes from every place, as one number."""
    padded = np.concatenate([text, np.zeros(PERIOD, np.uint8)]).astype(np.uint64)
    heads = np.zeros(len(text), np.uint64)
    for k in range(PERIOD):
        heads = (heads << np.uint64(8)) | padded[k : k + len(text)]
    return heads


def cover_ranks(heads: np.ndarray, depth: int) -> np.ndarray:
    """For each place in the cover, the rank of what follows it, compared over at least ``depth`` bytes; by doubling."""
    size = len(heads)
    places = np.flatnonzero(np.isin(np.arange(size) % PERIOD, COVER))
    _, rank = np.unique(heads[places], return_inverse=True)
    ranks, known = np.zeros(size, np.int64), PERIOD
    while True:
        ranks[places] = rank + 1
        if known >= depth or rank.max(initial=0) + 1 == len(places):
            return ranks
        ahead = places + known
        after = np.where(ahead < size, ranks[np.minimum(ahead, size - 1)], 0)
        _, rank = np.unique(ranks[places] * (len(places) + 2) + after, return_inverse=True)
        known *= 2


def sort_suffixes(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in suffix order, as far as ``depth`` bytes tell; equal ones stay together.

    Suffixes are sorted by their first PERIOD bytes. Those that tie fall into PERIOD residue classes. Two suffixes of
    classes r and s compare by the ranks of the cover places at one shift from both, so a class is sorted by the
    ranks at its own shift, and a suffix's place among the others is found by bisection in each other class.
    """
    heads = _heads(text)
    _, group = np.unique(heads[starts], return_inverse=True)
    crowd = np.bincount(group)
    place = (np.cumsum(crowd) - crowd)[group]
    tied = np.flatnonzero(crowd[group] > 1)
    if len(tied):
        ranks = cover_ranks(heads, depth)
        ranks = np.concatenate([ranks, np.zeros(2 * PERIOD, np.int64)])
        wide = int(ranks.max()) + 2
        classes = [tied[starts[tied] % PERIOD == r] for r in range(PERIOD)]
        key = lambda of, d: group[of] * wide + ranks[starts[of] + d]
        classes = [c[np.argsort(key(c, _shift(r, r)))] for r, c in enumerate(classes)]
        keys = {(r, d): key(c, d) for r, c in enumerate(classes) for d in {_shift(r, s) for s in range(PERIOD)}}
        lows = [group[c] * wide for c in classes]
        for r, mine in enumerate(classes):
            for s, other in enumerate(classes):
                if len(mine) and len(other):
                    d = _shift(r, s)
                    others = np.maximum.accumulate(keys[s, d])
                    place[mine] += np.searchsorted(others, keys[r, d]) - np.searchsorted(others, lows[r])
    return np.argsort(place)


def repeated(text: np.ndarray, starts: np.ndarray, order: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows at ``starts`` have an equal one of smaller ``order``."""
    by = sort_suffixes(text, starts, window)
    at, heads = starts[by], _heads(text)
    same = np.ones(len(at) - 1, bool)
    for k in [*range(0, window - PERIOD, PERIOD), window - PERIOD]:
        same &= heads[at[1:] + k] == heads[at[:-1] + k]
    group = np.concatenate([[0], np.cumsum(~same)])
    least = np.minimum.reduceat(order[by], np.flatnonzero(np.diff(group, prepend=-1)))
    out = np.zeros(len(starts), bool)
    out[by] = order[by] > least[group]
    return out


def _bucket_spans(docs: np.ndarray, begins: np.ndarray, texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans, as (row, start, end), of the surroundings in one bucket whose windows start earlier elsewhere in it."""
    sizes = np.array([len(t) for t in texts])
    text = np.frombuffer(b"".join(texts), np.uint8)
    counts = sizes - window + 1
    row = np.repeat(np.arange(len(texts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    where = begins[row] + inner
    order = np.empty(len(row), np.int64)
    order[np.lexsort((where, docs[row]))] = np.arange(len(row))
    # One window of one document may stand in two rows; it must not count as its own repeat.
    sorted_by = np.argsort(order)
    fresh = np.concatenate([[True], (np.diff(docs[row][sorted_by]) != 0) | (np.diff(where[sorted_by]) != 0)])
    order[sorted_by] = np.cumsum(fresh)
    hit = repeated(text, (np.cumsum(sizes) - sizes)[row] + inner, order, window)
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    breaks = np.flatnonzero(np.diff(row)) + 1
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    if len(breaks) and len(first):  # runs end where their row ends
        inside = breaks[(hit[breaks]) & (hit[breaks - 1])]
        first, last = np.sort(np.concatenate([first, inside])), np.sort(np.concatenate([last, inside - 1]))
    return row[first], where[first], where[last] + window


def repeated_bytes(docs: DataFrame, window: int = 100, gram: int = 24) -> DataFrame:
    """``(doc_id, part, spans)``: byte ranges covered by ``window``-byte strings that also start earlier.

    Exact copies are settled by digest. Stretches of windows around a gram that occurs twice are cut out with their
    surroundings; equal surroundings of one gram count once, at their first place. The rest are dealt out by gram,
    so that equal windows meet, and each task sorts its suffixes bucket by bucket, whole grams at a time.
    """
    found = repeats.anchored(docs, byte_units, gram, window)
    first, later = repeats.originals(found)
    later = stored(later)
    places = repeats.live_places(first, across=False)
    free(found)
    texts = repeats.keyed(docs).where("doc_id IS NOT NULL").join(places.hint("merge"), ["doc_id", "part"]).select("doc_id", "part", "body", "live")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ["body"], 4 << 20):
            rows, grams, begins, pieces = [], [], [], []
            for i, (text, live) in enumerate(zip(batch["body"], batch["live"], strict=True)):
                data = text.as_py()
                place, value, begin, end = repeats.anchors(byte_units(data), gram, window)
                held = np.isin(place, live.values.to_numpy())
                rows.append(np.full(held.sum(), i))
                grams.append(value[held])
                begins.append(begin[held])
                pieces += [data[b : e + window] for b, e in zip(begin[held].tolist(), end[held].tolist(), strict=True)]
            at = pa.array(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64))
            cols = [batch["doc_id"].take(at), batch["part"].take(at), pa.array(repeats.signed(np.concatenate([*grams, np.zeros(0, np.uint64)]))), pa.array(np.concatenate([*begins, np.zeros(0, np.int64)]).astype(np.int64)), pa.array(pieces, pa.binary())]
            for part in pa.Table.from_arrays(cols, ["doc_id", "part", "anchor", "start", "piece"]).to_batches(max_chunksize=20_000):
                yield part

    cut_out = map_arrow(texts, cut, "doc_id long, part int, anchor long, start long, piece binary")
    pieces = stored(cut_out.withColumn("digest", F.xxhash64("piece", F.lit(1))).withColumn("size", F.length("piece")))
    free(places)
    whole = later.select("doc_id", "part", F.lit(0).cast("long").alias("start"), F.lit(1 << 40).cast("long").alias("end"))
    # Both are tables, so that Spark can split the join where one gram has many surroundings.
    firsts = stored(pieces.groupBy("anchor", "digest").agg(F.min(F.struct("doc_id", "start")).alias("at")))
    counts = stored(firsts.groupBy("anchor").count())
    # Counts come in before the pieces do, so the pieces' bytes are shuffled once to meet them and once by gram.
    same = stored(firsts.join(counts.hint("merge"), "anchor"))
    free(firsts, counts)
    again = pieces.drop("piece").join(same.hint("merge"), ["anchor", "digest"]).where("struct(doc_id, start) <> at").select("doc_id", "part", "start", (F.col("start") + F.col("size")).alias("end"))
    met = pieces.join(same.where("count > 1").hint("merge"), ["anchor", "digest"]).where("struct(doc_id, start) = at").select("doc_id", "part", "anchor", "start", "piece", "count")
    crowd = met.where(F.col("count") > CROWD).select("doc_id", "part", F.col("start").alias("from"), "piece", F.explode(F.sequence(F.lit(0), F.length("piece") - window)).alias("k"))
    single = crowd.select("doc_id", "part", (F.col("from") + F.col("k")).alias("start"), F.expr(f"substring(piece, k + 1, {window})").alias("piece")).withColumn("anchor", F.xxhash64("piece"))
    dealt = met.where(F.col("count") <= CROWD).select("doc_id", "part", "anchor", "start", "piece").unionByName(single)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _sized(sorted_groups(batches, "anchor")):
            joined = table.combine_chunks()
            row, start, end = _bucket_spans(joined["doc_id"].to_numpy(), joined["start"].to_numpy(), joined["piece"].to_pylist(), window)
            at = pa.array(row)
            out = pa.Table.from_arrays([joined["doc_id"].take(at), joined["part"].take(at), pa.array(start), pa.array(end)], ["doc_id", "part", "start", "end"])
            yield from out.combine_chunks().to_batches()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "anchor").sortWithinPartitions("anchor")
    found = map_arrow(ordered, sort, "doc_id long, part int, start long, end long")
    return stored(repeats.merged(found.unionByName(again).unionByName(whole)))


def _sized(tables: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """Tables of whole groups joined up to BUCKET bytes of text."""
    held: list[pa.Table] = []
    size = 0
    for table in tables:
        held.append(table)
        size += table["piece"].nbytes
        if size >= BUCKET:
            yield pa.concat_tables(held)
            held, size = [], 0
    if held:
        yield pa.concat_tables(held)


def drop_repeated_bytes(docs: DataFrame, window: int = 100, gram: int = 24, carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """``(doc_id, *carry, n_bytes, n_removed, spans, kept)``: texts, as UTF-8 bytes, without what starts earlier elsewhere.

    ``spans`` are the maximal removed runs, ``kept`` the bytes left: binary, since a run may cut a character, or as
    a string without such characters if ``as_text``. Columns named in ``carry`` come along. A null text
    is empty; texts shorter than the window lose nothing; rows without doc_id lose nothing and count nowhere; equal
    rows share their result; several texts of one doc_id are each taken for themselves.
    """
    spans = repeated_bytes(docs, window, gram)
    joined = repeats.keyed(docs, carry).join(spans.hint("merge"), ["doc_id", "part"], "left").select("doc_id", *carry, "body", "spans")
    kinds = dict(docs.dtypes)
    names = ["doc_id", *carry, "n_bytes", "n_removed", "spans", "kept"]

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ["body"]):
            kept, cut = [], []
            for text, spans in zip(batch["body"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                runs = [(s["start"], min(s["end"], len(text))) for s in spans or ()]
                ends = [0, *(e for _, e in runs)]
                kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(s for s, _ in runs), len(text)], strict=True)))
                cut.append([{"start": s, "end": e} for s, e in runs])
            sizes = pa.array([len(t) for t in batch["body"].to_pylist()], pa.int64())
            gone = pa.array([sum(s["end"] - s["start"] for s in c) for c in cut], pa.int64())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            left = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", *carry)), sizes, gone, pa.array(cut, kind), left], names)

    came = "".join(f"{c} {kinds[c]}, " for c in carry)
    return map_arrow(joined, body, f"doc_id long, {came}n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept {'string' if as_text else 'binary'}")


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
