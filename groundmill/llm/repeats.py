"""Repeated windows: anchors that find where they can be, and spans that say what goes.

Both substring operators look for windows of a fixed length that occur twice. Most windows occur once, so a first
pass keeps one short gram per stretch of windows, the window's smallest gram by hash. Equal windows have equal
smallest grams, so a window whose gram occurs once in the corpus occurs once itself and needs no further look.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundmill.llm.common import free, map_arrow, slices, split_join, stored

BASE, OTHER_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Positions are held in 24 bits beside 40 bits of hash; longer texts are taken in pieces.
PIECE = 1 << 23
PLACE_BITS = np.uint64((1 << 24) - 1)
#: Grams are counted in this many slices of their hashes, one after another, which divides the disk it takes.
SLICES = 3

_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(base: int, size: int, inverse: bool) -> np.ndarray:
    have = _powers.get((base, inverse))
    if have is None or len(have) < size:
        step = pow(base, -1, 1 << 64) if inverse else base
        have = np.full(max(size, 1 << 16), step, np.uint64)
        have[0] = 1
        _powers[base, inverse] = have = np.multiply.accumulate(have)
    return have[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def rolling(units: np.ndarray, length: int, base: int = BASE) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2^64, of every run of ``length`` units."""
    n = len(units) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * _power(base, len(units), False), out=sums[1:])
    return mixed((sums[length:] - sums[:n]) * _power(base, n, True))


def anchors(units: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(place, hash, first, last)`` of each stretch of windows first..last whose smallest gram starts at ``place``."""
    found = []
    for at in range(0, max(len(units) - window + 1, 0), PIECE):
        part = units[at : at + PIECE + window - 1]
        grams = rolling(part, gram)
        low = (grams & ~PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
        span, width = 1, window - gram + 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
        place = (low & PLACE_BITS).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        found.append((place[first] + at, grams[place[first]], first + at, last + at))
    if not found:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def keyed(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, part, body)``: texts as UTF-8 bytes, null as none; ``part`` tells several texts of one doc_id apart."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select("doc_id", F.hash(body).alias("part"), body.alias("body"), *carry)


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    sizes = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate([*values, np.zeros(0)]).astype(kind.to_pandas_dtype(), copy=False), kind))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def anchored(docs: DataFrame, units: Callable[[bytes], np.ndarray], gram: int, window: int) -> DataFrame:
    """``(doc_id, part, digest, anchors, places)`` of every document that holds a window; stored."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ["body"]):
            keep, hashes, places = [], [], []
            for i, text in enumerate(batch["body"]):
                u = units(text.as_py())
                if len(u) >= window:
                    place, value, _, _ = anchors(u, gram, window)
                    keep.append(i)
                    hashes.append(signed(value))
                    places.append(place)
            some = batch.select(["doc_id", "part", "digest"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*some.columns, lists(hashes, pa.int64()), lists(places, pa.int32())], ["doc_id", "part", "digest", "anchors", "places"])

    return stored(map_arrow(keyed(docs).where("doc_id IS NOT NULL").withColumn("digest", F.unhex(F.md5("body"))), body, "doc_id long, part int, digest binary, anchors array<long>, places array<int>"))


def originals(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first document of each group of exact copies, and the later ones."""
    firsts = found.groupBy("digest").agg(F.min("doc_id").alias("first"))
    both = found.join(firsts.hint("merge"), "digest")
    return both.where("doc_id = first").drop("first", "digest").dropDuplicates(["doc_id", "part"]), both.where("doc_id > first").select("doc_id", "part").distinct()


def live_places(first: DataFrame, across: bool) -> DataFrame:
    """``(doc_id, part, live)``: the places of grams that occur twice; ``across``: in two documents. Stored."""
    seen = first.select("doc_id", "part", F.explode(F.arrays_zip("anchors", "places")).alias("x")).select("doc_id", "part", F.col("x.anchors").alias("anchor"), F.col("x.places").alias("place"))
    twice = F.min("doc_id") < F.max("doc_id") if across else F.count("*") > 1
    found = []
    for k in range(SLICES):
        some = seen.where(F.pmod("anchor", F.lit(SLICES)) == k)
        live = some.groupBy("anchor").agg(twice.alias("twice")).where("twice").select("anchor")
        found.append(stored(split_join(some, live, ["anchor"]).select("doc_id", "part", "place")))
    every = reduce(DataFrame.unionByName, found)
    out = stored(every.groupBy("doc_id", "part").agg(F.collect_list("place").alias("live")))
    free(*found)
    return out


def merged(spans: DataFrame) -> DataFrame:
    """``(doc_id, part, spans)`` from rows ``(doc_id, part, start, end)``: overlapping and touching ones become one."""
    order = Window.partitionBy("doc_id", "part").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("opens", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("run", F.sum("opens").over(order))
    whole = runs.groupBy("doc_id", "part", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.groupBy("doc_id", "part").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def spans_removed(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
