"""MinHash near-dedup: a multi-index Hamming join over b-bit signatures, and exact links inside candidate clusters."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from groundmill.llm.common import connected_components, join_labels, map_arrow, slices, sorted_groups, split_join, stored
from groundmill.llm.repeats import mixed, signed

#: A signature has HASHES values of 16 bits in CHUNKS chunks. If two differ in fewer than CHUNKS * (ERRORS + 1) values,
#: some chunk differs in at most ERRORS; so a key for each way to leave ERRORS values of a chunk out finds the pair.
HASHES, CHUNKS, ERRORS = 64, 16, 1
DISTANCE = CHUNKS * (ERRORS + 1) - 1
WIDTH = HASHES // CHUNKS
SUBSETS = list(combinations(range(WIDTH), WIDTH - ERRORS))
#: Rows of one key, and sets of one cluster, that one task compares at once.
ROWS, SETS = 1024, 256

_rng = np.random.default_rng(20240501)
_factors = _rng.integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_key_factors = _rng.integers(1, 1 << 62, (CHUNKS, WIDTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, length: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``length``-word shingles of the text, A-Z in lower case.

    Fewer words make one shingle of them all; none make none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    units = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if len(units) < length:
        return np.array([xxh3_64_intdigest(b" ".join(words))], np.uint64)
    n = len(units) - length + 1
    value = np.zeros(n, np.uint64)
    for k in range(length):
        value = mixed(value + units[k : k + n])
    return np.unique(value)


def signature(values: np.ndarray) -> np.ndarray:
    """The low 16 bits of each of HASHES minima."""
    out = np.full(HASHES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(values), 4096):
        np.minimum(out, (values[at : at + 4096, None] * _factors).min(axis=0), out=out)
    return ((out >> np.uint64(20)) & np.uint64(0xFFFF)).astype(np.uint16)


def signature_keys(signatures: np.ndarray) -> np.ndarray:
    """A row of keys per signature: one for each chunk and choice of the values left out."""
    parts = signatures.reshape(-1, CHUNKS, WIDTH).astype(np.uint64) + np.uint64(1)
    keys = [mixed((parts[:, :, list(s)] * _key_factors[:, list(s)]).sum(axis=2, dtype=np.uint64) + np.uint64(i + 1) * _key_factors[:, 0]) for i, s in enumerate(SUBSETS)]
    return np.concatenate(keys, axis=1)


def text_hash(docs: DataFrame) -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def _sketched(docs: DataFrame, length: int) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, digest, signature)`` for each row; stored. ``digest`` tells equal shingle sets."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ["body"]):
            sizes, digests, marks = [], [], []
            for text in batch["body"].to_pylist():
                values = shingles(text, length)
                sizes.append(len(values))
                digests.append(xxh3_128_digest(values.tobytes()))
                marks.append(signature(values).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(marks, pa.binary())], ["doc_id", "text_hash", "n_shingles", "digest", "signature"])

    texts = docs.select("doc_id", text_hash(docs).alias("text_hash"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    return stored(map_arrow(texts, body, "doc_id long, text_hash long, n_shingles long, digest binary, signature binary"))


def _keys(reps: DataFrame) -> DataFrame:
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = signature_keys(np.frombuffer(b"".join(batch["signature"].to_pylist()), np.uint16).reshape(-1, HASHES))
                ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * keys.shape[1])
                yield pa.RecordBatch.from_arrays([batch["digest"], pa.ListArray.from_arrays(ends, pa.array(signed(keys.ravel())))], ["digest", "keys"])

    return map_arrow(reps.select("digest", "signature"), body, "digest binary, keys array<long>").select("digest", F.explode("keys").alias("key"))


def _cells(rows: DataFrame, count: str, most: int, key: str, node: str) -> DataFrame:
    """``rows`` dealt into cells of at most about two blocks of ``most`` rows, so that any two rows of a key meet in one.

    A key of one block is one cell; a larger one has a cell for each pair of its blocks.
    """
    blocks = F.ceil(F.col(count) / F.lit(most)).cast("int")
    own = F.pmod(F.xxhash64(node), F.col("blocks")).cast("int")
    cut = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    named = F.xxhash64(key, F.least("own", "other"), F.greatest("own", "other"))
    return cut.withColumn("cell", named).drop("blocks", "own", "other", count)


def _near_signatures(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges, as row numbers, that connect the rows of each cell whose signatures are within DISTANCE and whose set sizes allow a link."""
    cell, sizes = table["cell"].to_numpy(), table["n_shingles"].to_numpy()
    marks = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(-1, HASHES)
    found_a, found_b = [], []
    for step in range(1, len(cell)):
        a = np.flatnonzero(cell[step:] == cell[:-step])
        if not len(a):
            break
        b = a + step
        fits = np.minimum(sizes[a], sizes[b]) * 100 >= percent * np.maximum(sizes[a], sizes[b])
        a, b = a[fits], b[fits]
        near = (marks[a] != marks[b]).sum(axis=1) <= DISTANCE
        found_a.append(a[near])
        found_b.append(b[near])
    a, b = np.concatenate([*found_a, np.zeros(0, np.int64)]).astype(int), np.concatenate([*found_b, np.zeros(0, np.int64)]).astype(int)
    label = join_labels(len(cell), a, b)
    moved = np.flatnonzero(label != np.arange(len(cell)))
    return moved, label[moved]


def _edges(rows: DataFrame, find, columns: list[str]) -> DataFrame:
    """``(a, b)``, digests of the rows that ``find`` pairs in the tables of whole cells of ``rows``."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "cell"):
            nodes = table["digest"].combine_chunks()
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(x)) for x in find(table)], ["a", "b"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("cell", *columns).repartition(parts, "cell").sortWithinPartitions("cell")
    return map_arrow(dealt, body, "a binary, b binary")


def _linked(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges, as row numbers, that connect the sets of each cell with ``100 * intersection >= percent * union``, counted on whole sets."""
    cell = table["cell"].to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
    starts = np.append(np.flatnonzero(np.diff(cell, prepend=cell[0] - 1)), len(cell))
    out_a, out_b = [], []
    for lo, hi in zip(starts, starts[1:], strict=False):
        sizes = np.array([len(s) for s in sets[lo:hi]])
        every, ids = np.unique(np.concatenate(sets[lo:hi]), return_inverse=True)
        ends = np.cumsum(sizes)
        held = np.zeros(len(every), np.int32)
        a, b = [], []
        for i in range(hi - lo - 1):
            mine = ids[ends[i] - sizes[i] : ends[i]]
            held[mine] = 1
            common = np.add.reduceat(held[ids[ends[i] :]], (ends[i:-1] - ends[i]))
            held[mine] = 0
            j = np.flatnonzero(common * (100 + percent) >= percent * (sizes[i] + sizes[i + 1 :])) + i + 1
            a.append(np.full(len(j), i))
            b.append(j)
        if a:
            label = join_labels(hi - lo, np.concatenate(a), np.concatenate(b))
            moved = np.flatnonzero(label != np.arange(hi - lo))
            out_a.append(lo + moved)
            out_b.append(lo + label[moved])
    return np.concatenate([*out_a, np.zeros(0)]).astype(np.int64), np.concatenate([*out_b, np.zeros(0)]).astype(np.int64)


def near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, component_id)``: each document's group of near duplicates, named by its smallest doc_id.

    Documents link if ``100 * |A and B| >= percent * |A or B|`` for their sets of ``length``-word shingles.

    1. Documents of one set are one class from here on, so exact copies cost one row.
    2. The multi-index Hamming join: every class has a key for each chunk of its signature and each choice of values
       allowed to be wrong; any two signatures within DISTANCE share a key. Where a key has several classes, blocks of
       them compare whole signatures, and yield a few edges that connect what is within DISTANCE.
    3. Connected, these give candidate clusters that hold every pair the join guarantees. Whole shingle sets go to
       their cluster, block against block, and exact counts give the links; their components are the answer.
    No step lists the pairs of a group: each block passes on at most one edge per row.

    For two sets of similarity 0.8 each of the 64 values differs with probability 0.2 at most, so the distance
    exceeds 31 with probability below 1e-6; more similar pairs are safer still.

    Empty documents (null, blank) have no shingles and are their own component. Graph nodes are shingle sets, so each
    of several texts under one doc_id has the group of its own set, told apart by ``text_hash``; groups are named
    once they are known. Rows of one doc_id and equal text act as one. Rows without doc_id are returned with a null
    component and link with nothing.
    """
    sketched = _sketched(docs, length)
    named = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    # The smallest doc_id of a set, and one text under it, stand for the set.
    reps = stored(named.groupBy("digest").agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("signature").alias("signature")))
    keys = _keys(reps)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    meeting = keys.join(shared, "key").join(reps.drop("least"), "digest")
    near = _edges(_cells(meeting, "n", ROWS, "key", "digest"), lambda t: _near_signatures(t, percent), ["digest", "n_shingles", "signature"])
    clusters = stored(connected_components(near))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ["body"]):
            found = [shingles(t, length).tobytes() for t in batch["body"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["digest"], batch["cluster"], batch["n"], pa.array(found, pa.binary())], ["digest", "cluster", "n", "shingles"])

    sized = clusters.groupBy("component").count().select(F.col("component").alias("cluster"), F.col("count").alias("n"))
    members = clusters.join(sized, F.col("component") == F.col("cluster")).select(F.col("node").alias("digest"), "cluster", "n")
    wanted = members.join(reps, "digest").select("digest", "cluster", "n", "least.doc_id", "least.text_hash")
    texts = docs.select("doc_id", text_hash(docs).alias("text_hash"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    filled = map_arrow(texts.join(wanted.hint("merge"), ["doc_id", "text_hash"]), sets, "digest binary, cluster binary, n long, shingles binary")
    links = stored(connected_components(_edges(_cells(filled, "n", SETS, "cluster", "digest"), lambda t: _linked(t, percent), ["digest", "shingles"])))

    own = reps.select("digest", F.col("least.doc_id").alias("rep"))
    linked = links.join(own, F.col("node") == F.col("digest")).select("digest", "component", "rep")
    groups = split_join(linked, linked.groupBy("component").agg(F.min("rep").alias("component_id")), ["component"]).select("digest", "component_id")
    placed = own.join(groups, "digest", "left").select("digest", F.coalesce("component_id", "rep").alias("component_id"))
    return sketched.join(placed, "digest", "left").select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def op2_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs, length=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
numbered AS (SELECT doc_id, n, hash(g) AS g FROM grams),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM numbered a JOIN numbered b ON a.g = b.g AND a.doc_id < b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
sym AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(d, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT sym.b, reach.c FROM reach JOIN sym ON reach.d = sym.a WHERE reach.c < sym.b),
least_of AS (SELECT d, min(c) AS c FROM reach GROUP BY d)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, l.c AS component_id, s.doc_id = l.c AS kept FROM sets s JOIN least_of l ON l.d = s.doc_id
"""
