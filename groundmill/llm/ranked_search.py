"""Ranked lexical search: short lists summed term at a time, then one iterator among long lists document at a time."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from groundmill.llm.common import free, map_arrow, slices, sorted_groups, stored
from groundmill.llm.repeats import signed

#: Documents of a unit of the index, queries that meet it at once, and documents of a step of the walk through it.
UNIT, QUERIES, STEP = 8192, 2000, 1024
#: A list is short if it holds at most one document in this many of the unit.
SHORT = 16
#: Terms of no query are dropped by a bitmap of this many bits before they leave their task.
BITS = 1 << 22
#: Letters A-Z become small, all other ASCII characters but a-z and 0-9 end a term, all beyond ASCII belong to terms.
_table = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def block_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a block of texts (binary, no nulls): per text their number; then text, hash and count of each distinct term of a text."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = bytes(memoryview(texts.buffers()[2] or b"")[ends[0] : ends[-1]]).translate(_table)
    clean = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer((ends - ends[0]).astype(np.int64)), pa.py_buffer(data)])
    split = pc.split_pattern(clean, b" ")
    owner = np.repeat(np.arange(len(split), dtype=np.int64), np.diff(split.offsets.to_numpy()))
    words = split.flatten().dictionary_encode()
    names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    place = words.indices.to_numpy()
    full = np.array([bool(n) for n in names], bool)[place] if names else np.zeros(0, bool)
    owner, place = owner[full], place[full]
    hashes = np.fromiter(map(xxh3_64_intdigest, names), np.uint64, len(names))
    pairs = owner * len(names) + place
    pairs.sort()
    starts = np.flatnonzero(np.diff(pairs, prepend=-1))
    counts = np.diff(np.append(starts, len(pairs)))
    pairs = pairs[starts]
    return np.bincount(owner, minlength=len(texts)), pairs // max(len(names), 1), hashes[pairs % max(len(names), 1)] if names else hashes, counts


def _lists(owner: np.ndarray, rows: int, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)), values)


def _term_rows(df: DataFrame, key: str, bits: bytes | None = None) -> DataFrame:
    """``(id, n, terms, counts)`` per row: number of terms, distinct terms as hashes, how often each occurs."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = None if bits is None else np.frombuffer(bits, np.uint8)
        for batch in slices(batches, ["body"], 8 << 20):
            n, owner, terms, counts = block_terms(batch["body"])
            if told is not None:
                at = (terms & np.uint64(BITS - 1)).astype(np.int64)
                keep = (told[at >> 3] >> (at & 7) & 1).astype(bool)
                owner, terms, counts = owner[keep], terms[keep], counts[keep]
            rows = len(batch["body"])
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(n, pa.int64()), _lists(owner, rows, pa.array(signed(terms))), _lists(owner, rows, pa.array(counts, pa.int64()))], ["id", "n", "terms", "counts"])

    texts = df.select(F.col(key).cast("long").alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    return map_arrow(texts, body, "id long, n long, terms array<long>, counts array<long>")


def _document_counts(index: DataFrame) -> DataFrame:
    """``(term, df)``: in how many documents each term stands; tasks count their own rows first."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, n = np.unique(batch["terms"].flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(n, pa.int64())], ["term", "df"])

    return map_arrow(index.select("terms"), body, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def best_of_unit(lists: list[tuple[np.ndarray, np.ndarray, int]], size: int, k: int, short: int = SHORT, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents of 0..size-1 and their scores, best first, equal ones by place.

    ``lists`` has each term's documents, ascending, what the term adds to each (above zero), and the most it adds.

    Short lists are summed term at a time into accumulators, which from there on are one list among the others, bounded
    by their largest sum. Then documents are taken in order, a step at a time. Lists stand by rising bound; those whose
    bounds sum up to no more than the score to beat cannot bring a document in by themselves, so only documents of the
    other lists are looked at, and the long ones among the rest are skipped to those places: the one of highest bound
    first, and each only for documents that can still win.
    """
    few = [x for x in lists if len(x[0]) * short <= size]
    rest = [x for x in lists if len(x[0]) * short > size]
    floor = 0
    if few:
        held = np.zeros(size, np.int64)
        for docs, adds, _ in few:
            held[docs] += adds
        docs = np.flatnonzero(held)
        sums = held[docs]
        if len(sums) >= k:
            floor = int(np.partition(sums, -k)[-k]) - 1  # ties may still enter
        rest.append((docs, sums, int(sums.max())))
    rest.sort(key=lambda x: x[2])
    bound = np.cumsum([x[2] for x in rest])
    edges = np.arange(0, size + step, step)
    cuts = [np.searchsorted(x[0], edges) for x in rest]
    top_docs, top = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in range(len(edges) - 1):
        beat = int(top[-1]) if len(top) == k else 0
        beat = max(beat, floor)
        lead = int(np.searchsorted(bound, beat, side="right"))
        if lead == len(rest):
            if len(top) == k and beat == top[-1]:
                break  # nothing later can enter
            continue
        low = int(edges[b])
        score = np.zeros(step, np.int64)
        for (docs, adds, _), cut in zip(rest[lead:], cuts[lead:], strict=True):
            score[docs[cut[b] : cut[b + 1]] - low] += adds[cut[b] : cut[b + 1]]
        found = np.flatnonzero(score)
        score = score[found]
        for i in range(lead - 1, -1, -1):
            can = score + bound[i] > beat
            found, score = found[can], score[can]
            if not len(found):
                break
            docs, adds, _ = rest[i]
            part = slice(cuts[i][b], cuts[i][b + 1])
            docs, adds = docs[part], adds[part]
            if len(docs):
                at = np.minimum(np.searchsorted(docs, found + low), len(docs) - 1)
                score = score + np.where(docs[at] == found + low, adds[at], 0)
        won = score > beat
        if won.any():
            docs, scores = np.concatenate([top_docs, found[won] + low]), np.concatenate([top, score[won]])
            order = np.lexsort((docs, -scores))[:k]
            top_docs, top = docs[order], scores[order]
    return top_docs, top


def _search_unit(table: pa.Table, documents: int, length: int, k: int) -> pa.RecordBatch:
    """The ``k`` best documents of one unit for each of its queries."""
    asked, rows = table.filter(pc.equal(table["kind"], 0)).combine_chunks(), table.filter(pc.equal(table["kind"], 1)).combine_chunks()
    ids = rows["id"]
    order = pc.sort_indices(pa.table({"id": ids}), sort_keys=[("id", "ascending")], null_placement="at_end")
    rows = rows.take(order)
    names = rows["id"].to_pylist()

    def flat(t: pa.Table, c: str) -> np.ndarray:
        return t[c].combine_chunks().flatten().to_numpy() if t.num_rows else np.zeros(0, np.int64)

    def sizes(t: pa.Table) -> np.ndarray:
        return np.diff(t["terms"].combine_chunks().offsets.to_numpy()) if t.num_rows else np.zeros(0, np.int64)

    vocabulary, first = np.unique(flat(asked, "terms"), return_index=True)
    weights = np.array([weight(documents, d) for d in flat(asked, "dfs")[first].tolist()], np.int64)
    terms, counts = flat(rows, "terms"), flat(rows, "counts")
    doc = np.repeat(np.arange(rows.num_rows), sizes(rows))
    at = np.minimum(np.searchsorted(vocabulary, terms), max(len(vocabulary) - 1, 0))
    known = vocabulary[at] == terms if len(vocabulary) else np.zeros(len(terms), bool)
    at, doc, counts = at[known], doc[known], counts[known]
    by_term = np.argsort(at, kind="stable")
    at, doc, counts = at[by_term], doc[by_term], counts[by_term]
    n = rows["n"].to_numpy()
    norm = 25 + (75 * n * documents) // max(length, 1)
    adds = weights[at] * ((1_000_000_000 * counts) // (1000 * counts + 8 * norm[doc])) if len(at) else counts
    some = adds > 0
    at, doc, adds = at[some], doc[some], adds[some]
    ends = np.searchsorted(at, np.arange(len(vocabulary) + 1))
    most = np.zeros(len(vocabulary), np.int64)
    held = np.flatnonzero(np.diff(ends))
    if len(held):
        most[held] = np.maximum.reduceat(adds, ends[held])
    out: list[tuple] = []
    wanted = np.searchsorted(vocabulary, flat(asked, "terms"))
    times = flat(asked, "counts")
    stops = np.concatenate([[0], np.cumsum(sizes(asked))])
    for q, name in enumerate(asked["id"].to_pylist()):
        lists = []
        for t, c in zip(wanted[stops[q] : stops[q + 1]].tolist(), times[stops[q] : stops[q + 1]].tolist(), strict=True):
            if most[t]:
                lists.append((doc[ends[t] : ends[t + 1]], adds[ends[t] : ends[t + 1]] * c, int(most[t]) * c))
        if lists:
            docs, scores = best_of_unit(lists, rows.num_rows, k)
            out += [(name, names[d], s) for d, s in zip(docs.tolist(), scores.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], ["item_id", "doc_id", "score"])


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, unit: int = UNIT, queries: int = QUERIES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` documents of highest score above 0, best first, ties by doc_id.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. N documents have
    a term, L is the number of all their terms, n a document's, df the documents that hold a term, tf its occurrences
    in one. A term weighs ``floor(1000 ln((2N + 2) / (2df + 1)))`` and adds that, times its occurrences in the item,
    times ``10^9 tf div (1000 tf + 8 (25 + 75 n N div L))``.

    1. Tasks split whole texts into terms, known by 64-bit hashes (a false match among a billion terms and a hundred
       thousand query terms has probability below 1e-5), and keep those that a bitmap of fixed size has from the items.
    2. Counts over all documents give N, L and df.
    3. Documents are dealt by hash into units of about ``unit``; blocks of ``queries`` items meet every unit, by
       shuffle. A unit builds its lists and answers each query by ``best_of_unit``, which is exact.
    4. The best of units meet in two steps, so that no task sees all units' rows of an item.

    Null or empty texts have no terms. Distinct rows of one item_id act as one item with the terms of all, rows
    without item_id too. Equal rows of documents, and rows without doc_id (last among ties), are ranked each. Extra columns are left aside.
    """
    spark = docs.sparkSession
    asked = stored(_term_rows(items.select("item_id", "text").distinct(), "item_id").select("id", F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("id", F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("times")))
    place = F.col("term").bitwiseAND(F.lit(BITS - 1)) + 1
    maps = asked.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).toArrow().to_pylist()
    bits = bytearray(BITS // 8)  # BITS / 32768 rows of 4096 bytes at most
    for r in maps:
        bits[(r["b"] - 1) * 4096 : r["b"] * 4096] = r["bits"]
    index = stored(_term_rows(docs, "doc_id", bytes(bits)))
    documents, length = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0)).cast("long")).first()
    found = asked.join(_document_counts(index), "term")
    packed = found.groupBy("id").agg(F.collect_list(F.struct("term", "times", "df")).alias("t")).select("id", F.col("t.term").alias("terms"), F.col("t.times").alias("counts"), F.col("t.df").alias("dfs"))
    units, blocks = max(1, -(-documents // unit)), max(1, -(-packed.count() // queries))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    none = F.array().cast("array<bigint>")
    asking = packed.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("u", numbers(units)).select((F.col("u") * blocks + F.col("block")).alias("unit"), F.lit(0).alias("kind"), "id", F.lit(0).cast("long").alias("n"), "terms", "counts", "dfs")
    holding = index.where(F.size("terms") > 0).withColumn("b", numbers(blocks)).select((F.pmod(F.xxhash64("id", "n", "terms"), F.lit(units)) * blocks + F.col("b")).alias("unit"), F.lit(1).alias("kind"), "id", "n", "terms", "counts", none.alias("dfs"))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "unit"):
            number = table["unit"].to_numpy()
            starts = np.append(np.flatnonzero(np.diff(number, prepend=number[0] - 1)), len(number))
            for lo, hi in zip(starts, starts[1:], strict=False):
                yield _search_unit(table.slice(lo, hi - lo), documents, length, k)

    parts = max(units * blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = asking.unionByName(holding).repartition(parts, "unit").sortWithinPartitions("unit")
    best = map_arrow(dealt, body, "item_id long, doc_id long, score long")
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    some = best.withColumn("part", F.spark_partition_id() % 512).withColumn("r", rank("item_id", "part")).where(F.col("r") <= k)
    out = stored(some.withColumn("rank", rank("item_id")).where(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    free(index, asked)
    return out


def op13_ranked_search(spark, sf_dir: str) -> DataFrame:
    return rank_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS all_docs, sum(len(w))::BIGINT AS all_terms FROM words),
tf AS (SELECT doc_id, len(w)::BIGINT AS n, t, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS t FROM words) GROUP BY doc_id, w, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
asked AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
  GROUP BY item_id, t),
scored AS (
  SELECT item_id, doc_id,
    sum(times * CAST(floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms))))::BIGINT AS score
  FROM asked JOIN tf USING (t) JOIN df USING (t) CROSS JOIN totals GROUP BY item_id, doc_id)
SELECT item_id, CAST(r AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scored WHERE score > 0) WHERE r <= 10
"""
