"""Approximate nearest neighbours by additive quantisation, lookup-table scores and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundmill.llm.common import map_arrow, stored
from groundmill.llm.vectors import matrix, sample, usable, width_of

#: Codebooks, codewords of each, and partial sums that the encoder keeps.
BOOKS, WORDS, BEAM = 16, 256, 4
#: The codebooks are fitted on at most this many vectors, those of smallest hash.
SAMPLE = 8192
#: Rows of an index block, queries of a query block, candidates of each block that are reranked.
INDEX_BLOCK, QUERY_BLOCK, SHORTLIST = 16_384, 4096, 400


def _clusters(x: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 5) -> np.ndarray:
    centres = x[rng.permutation(len(x))[:count]].copy()
    centres = np.concatenate([centres, np.zeros((count - len(centres), x.shape[1]))])
    for _ in range(rounds):
        near = (x @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=count)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


@dataclass(frozen=True)
class AdditiveQuantiser:
    """``books[m, k]`` are full-length codewords; a vector is near the sum of one word of each book."""

    books: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 1, seed: int = 3) -> AdditiveQuantiser:
        """Each book clusters what the books before leave over; then all books are refitted to the codes together."""
        rng = np.random.default_rng(seed)
        rest, made = x.copy(), []
        for _ in range(books):
            made.append(_clusters(rest, words, rng))
            rest -= made[-1][(rest @ made[-1].T - (made[-1] ** 2).sum(axis=1) / 2).argmax(axis=1)]
        quantiser = AdditiveQuantiser(np.stack(made))
        for _ in range(rounds):
            codes = quantiser.encode(x).astype(np.int64)
            at = codes + np.arange(books) * words
            gram = np.zeros((books * words, books * words))
            for i in range(books):
                for j in range(books):
                    np.add.at(gram, (at[:, i], at[:, j]), 1.0)
            right = np.zeros((books * words, x.shape[1]))
            for i in range(books):
                np.add.at(right, at[:, i], x)
            # A small pull to the old words keeps unused ones in place.
            old = quantiser.books.reshape(-1, x.shape[1])
            solved = np.linalg.solve(gram + 0.1 * np.eye(len(gram)), right + 0.1 * old)
            quantiser = AdditiveQuantiser(solved.reshape(quantiser.books.shape))
        return quantiser

    def encode(self, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Codes by beam search: after each book the ``beam`` partial sums nearest to the vector stay."""
        n, words = len(x), self.books.shape[1]
        out = []
        for cut in range(0, n, 1024):
            part = x[cut : cut + 1024]
            rest, codes = part[:, None, :], np.zeros((len(part), 1, 0), np.uint8)
            for book in self.books:
                lost = (rest**2).sum(axis=2)[:, :, None] - 2 * rest @ book.T + (book**2).sum(axis=1)
                flat = lost.reshape(len(part), -1)
                keep = min(beam, flat.shape[1])
                best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
                from_beam, word = best // words, best % words
                rows = np.arange(len(part))[:, None]
                rest = rest[rows, from_beam] - book[word]
                codes = np.concatenate([codes[rows, from_beam], word[:, :, None].astype(np.uint8)], axis=2)
            out.append(codes[np.arange(len(part)), (rest**2).sum(axis=2).argmin(axis=1)])
        return np.concatenate([*out, np.zeros((0, len(self.books)), np.uint8)])

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(book[codes[:, m]] for m, book in enumerate(self.books))

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(query, book, word) inner products; a code's score is the sum of one entry of each book."""
        return np.einsum("qd,mkd->qmk", queries, self.books)


def distinct_vectors(vectors: DataFrame, width: int, ids: int) -> DataFrame:
    """``(vec_id, ids, embedding)``: one row per vector, padded to ``width``, with its ``ids`` smallest vec_ids, of which ``vec_id`` is the first.

    The window keeps ``ids`` rows of a group in each task before rows are dealt out, so a vector of very many copies is no hot task.
    """
    padded = vectors.select("vec_id", F.concat("embedding", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("embedding"))).alias("embedding"))
    # Adding 0.0 makes -0.0 and 0.0 one value; the window then tells vectors apart by their values.
    padded = padded.select("vec_id", F.transform("embedding", lambda x: x + F.lit(0.0)).alias("embedding")).distinct()
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    kept = padded.withColumn("place", first).where(F.col("place") <= ids)
    return kept.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("vec_id"), "ids", "embedding")


def build_index(vectors: DataFrame, quantiser: AdditiveQuantiser, width: int) -> DataFrame:
    """``(ids, codes, norm, embedding)``: every vector's codes and the squared norm of what they decode to."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = quantiser.encode(matrix(batch["embedding"], width))
            norm = (quantiser.decode(codes) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch["ids"], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm, pa.float64()), batch["embedding"]], ["ids", "codes", "norm", "embedding"])

    return map_arrow(vectors.select("ids", "embedding"), body, "ids array<long>, codes binary, norm double, embedding array<double>")


def _best(ids: Iterator[np.ndarray], worth: np.ndarray, name: int, k: int) -> list[tuple[float, int]]:
    """The ``k`` best ``(-score, vec_id)`` of rows that come best first: every vec_id once, ``name`` left out, ties whole."""
    seen: dict[int, float] = {}
    last = np.inf
    for row, score in zip(ids, worth, strict=True):
        if score == -np.inf or len(seen) >= k and score < last:
            break
        last = score
        for i in row.tolist():
            if i != name:
                seen.setdefault(i, score)
    return sorted((-score, i) for i, score in seen.items())[:k]


def _packed(rows: DataFrame, blocks: int, key: str, columns: list[str]) -> DataFrame:
    """Rows gathered into ``blocks`` blocks by the hash of ``key``; one row a block, with an array per column."""
    return rows.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")).groupBy("block").agg(*(F.collect_list(c).alias(c) for c in columns))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, measure: str = "product", shortlist: int = SHORTLIST, index_block: int = INDEX_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest of all other rows, nearest first.

    ``measure``: "product" (largest inner product) or "distance" (smallest Euclidean distance, scored as its negated
    square; this is what the stored norms are for). Equal vectors are one row of the index, with their ``k`` + 1
    smallest vec_ids, which is as many as an answer can take. Codebooks are fitted on a bounded sample, every row is encoded.
    Blocks of queries meet blocks of codes; lookup tables score all codes of the block, and each query's best
    ``shortlist`` of the block are reranked at once by the measure itself on the original vectors, in double
    precision; the block passes on its ``k`` best. Ties go to the smaller vec_id. With at most ``shortlist`` distinct
    vectors a block the result is exact.

    Null, zero and non-finite vectors take no part; vectors of unequal length compare as if padded with zeros; equal
    rows of one vec_id count once, and a vec_id with several vectors is found by its best.
    """
    width = width_of(usable(vectors))
    fine = stored(distinct_vectors(usable(vectors), width, k + 1))
    count = fine.count()
    asked = usable(queries).distinct()
    schema = "query_id long, rank int, vec_id long, score double"
    if not count:
        return vectors.sparkSession.createDataFrame([], schema)
    quantiser = AdditiveQuantiser.fit(sample(fine, SAMPLE, width))
    index = build_index(fine, quantiser, width)
    index_blocks, query_blocks = -(-count // index_block), -(-asked.count() // QUERY_BLOCK) or 1
    packed = _packed(index, index_blocks, "embedding", ["ids", "codes", "norm", "embedding"]).select(F.col("block").alias("i"), "ids", "codes", "norm", F.col("embedding").alias("vectors"))
    askers = _packed(asked, query_blocks, "vec_id", ["vec_id", "embedding"]).select(F.explode(F.sequence(F.lit(0), F.lit(index_blocks - 1))).alias("i"), F.col("vec_id").alias("query_ids"), F.col("embedding").alias("queries"))

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                lists, asking = batch["ids"][r].values, batch["query_ids"][r].values.to_numpy()
                held = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy()
                starts = np.cumsum(held) - held
                ids, lone = flat[starts], held == 1
                codes = np.frombuffer(b"".join(batch["codes"][r].as_py()), np.uint8).reshape(len(ids), -1)
                norm, exact = batch["norm"][r].values.to_numpy().astype(np.float32), matrix(batch["vectors"][r].values, width)
                looked = matrix(batch["queries"][r].values, width)
                for cut in range(0, len(asking), 64):
                    some, names = looked[cut : cut + 64], asking[cut : cut + 64]
                    tables = quantiser.tables(some).astype(np.float32)
                    score = np.zeros((len(some), len(ids)), np.float32)
                    for m in range(codes.shape[1]):
                        score += tables[:, m, :][:, codes[:, m]]
                    if measure == "distance":
                        score = 2 * score - norm
                    score[(names[:, None] == ids) & lone] = -np.inf
                    keep = min(shortlist, len(ids))
                    short = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
                    near = exact[short]
                    true = (near * some[:, None, :]).sum(axis=2) if measure == "product" else -((near - some[:, None, :]) ** 2).sum(axis=2)
                    true[(ids[short] == names[:, None]) & lone[short]] = -np.inf
                    order = np.argsort(-true, axis=1, kind="stable")
                    found = []
                    for q, name in enumerate(names.tolist()):
                        rows = short[q, order[q]]
                        lists_of = (flat[starts[i] : starts[i] + held[i]] for i in rows)
                        found += [(name, i, -lost) for lost, i in _best(lists_of, true[q, order[q]], name, k)]
                    cols = [pa.array([f[c] for f in found], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays(cols, ["query_id", "vec_id", "score"])

    met = askers.join(packed, "i").select("query_ids", "queries", "ids", "codes", "norm", "vectors")
    scored = map_arrow(met, body, "query_id long, vec_id long, score double")
    best = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_additive_search(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 20 = 0"), k=20)
