"""Substring dedup: Rabin-Karp hashes of fixed-length word windows, counted in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from groundmill.llm import repeats
from groundmill.llm.common import WORD_GAP, WORD_GAP_CHARS, map_arrow, slices, split_join, stored


def word_units(text: bytes) -> np.ndarray:
    """A 64-bit hash per word; ``bytes.split`` cuts at exactly the six ASCII blanks."""
    words = text.split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def repeated_words(docs: DataFrame, window: int = 50, gram: int = 8) -> DataFrame:
    """``(doc_id, part, spans)``: word ranges [start, end) covered by windows that a smaller doc_id holds too.

    Every window whose smallest ``gram`` words occur in two documents gets its Rabin-Karp hash (64 and 32 bits, two
    bases); Spark takes the smallest doc_id of each hash, and the windows of larger ones merge into spans. Exact
    copies are settled by their digest first, so that a large group of them counts once.
    """
    first, later = repeats.originals(repeats.anchored(docs, word_units, gram, window))
    places = repeats.live_places(first, across=True)
    texts = repeats.keyed(docs).where("doc_id IS NOT NULL").join(places.hint("merge"), ["doc_id", "part"]).select("doc_id", "part", "body", "live")

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ["body"]):
            hashes, checks, starts = [], [], []
            for text, live in zip(batch["body"], batch["live"], strict=True):
                units = word_units(text.as_py())
                place, _, begin, end = repeats.anchors(units, gram, window)
                held = np.isin(place, live.values.to_numpy())
                lit = np.zeros(len(units) + 1, np.int64)
                np.add.at(lit, begin[held], 1)
                np.add.at(lit, end[held] + 1, -1)
                at = np.flatnonzero(np.cumsum(lit))
                hashes.append(repeats.signed(repeats.rolling(units, window)[at]))
                checks.append((repeats.rolling(units, window, repeats.OTHER_BASE)[at] >> np.uint64(33)).astype(np.int64))
                starts.append(at)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["part"], repeats.lists(hashes, pa.int64()), repeats.lists(checks, pa.int32()), repeats.lists(starts, pa.int32())], ["doc_id", "part", "hashes", "checks", "starts"]
            )

    found = stored(map_arrow(texts, body, "doc_id long, part int, hashes array<long>, checks array<int>, starts array<int>"))
    windows = found.select("doc_id", "part", F.explode(F.arrays_zip("hashes", "checks", "starts")).alias("x")).select("doc_id", "part", F.col("x.hashes").alias("hash"), F.col("x.checks").alias("check"), F.col("x.starts").alias("start"))
    counted = windows.groupBy("hash", "check").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    again = split_join(windows, counted, ["hash", "check"]).where("doc_id > least")
    spans = again.select("doc_id", "part", F.col("start").cast("long").alias("start"), (F.col("start") + window).cast("long").alias("end"))
    whole = later.select("doc_id", "part", F.lit(0).cast("long").alias("start"), F.lit(1 << 40).cast("long").alias("end"))
    return stored(repeats.merged(spans.unionByName(whole)))


def drop_repeated_words(docs: DataFrame, window: int = 50, gram: int = 8) -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, kept)``: texts without the words of repeated windows.

    ``kept`` joins the remaining words by one space. A null, blank or short text keeps all its words. Rows without
    doc_id lose nothing and count nowhere; equal rows share their result; a doc_id with several texts has each
    judged for itself. Copies of one text keep it at the smallest doc_id only, if it holds a whole window.
    """
    text = F.btrim(F.coalesce(F.col("body").cast("string"), F.lit("")), F.lit(WORD_GAP_CHARS))
    words = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, WORD_GAP))
    spans = repeated_words(docs, window, gram)
    joined = repeats.keyed(docs).join(spans.hint("merge"), ["doc_id", "part"], "left").select("doc_id", words.alias("words"), F.coalesce("spans", F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)")).alias("spans"))
    n = F.size("words").cast("long")
    cut = joined.select("doc_id", "words", n.alias("n_words"), F.transform("spans", lambda s: F.struct(s["start"], F.least(s["end"], F.size("words").cast("long")).alias("end"))).alias("spans"))
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.col("n_words")))
    parts = F.zip_with(begins, ends, lambda b, e: F.slice("words", (b + 1).cast("int"), (e - b).cast("int")))
    return cut.select("doc_id", "n_words", repeats.spans_removed().alias("n_removed"), "spans", F.array_join(F.flatten(parts), " ").alias("kept"))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_words(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, i, hash(list_slice(w, i, i + 49)) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM tokens WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS least FROM starts GROUP BY h HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT DISTINCT doc_id, i + k AS pos FROM starts JOIN firsts USING (h), range(50) AS r(k) WHERE doc_id > least),
gone AS (SELECT doc_id, list(pos) AS spots FROM hit GROUP BY doc_id),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS word FROM tokens),
kept AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.pos) AS text FROM words w LEFT JOIN hit h ON w.doc_id = h.doc_id AND w.pos = h.pos WHERE h.pos IS NULL GROUP BY 1)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(len(g.spots), 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM tokens t LEFT JOIN gone g USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
