"""A corpus from documents: toxic ones go, near copies and repeated passages go, sources are mixed, texts are encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.llm.common import stored, word_count
from groundmill.llm.mixing import mix_sources
from groundmill.llm.near_dedup import near_duplicates, text_hash
from groundmill.llm.pieces import encode_pieces, model_bytes
from groundmill.llm.suffix_dedup import drop_repeated_bytes
from groundmill.llm.toxicity import fit_toxicity, held_out, score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the labels of the held-out fifth are not learnt from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    return score_toxicity(docs.select(*COLUMNS), fit_toxicity(docs, labels)).where("toxicity < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with 0.8 of their five-word shingles in common the smallest doc_id stays; rows without doc_id stay.

    Of several texts under one doc_id each is judged by its own group.
    """
    gone = near_duplicates(docs, length=5, percent=80).where("doc_id <> component_id").select("doc_id", "text_hash").distinct()
    given = docs.select(*COLUMNS).withColumn("text_hash", text_hash(docs))
    return given.join(gone.hint("merge"), ["doc_id", "text_hash"], "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that start earlier go; a character that loses a byte goes whole; null texts stay null."""
    given = docs.select(*COLUMNS, F.col("text").isNull().alias("no_text"))
    cut = drop_repeated_bytes(given, carry=("lang", "source", "n_chars", "no_text"), as_text=True)
    return cut.select(
        "doc_id", F.when(~F.col("no_text"), F.col("kept")).alias("text"), "lang", "source",
        F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Equal rows are one row with the sum of their copies."""
    content = F.xxhash64(*(c for n in ("text", "lang", "n_chars") for c in (F.col(n), F.col(n).isNull())))
    taken = mix_sources(docs.withColumn("content", content), carry=("content",)).groupBy("doc_id", "source", "size", "content").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    taken = taken.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("n"), F.col("content").alias("c"), "copies", "rows")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (word_count(F.col("text")) == F.col("n")) & (content == F.col("c"))
    met = docs.select(*COLUMNS).join(taken.hint("merge"), same).drop("d", "s", "n", "c")
    single = met.where("rows = 1").unionByName(met.where("rows > 1").dropDuplicates())
    return single.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids; ``decoded`` must be the text again."""
    done = encode_pieces(docs.select(*COLUMNS), model_bytes())
    return done.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]
#: The classifier and the signatures have no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
