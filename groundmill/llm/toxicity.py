"""Toxicity by compression distance: two zstandard dictionaries, window lengths compared, thresholds calibrated."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.llm.common import WORD_GAP, map_arrow, slices, stored

#: Every window stands between pads that both dictionaries know; without them zstandard stores so short a text as it is.
PAD = b"=<window>="
#: A window is one word in lower case; longer words are cut into windows of this many bytes.
WINDOW = 64
DICTIONARY, LEVEL = 16_384, 12
#: Windows whose lengths a Python worker remembers.
REMEMBERED = 300_000

_lengths: dict[bytes, dict[bytes, int]] = {}


def windows(text: bytes) -> list[bytes]:
    words = text.lower().split()
    if max(map(len, words), default=0) > WINDOW:
        words = [w[i : i + WINDOW] for w in words for i in range(0, len(w), WINDOW)]
    return words or [b""]


def _framed(window: bytes) -> bytes:
    return PAD + b" " + window + b" " + PAD


def train_dictionary(samples: list[bytes], size: int = DICTIONARY) -> tuple[bytes, bool]:
    """A zstandard dictionary and whether it is raw content, which stands in where samples are too few to train on."""
    framed = [_framed(s) for s in samples]
    try:
        return zstandard.train_dictionary(size, framed, level=LEVEL).as_bytes(), False
    except zstandard.ZstdError:
        return b"".join(framed)[-size:], True


@dataclass(frozen=True)
class ToxicityModel:
    """Dictionaries of ordinary and toxic text, and the weights that turn a document's window lengths into a score."""

    ordinary: tuple[bytes, bool]
    toxic: tuple[bytes, bool]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _compressor(self, made: tuple[bytes, bool]) -> zstandard.ZstdCompressor:
        kind = zstandard.DICT_TYPE_RAWCONTENT if made[1] else zstandard.DICT_TYPE_AUTO
        known = zstandard.ZstdCompressionDict(made[0], dict_type=kind)
        known.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)

    def measurer(self):
        """Bytes that a window takes with the ordinary dictionary beyond those with the toxic one, per window."""
        a, b = self._compressor(self.ordinary), self._compressor(self.toxic)
        seen = _lengths.setdefault(blake2b(self.ordinary[0] + self.toxic[0]).digest(), {})

        def measure(text: bytes) -> np.ndarray:
            if len(seen) > REMEMBERED:
                seen.clear()
            out = []
            for w in windows(text):
                gain = seen.get(w)
                if gain is None:
                    framed = _framed(w)
                    gain = seen[w] = len(a.compress(framed)) - len(b.compress(framed))
                out.append(gain)
            return np.array(out, np.float64)

        return measure

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.column_stack([features, np.ones(len(features))]) @ self.weights, -35, 35)))


def features(gains: np.ndarray) -> list[float]:
    """The largest gains, the mean, the shares and the counts of windows beyond fixed gains, and how many there are."""
    top = np.sort(np.partition(gains, max(len(gains) - 3, 0))[-3:])[::-1]
    return [top[0], top[:2].mean(), top.mean(), gains.mean(), (gains >= 3).mean(), (gains >= 5).mean(), min((gains >= 4).sum(), 5), min((gains >= 6).sum(), 5), np.log(len(gains)), top[min(1, len(top) - 1)]]


N_FEATURES = 10


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic fit by Newton steps; the last is the threshold."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.01 * np.eye(len(w)), z.T @ (y - p) - 0.01 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    scaled = w[:-1] / spread
    return np.append(scaled, w[-1] - scaled @ mean)



def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = 12_000, longest: int = 100_000, tell: float = 3.0, drawn_words: int = 20_000) -> ToxicityModel | None:
    """Learn from ``labels(doc_id, toxic)``; at most ``most`` labelled documents, those of smallest hash, of at most ``longest`` bytes.

    The toxic dictionary is trained on all words of two or more toxic documents whose share of toxic documents exceeds
    that of ordinary ones by ``tell`` in log odds, each as often as it is worth, and has room for all of them; where
    there are none, on those of any positive log odds, and else on words drawn from the toxic documents. The ordinary one is trained on ``drawn_words``
    windows drawn from ordinary documents; words over WINDOW bytes are cut into windows, as in scoring. The weights are fitted on the window lengths of the same documents. Equal
    texts count once; a doc_id or text with several labels is toxic if any is. Only A-Z are lowered.
    Without documents of both kinds there is no model. All that the driver gets is bounded by the parameters.
    Words are judged one by one: a phrase of ordinary words tells nothing.
    """
    told = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = told.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    known = docs.select("doc_id", "text").where(F.octet_length("text") <= longest).join(F.broadcast(drawn), "doc_id").select("doc_id", "toxic", "text")  # at most `most` short rows
    known = stored(known.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return None
    word = known.select("doc_id", "toxic", F.posexplode(F.split(F.translate("text", ascii_uppercase, ascii_lowercase), WORD_GAP)).alias("place", "word")).where("word <> ''")
    cuts = F.transform(F.sequence(F.lit(0), ((F.octet_length("word") - 1) / WINDOW).cast("int")), lambda i: F.substring(F.col("word").cast("binary"), i * WINDOW + 1, F.lit(WINDOW)))
    word = word.select("doc_id", "toxic", "place", F.explode(cuts).alias("word"))
    shares = word.select("doc_id", "toxic", "word").distinct().groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    odds = F.log((F.col("t") + 0.5) / (bad + 1)) - F.log((F.col("o") + 0.5) / (good + 1))
    worth = F.col("t") * odds
    told_words = lambda least: shares.where((F.col("t") >= 2) & (odds > least)).select("word", worth.alias("worth")).orderBy(F.desc("worth"), "word").collect()
    marks = told_words(tell) or told_words(0.0)
    plain = word.where("toxic = 0").orderBy(F.xxhash64("doc_id", "place"), "doc_id", "place", "word").limit(drawn_words).collect()
    rng = np.random.default_rng(5)
    if marks:
        share = 12_000 / sum(r["worth"] for r in marks)
        telling = [bytes(r["word"]) for r in marks for _ in range(1 + int(r["worth"] * share))]
    else:
        telling = [bytes(r["word"]) for r in word.where("toxic = 1").orderBy(F.xxhash64("doc_id", "place"), "doc_id", "place", "word").limit(drawn_words).collect()] or [b""]
    usual = [bytes(r["word"]) for r in plain] or [b""]
    room = max(DICTIONARY, 2 * sum(len(_framed(bytes(r["word"]))) for r in marks))
    model = ToxicityModel(train_dictionary([usual[i] for i in rng.permutation(len(usual))]), train_dictionary([telling[i] for i in rng.permutation(len(telling))], room))
    rows = measured(known, model, ["toxic"]).orderBy("doc_id").collect()
    return ToxicityModel(model.ordinary, model.toxic, calibrate(np.array([r["features"] for r in rows]), np.array([float(r["toxic"]) for r in rows])))


def measured(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = model.measurer()
        for batch in slices(batches, ["body"]):
            found = [features(measure(t)) for t in batch["body"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ["doc_id", *keep]), pa.array(found, pa.list_(pa.float64()))], ["doc_id", *keep, "features"])

    kinds = dict(docs.dtypes)
    rows = docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    return map_arrow(rows, body, ", ".join(f"{c} {kinds[c]}" for c in ["doc_id", *keep]) + ", features array<double>")


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``docs`` with ``toxicity`` from 0 to 1 for each whole text; a null or empty text is scored as one empty window.

    Without a model (no labels of both kinds) every score is 0. Other columns
    stay, a column ``toxicity`` of the input is replaced, and equal rows score alike.
    """
    rest = docs.drop("toxicity")
    if model is None:
        return rest.withColumn("toxicity", F.lit(0.0))
    schema = rest.schema.simpleString()[len("struct<") : -1]
    names = rest.columns

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = model.measurer()
        for batch in batches:
            texts = (t.as_py() for t in batch["text"])
            found = np.array([features(measure((t or "").encode())) for t in texts]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(found))], [*names, "toxicity"])

    return map_arrow(rest, body, f"{schema},toxicity:double")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    scored = score_toxicity(docs.select("doc_id", "text"), fit_toxicity(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
