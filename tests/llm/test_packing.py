"""Packing against the tokenizer itself and a plain version of the placing rule."""

from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm import DOC, awkward

from groundmill.llm import packing

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
ENCODER = packing.WordTokens(PATH)


def plain(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


def whole(rows, size):
    """The pieces make up every document once and every sequence without gaps; sequences have ``size`` or a power of two."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], np.uint32).tolist(), r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], len(r["ids"]) // 4, r["sequence_tokens"]))
    for parts in sequences.values():
        at = 0
        for offset, n, _ in sorted(parts):
            assert offset == at and n
            at += n
        assert {p[2] for p in parts} == {at} and (at == size or at & (at - 1) == 0)
    return docs


def test_given_documents(spark):
    table = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    docs = whole(packing.pack_documents(table, PATH).collect(), 2048)
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    assert docs.keys() == texts.keys()
    for i, parts in docs.items():
        ids = [x for _, part, _ in sorted(parts) for x in part]
        assert ids == [*plain(texts[i]), 1] and {n for *_, n in parts} == {len(ids)}


def test_awkward_documents(spark):
    for size, most in ((2048, 4096), (64, 3)):
        rows = packing.pack_documents(spark.createDataFrame(awkward(), DOC), PATH, size, most_open=most).collect()
        docs = whole(rows, size)
        want = defaultdict(list)
        for i, t, *_ in awkward():
            want[i] += [*plain(t), 1]
        assert {i: sorted(x for _, part, _ in parts for x in part) for i, parts in docs.items()} == {i: sorted(x) for i, x in want.items()}
    assert packing.pack_documents(spark.createDataFrame([], DOC), PATH).collect() == []


def test_query_of_small_table(spark, tmp_path):
    spark.createDataFrame([(1, "a b", 1), (2, None, 1)], "doc_id long, text string, length long").write.parquet(f"{tmp_path}/documents.parquet")
    rows = packing.op12_packing(spark, str(tmp_path)).collect()
    assert sum(r["length"] for r in rows) == len(plain("a b")) + 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab '.,!?;:\n\t\r  \x00\x1c  　é中9٣'s<|endoftext|>")), max_size=30), max_size=8))
def test_words_alone_give_the_texts_ids(texts):
    ids, counts = ENCODER.encode(pa.array([*texts, None, "<|endoftext|> a<|endoftext|>", "it's 's  x \n y \n\nz"], pa.string()))
    ends = np.cumsum(counts)
    for text, end, n in zip([*texts, "", "<|endoftext|> a<|endoftext|>", "it's 's  x \n y \n\nz"], ends, counts, strict=True):
        assert ids[end - n : end].tolist() == plain(text)


def test_level_is_that_of_least_squares():
    rng = np.random.default_rng(3)
    packer = packing.SquarePacker(32)
    level = [0] * 33
    for s in rng.integers(1, 33, 2000).tolist():
        best = None
        for h in range(32 - s, -1, -1):
            if h and not level[h]:
                continue
            after = list(level)
            if h:
                after[h] -= 1
            if h + s < 32:
                after[h + s] += 1
            cost = sum(v * v for v in after)
            if best is None or cost < best[0]:
                best = (cost, h, after)
        assert packer.choose(s) == best[1]
        packer.place((0, 0, np.zeros(s, np.uint32)))
        level = best[2]
        assert packer.level.tolist() == level and packer.open == sum(level)
