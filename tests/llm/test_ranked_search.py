"""Ranked search against a plain scorer and SQL."""

import math
import re
from collections import Counter

import numpy as np
from conftest import DATA, rows_of
from test_llm import DOC, awkward

from groundmill.llm import ranked_search as r

ITEM = "item_id long, text string, score int, doc_id string"


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, k=10):
    terms = [(d, Counter(split(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    asked = {}
    for i, t in set(items):
        asked.setdefault(i, Counter()).update(split(t))
    out = []
    for i, wanted in asked.items():
        scored = []
        for d, c in terms:
            m = 25 + 75 * sum(c.values()) * n_docs // max(total, 1)
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, q in wanted.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, n + 1, d, -s) for n, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def found(frame):
    return sorted(((x["item_id"], x["rank"], x["doc_id"], x["score"]) for x in frame.collect()), key=str)


def test_given_tables(spark, duck):
    frame = r.op13_ranked_search(spark, f"{DATA}/sf0.001")
    assert rows_of(frame.toPandas()) == rows_of(duck.execute(r.OP13_SQL).df())
    docs, items = (spark.read.parquet(f"{DATA}/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain([(x["doc_id"], x["text"]) for x in docs.collect()], [(x["item_id"], x["text"]) for x in items.collect()], 3)
    assert found(r.rank_documents(docs, items, k=3, unit=30, queries=4)) == want


def test_awkward_rows(spark):
    docs = [*awkward(), *((100 + i, "same words here", None, None, None, "x", 1, 1) for i in range(30))]
    items = [(1, "same words", 1, "x"), (2, "PASSAGE p1 p2 p3 é", 1, "x"), (3, None, 1, "x"), (4, "", 1, "x"), (5, "nowhere0", 1, "x"), (None, "b c", 1, "x"), (6, "p1 p1 p1 w5", 1, "x"), (6, "p2", 1, "x"), (6, "p2", 2, "x"), (7, "end, one. END", 1, "x")]
    got = found(r.rank_documents(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), unit=5, queries=2))
    assert got == plain([(d[0], d[1]) for d in docs], [(i[0], i[1]) for i in items])
    none = spark.createDataFrame([], DOC)
    assert found(r.rank_documents(none, spark.createDataFrame(items, ITEM))) == []
    assert found(r.rank_documents(spark.createDataFrame(docs, DOC), spark.createDataFrame([], ITEM))) == []


def test_walk_equals_full_sums():
    rng = np.random.default_rng(7)
    for trial in range(200):
        size, k = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        lists, total = [], np.zeros(size, np.int64)
        for _ in range(int(rng.integers(1, 9))):
            docs = np.flatnonzero(rng.random(size) < rng.choice([0.02, 0.1, 0.5, 0.9]))
            adds = rng.integers(1, int(rng.choice([2, 5, 1000])) + 1, len(docs))
            if len(docs):
                lists.append((docs, adds, int(adds.max())))
                total[docs] += adds
        if lists:
            docs, scores = r.best_of_unit(lists, size, k, short=int(rng.choice([2, 4, 16])), step=int(rng.choice([7, 50, 1024])))
            order = [d for d in np.lexsort((np.arange(size), -total)) if total[d] > 0][:k]
            assert docs.tolist() == order and scores.tolist() == total[order].tolist()
