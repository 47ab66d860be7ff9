"""The data-preparation operators against brute force, on the given tables and on awkward rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import DATA, rows_of
from pyspark.sql import functions as F

from groundmill.llm import additive_search, chat, licences, mixing, near_dedup, pieces, queries, range_join, substring_dedup, suffix_dedup, toxicity

SF = f"{DATA}/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, body string, part int, size int"
rng = np.random.default_rng(1)
LONG = " ".join(f"w{i}" for i in rng.integers(0, 4000, 60_000))
PASSAGE = " ".join(f"p{i}" for i in range(120))


def awkward():
    """Nulls, empty and very long texts, ties, repeated rows, and columns that clash with the operators' own names."""
    texts = [
        (1, PASSAGE + " end one"), (2, "start two " + PASSAGE), (3, None), (4, ""), (5, " \t\n"), (6, PASSAGE + " end one"), (6, PASSAGE + " end one"),
        (7, "short"), (8, "Short"), (9, LONG), (10, LONG + " tail"), (11, "é" * 150), (12, "xx" + "é" * 150), (13, "a" * 400), (None, PASSAGE), (None, None), (14, "b c d e"), (15, PASSAGE.upper()),
    ]
    return [(i, t, None if i == 7 else "en", None if i in (3, 8) else f"s{(i or 0) % 3}", None, "clash", 1, 2) for i, t in texts]


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(awkward(), DOC)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def words(text):
    return (text or "").encode().split()


def brute_words(rows, size=50):
    least = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            if d is not None:
                least[k] = min(least.get(k, d), d)
    out = []
    for d, t in rows:
        w, gone = words(t), set()
        for i in range(len(w) - size + 1):
            if d is not None and least[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return out


def brute_bytes(rows, size=100):
    seen, out = {}, {}
    for d, t in sorted({r for r in rows if r[0] is not None}, key=lambda r: r[0]):
        b, gone = (t or "").encode(), set()
        for i in range(len(b) - size + 1):
            if seen.setdefault(b[i : i + size], (d, i)) != (d, i):
                gone.update(range(i, i + size))
        runs = sum(1 for i in gone if i - 1 not in gone)
        out[d] = (len(b), len(gone), runs, hashlib.sha256(bytes(x for i, x in enumerate(b) if i not in gone)).hexdigest())
    whole = lambda t: (len((t or "").encode()), 0, 0, hashlib.sha256((t or "").encode()).hexdigest())
    return [(d, *(out[d] if d is not None else whole(t))) for d, t in rows]


def brute_near(rows, length, percent=80):
    def shingle(t):
        w = (t or "").encode().lower().split()
        return frozenset([tuple(w)] if w and len(w) < length else [tuple(w[i : i + length]) for i in range(len(w) - length + 1)])

    sets = {d: shingle(t) for d, t in rows if d is not None}
    group = {d: d for d in sets}
    holders = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}

    def find(d):
        while group[d] != d:
            d = group[d]
        return d

    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            group[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def tuples(df):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r) for r in df.collect()), key=key)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got, want = queries.queries()[name](spark, SF).toPandas(), duck.sql(queries.oracle_sql()[name]).df()
    assert rows_of(got) == rows_of(want)


def test_substring_dedup(messy, none):
    cols = ["doc_id", "n_words", "n_removed", F.sha2("kept", 256)]
    rows = [(r[0], r[1]) for r in awkward()]
    assert tuples(substring_dedup.drop_repeated_words(messy).select(*cols)) == ordered(brute_words(rows))
    assert substring_dedup.drop_repeated_words(none).count() == 0


def test_suffix_dedup(spark, messy, none, documents):
    cols = ["doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)]
    rows = [(r[0], r[1]) for r in awkward() if r[0] not in (9, 10)]
    some = messy.where("doc_id IS NULL OR doc_id NOT IN (9, 10)")
    assert tuples(suffix_dedup.drop_repeated_bytes(some).select(*cols)) == ordered(brute_bytes(rows))
    assert suffix_dedup.drop_repeated_bytes(none).count() == 0
    assert tuples(queries.queries()["op3_suffix_dedup"](spark, SF)) == ordered(brute_bytes(documents))
    assert suffix_dedup.drop_repeated_bytes(messy.where("doc_id IN (9, 10)"), carry=("lang",), as_text=True).where("n_removed > 100000").count() == 1


def test_crowded_anchors_are_cut_into_windows(spark, monkeypatch, documents):
    monkeypatch.setattr(suffix_dedup, "CROWD", 2)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 10_000)
    assert tuples(queries.queries()["op3_suffix_dedup"](spark, SF)) == ordered(brute_bytes(documents))


def test_suffix_order():
    text = np.frombuffer(bytes(rng.integers(97, 99, 3000, dtype=np.uint8)) + b"ab" * 300, np.uint8)
    starts = np.arange(0, len(text) - 100)
    by = suffix_dedup.sort_suffixes(text, starts, 100)
    heads = [text[i : i + 100].tobytes() for i in starts[by]]
    assert heads == sorted(heads) and sorted(by) == list(range(len(starts)))


def test_near_dedup(messy, none):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(messy, 5).collect()}
    want = brute_near([(r[0], r[1]) for r in awkward()], 5)
    assert {d: got[d] for d in want} == want and got[None][1] is None
    assert near_dedup.near_duplicates(none, 5).count() == 0


def test_near_dedup_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "ROWS", 3)
    monkeypatch.setattr(near_dedup, "SETS", 3)
    base = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join([*base[: 118 - i % 7], *(f"x{i}_{k}" for k in range(i % 7 + i % 3))])) for i in range(40)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == brute_near(rows, 4)


def test_signature_index_finds_every_pair_within_the_distance():
    a = rng.integers(0, 1 << 16, (200, near_dedup.HASHES), dtype=np.uint16)
    b = a.copy()
    for row in b:
        row[rng.permutation(near_dedup.HASHES)[: near_dedup.DISTANCE]] ^= 1
    assert (near_dedup.signature_keys(a) == near_dedup.signature_keys(b)).any(axis=1).all()


def test_chat(spark, none):
    rows = [(1, 1, "assistant", "b\\[INST] </s>"), (1, 0, "user", None), (1, 1, "assistant", "b\\[INST] </s>"), (2, None, None, ""), (None, 0, "user", "x"), (3, 0, "assistant", "y" * 100_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit("clash"))
    out = chat.format_chat(chat.canonical_turns(table))
    back = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in out.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    assert back == {1: [("user", ""), ("assistant", "b\\[INST] </s>"), ("assistant", "b\\[INST] </s>")], 2: [("", "")], None: [("user", "x")], 3: [("assistant", "y" * 100_000)]}
    assert chat.format_chat(chat.canonical_turns(table.limit(0))).count() == 0
    with pytest.raises(ValueError):
        chat.canonical_turns(none.select("doc_id"))


def test_chat_layouts(spark):
    want = [("user", "q"), ("assistant", "a")]
    made = {
        "prompt": spark.createDataFrame([(1, "q", "a")], "id long, prompt string, completion string"),
        "instruction": spark.createDataFrame([(1, "q", "", "a")], "id long, instruction string, input string, output string"),
        "messages": spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")])], "id long, messages array<struct<role:string,content:string>>"),
        "from and value": spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")])], "id long, conversations array<struct<from:string,value:string>>"),
    }
    for name, table in made.items():
        assert chat.choose_layout(table.schema).name == name
        assert [(t["role"], t["text"]) for t in chat.canonical_turns(table.withColumn("more", F.lit(1))).first()["turns"]] == want


def test_chat_rows_of_several_layouts(spark):
    kinds = "id long, prompt string, completion string, messages array<struct<role:string,content:string>>, conv_id long, turn long, role string, text string"
    rows = [(1, "q", "a", None, None, None, None, None), (2, None, None, [("user", "m")], None, None, None, None), (None, None, None, None, 3, 1, "assistant", "y"), (None, None, None, None, 3, 0, "user", "x"), (4, "half", None, None, None, None, None, None), (5, None, None, None, None, None, None, None)]
    out = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.canonical_turns(spark.createDataFrame(rows, kinds)).collect()}
    assert {k: v for k, v in out.items() if k != 5} == {1: [("user", "q"), ("assistant", "a")], 2: [("user", "m")], 3: [("user", "x"), ("assistant", "y")], 4: [("user", "half"), ("assistant", "")]}
    assert all(not text for _, text in out[5])
    both = spark.createDataFrame([(1, "q", "a", [("user", "m")], None, None, None, None)], kinds)
    assert [(r["conv_id"], r["turns"]) for r in chat.canonical_turns(both).collect()] == [(1, [(0, "user", "m")])]
    # Turn rows beside columns that look like another layout are turn rows.
    extra = spark.createDataFrame([(1, 0, "user", "x", 7, "p", "c"), (1, 1, "assistant", "y", 7, "p", "c")], "conv_id long, turn long, role string, text string, id long, prompt string, completion string")
    assert [(r["conv_id"], r["turns"]) for r in chat.canonical_turns(extra).collect()] == [(1, [(0, "user", "x"), (1, "assistant", "y")])]


def test_toxicity(spark, messy, none):
    scored = queries.queries()["op5_toxicity"](spark, f"{DATA}/sf0.01").toPandas()
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet").toPandas().merge(scored, on="doc_id")
    assert scored["score"].between(0, 1).all() and len(scored) == 1000
    assert (labels["held_out"] == labels["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = labels[labels["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.9
    some = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate([("you fool fool here now", 1), ("a calm day out here", 0)] * 30)], "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(some.withColumn("text", F.concat("text", F.lit(" "), F.col("doc_id").cast("string"))), some)
    out = toxicity.score_toxicity(messy, model)
    assert out.count() == len(awkward()) and out.where("toxicity IS NULL OR toxicity < 0 OR toxicity > 1").count() == 0
    assert toxicity.score_toxicity(none, model).count() == 0
    assert toxicity.fit_toxicity(none, none.select("doc_id", F.lit(1).alias("toxic"))) is None
    assert {r["toxicity"] for r in toxicity.score_toxicity(messy, None).collect()} == {0.0}


def test_toxicity_is_that_of_a_plain_scorer(spark):
    import zstandard

    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").where("doc_id < 400")
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{DATA}/sf0.01/labels.parquet"))

    def plain(text):
        gains = []
        for word in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) or [b""]:
            for at in range(0, max(len(word), 1), 64):
                framed, size = b"=<window>= " + word[at : at + 64] + b" =<window>=", []
                for data, raw in (model.ordinary, model.toxic):
                    known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_AUTO)
                    size.append(len(zstandard.ZstdCompressor(level=12, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False).compress(framed)))
                gains.append(size[0] - size[1])
        top = sorted(gains, reverse=True)
        share = lambda n: sum(g >= n for g in gains)
        x = [top[0], np.mean(top[:2]), np.mean(top[:3]), np.mean(gains), share(3) / len(gains), share(5) / len(gains), min(share(4), 5), min(share(6), 5), np.log(len(gains)), top[min(1, len(top) - 1)]]
        return 1 / (1 + np.exp(-np.clip(np.dot(x, model.weights[:-1]) + model.weights[-1], -35, 35)))

    some = spark.createDataFrame([(1, "x" * 200 + " fool"), (2, None), (3, ""), (4, "Idiot I\u0307 \u212a"), *((10 + r["doc_id"], r["text"][:400]) for r in docs.limit(6).collect())], "doc_id long, text string")
    for r in toxicity.score_toxicity(some, model).collect():
        assert abs(r["toxicity"] - plain(r["text"])) < 1e-9


def test_long_toxic_words_are_learnt_in_windows(spark):
    bad = hashlib.sha512(b"x").hexdigest()[:120]
    rows = [(i, f"some plain words {bad} here {i % 7}", 1) for i in range(40)] + [(100 + i, f"some plain words here {i % 7} and {i % 11}", 0) for i in range(80)]
    some = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    fresh = spark.createDataFrame([(1, f"some plain words {bad} here 9"), (2, "some plain words here 9 and 9")], "doc_id long, text string")
    scored = {r["doc_id"]: r["toxicity"] for r in toxicity.score_toxicity(fresh, toxicity.fit_toxicity(some, some)).collect()}
    assert scored[1] >= 0.5 > scored[2]


def test_toxicity_of_many_rare_words(spark):
    """100 words, each in 3 of 300 toxic documents, and labels of both kinds that no word tells apart."""
    draw = np.random.default_rng(6)
    plain = lambda: " ".join(f"word{i}" for i in draw.integers(0, 80, 12))
    vile = [f"{chr(97 + i % 26)}{chr(120 - i // 26)}zqk{chr(97 + i * 7 % 26)}x{chr(97 + i * 11 % 26)}" for i in range(100)]
    rows = [(i, f"{plain()} {vile[i % 100]} {plain()}", 1) for i in range(300)] + [(i, f"{plain()} {plain()}", 0) for i in range(300, 2100)]
    some = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    fresh = spark.createDataFrame([(i, f"{plain()} {vile[i]} {plain()}" if i < 100 else f"{plain()} {plain()}", None) for i in range(300)], some.schema)
    scored = {r["doc_id"]: r["toxicity"] >= 0.5 for r in toxicity.score_toxicity(fresh, toxicity.fit_toxicity(some, some)).collect()}
    assert sum(scored[i] for i in range(100)) >= 90 and sum(scored[i] for i in range(100, 300)) <= 10
    lone = spark.createDataFrame([(i, f"only{i} once{i}", i % 2) for i in range(8)], some.schema)
    assert toxicity.fit_toxicity(lone, lone) is not None


def vectors():
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[50:90] = x[0] + rng.normal(size=(40, 8)).astype(np.float32) * 0.15
    x[100:110] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return [*rows, (300, None), (301, [0.0] * 8), (302, [None] + [1.0] * 7), (303, [float("nan")] * 8), (304, [float("inf")] + [0.0] * 7), (305, []), (306, x[5, :6].tolist()), (7, x[7].tolist()), (None, x[8].tolist())]


def usable(rows):
    out = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            out[i] = np.array(v + [0.0] * (8 - len(v)))
    return out


@pytest.mark.parametrize("cell,block", [(4096, 4096), (20, 16)])
def test_range_join(spark, cell, block):
    table = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").withColumn("rep", F.lit(1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in range_join.near_vectors(table, 0.9, cell, block).where("vec_id IS NOT NULL").collect()}
    good = usable([(r["vec_id"], r["embedding"]) for r in table.collect()])
    ids = list(good)
    m = np.stack([good[i] for i in ids])
    cos = m @ m.T / np.linalg.norm(m, axis=1)[:, None] / np.linalg.norm(m, axis=1)
    near = (cos >= 0.9) & ~np.eye(len(ids), dtype=bool)
    label = np.array(ids)
    for _ in range(50):
        label = np.array([min([label[k], *label[near[k]]]) for k in range(len(ids))])
    want = {i: (0, i) for i in range(307)} | {i: (int(near[k].sum()), int(label[k])) for k, i in enumerate(ids)}
    assert got == want
    assert range_join.near_vectors(table.limit(0)).count() == 0


def test_vectors_of_any_magnitude(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1e-170, 0.0]), (4, [0.0, 1e-170]), (5, [1e200, 0.0]), (6, [1e308, 1e308]), (7, [5e-324, 5e-324])]
    found = range_join.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()} == {1: (2, 1), 2: (1, 2), 3: (2, 1), 4: (1, 2), 5: (2, 1), 6: (1, 6), 7: (1, 6)}


def test_additive_search(spark):
    table = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").withColumn("codes", F.lit(1))
    good = usable([(r["vec_id"], r["embedding"]) for r in table.collect()])
    for measure in ("product", "distance"):
        got = additive_search.search(table, table.where("vec_id % 20 = 0"), 5, measure).collect()
        for q in [i for i in good if i % 20 == 0]:
            score = lambda i, q=q: good[q] @ good[i] if measure == "product" else -((good[q] - good[i]) ** 2).sum()
            want = sorted((i for i in good if i != q), key=lambda i: (-score(i), i))[:5]
            mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
            assert [r[0] for r in mine] == [1, 2, 3, 4, 5] and np.allclose([r[2] for r in mine], [score(i) for i in want])
    assert additive_search.search(table.limit(0), table, 5).count() == 0


def test_additive_search_with_copies_in_full_blocks(spark):
    """One vector with a third of all rows, several full blocks: copies come by smallest vec_id, and the rest is still found."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(5000, 16))
    copied = draw.choice(7500, 2500, replace=False)
    m = np.empty((7500, 16))
    m[np.setdiff1d(np.arange(7500), copied)] = x
    m[copied] = x[0] * 1.01
    asked = np.unique([*copied[:10], *range(0, 7500, 150)])
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>").repartition(4)
    for measure in ("product", "distance"):
        out = additive_search.search(table, table.where(F.col("vec_id").isin(asked.tolist())), 20, measure, shortlist=100, index_block=1250).collect()
        hits = 0
        for q in asked.tolist():
            true = m @ m[q] if measure == "product" else -((m - m[q]) ** 2).sum(axis=1)
            true = np.round(true, 9)
            want = [int(i) for i in np.lexsort((np.arange(7500), -true)) if i != q][:20]
            mine = [r["vec_id"] for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])]
            assert len(mine) == 20
            hits += len(set(mine) & set(want))
            if m[q] is not None and q in copied and measure == "distance":
                assert mine == want
        assert hits >= 0.9 * 20 * len(asked)


def test_additive_codes_recall():
    x = rng.normal(size=(3000, 32))
    q = additive_search.AdditiveQuantiser.fit(x)
    near = q.decode(q.encode(x))
    assert ((x - near) ** 2).sum() < 0.15 * (x**2).sum()
    table, codes = q.tables(x[:3]), q.encode(x)
    looked = sum(table[:, m, :][:, codes[:, m]] for m in range(codes.shape[1]))
    assert np.allclose(looked, x[:3] @ near.T)


def test_pieces_equal_the_library(documents):
    sentencepiece = pytest.importorskip("sentencepiece")
    other = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    machine = pieces.compiled(pieces.model_bytes())
    odd = ["", " ", "  a  b ", "▁x ▁▁", "tab\tnew\nline\r", "😀 漢字 ́", "x" * 500, "1234567 3.14", "<s></s><0x41>", "\x00\x7f", " lead", "trail "]
    for text in [*odd, *(t for _, t in documents[:120])]:
        ids = machine.encode(text)
        assert ids == other.encode(text)
        if "▁" not in text:
            assert machine.decode(ids) == text


def field(number, value):
    """One protobuf field: a number, bytes, or a float of four bytes."""
    def number_of(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + number_of(n >> 7)

    if isinstance(value, int):
        return number_of(number << 3) + number_of(value)
    return number_of(number << 3 | 5) + np.float32(value).tobytes() if isinstance(value, float) else number_of(number << 3 | 2) + number_of(len(value)) + value


def made_model(found, kind, charsmap=b"", fallback=True):
    """A model file of the given (piece, score) pairs; kind 1: unigram, 2: merges."""
    rows = [("<unk>", 0.0, 2), *(found if not fallback else [*((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), *found])]
    out = b"".join(field(1, field(1, p.encode()) + field(2, float(s)) + field(3, t)) for p, s, t in rows)
    return out + field(2, field(3, kind) + field(35, int(fallback))) + field(3, field(1, b"own") + field(2, charsmap) + field(3, 1) + field(4, 0) + field(5, 1))


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_and_merge_models_equal_the_library(fallback):
    sentencepiece = pytest.importorskip("sentencepiece")
    draw = np.random.default_rng(8)
    texts = ["".join(draw.choice(list("abcde  é漢"), n)) for n in (1, 2, 5, 40, 40, 80, 300, 900)]
    for kind in (1, 2):
        pieces_of = dict.fromkeys("▁abcdé")
        while len(pieces_of) < 150:  # each new piece joins two, so merges reach all
            a, b = draw.choice(list(pieces_of), 2)
            if "▁" not in b and len(a + b) < 9:
                pieces_of.setdefault(a + b)
        scores = -np.arange(len(pieces_of)) if kind == 2 else -draw.uniform(1, 9, len(pieces_of))
        data = made_model([(p, float(s), 1) for p, s in zip(pieces_of, scores, strict=True)], kind, fallback=fallback)
        other = sentencepiece.SentencePieceProcessor(model_proto=data)
        machine = pieces.compiled(data)
        for text, ids in zip(texts, machine.encode_all(texts), strict=True):
            assert ids.tolist() == other.encode(text), (kind, text)


def test_character_maps_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    if not hasattr(sentencepiece, "SentencePieceNormalizer"):
        pytest.skip("the library has no normaliser of its own")
    made = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=False)
    normal = dict(pieces._fields(dict(pieces._fields(made.serialized_model_proto()))[3]))
    machine = pieces.compiled(made_model([(c, -1.0, 1) for c in "▁abc"], 2, normal[2]))
    for text in ["ａｂｃ １２", "ﬁne\u00a0x", "e\u0301 \u2460 ㌔ \t a\u200b b", "한글 가", "plain", ""]:
        assert machine.normalise(text).decode().replace(" ", "▁") == made.normalize(text)


def test_pieces_on_awkward_rows(messy, none):
    out = pieces.encode_pieces(messy.withColumn("ids", F.lit(1)), pieces.model_bytes())
    assert out.where(F.col("decoded") == F.coalesce("text", F.lit(""))).count() == len(awkward())
    assert out.where("text IS NULL AND size(ids) > 0").count() == 0
    assert pieces.encode_pieces(none, pieces.model_bytes()).count() == 0


def test_near_copies_of_one_id_keep_their_own_texts(spark):
    import corpus_pipeline as line

    docs = spark.createDataFrame([(1, PASSAGE, None, None, 1), (2, PASSAGE, None, None, 1), (2, LONG, None, None, 1), (3, PASSAGE + " more", None, None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((r["doc_id"], r["text"]) for r in line.drop_near_copies(spark, docs, SF).collect()) == sorted([(1, PASSAGE), (2, LONG)])


def test_texts_of_one_id_are_told_apart_in_the_graph(spark):
    import corpus_pipeline as line

    b, a = [f"b{i}" for i in range(200)], " ".join(f"a{i}" for i in range(200))
    b1, b2, b3 = " ".join(b), " ".join([*b[:190], "n1"]), " ".join([*b[:180], "n2"])
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(0, b2), (1, a), (1, b1)]
    docs = spark.createDataFrame([(*r, None, None, 1) for r in rows], schema)
    by_text = {r["text"]: r["component_id"] for r in near_dedup.near_duplicates(docs).join(docs.select("text", near_dedup.text_hash(docs).alias("text_hash")), "text_hash").collect()}
    assert by_text == {b2: 0, b1: 0, a: 1}
    assert sorted((r["doc_id"], r["text"]) for r in line.drop_near_copies(spark, docs, SF).collect()) == [(0, b2), (1, a)]
    # A chain through one id's two unlike texts is no chain: b3 - b1 meet under id 5, a - a2 under ids 5 and 9.
    rows = [(4, b3), (5, b1), (5, a), (9, a + " more"), (9, "alone " * 9)]
    docs = spark.createDataFrame([(*r, None, None, 1) for r in rows], schema)
    by_text = {r["text"]: r["component_id"] for r in near_dedup.near_duplicates(docs).join(docs.select("text", near_dedup.text_hash(docs).alias("text_hash")), "text_hash").collect()}
    assert by_text == {b3: 4, b1: 4, a: 5, a + " more": 5, "alone " * 9: 9}


def test_mixing(spark, messy, none):
    out = mixing.mix_sources(messy).toPandas()
    assert len(out) == len(awkward()) and (out["copies"] <= 2).all() and (out["target"] <= 2 * out["source_size"] + 1e-9).all()
    assert abs(out.groupby("source", dropna=False)["target"].first().sum() - 1.5 * out["size"].sum()) < 1e-6
    assert mixing.mix_sources(none).count() == 0
    told = queries.queries()["op8_mixing"](spark, f"{DATA}/sf0.01").toPandas()
    for (size, target), g in told.groupby(["source_size", "target"]):
        assert abs(g["taken"].sum() - target) <= g["size"].max() + 1


def test_mix_keeps_rows_of_one_id_apart(spark):
    import corpus_pipeline as line

    rows = [(None, f"x{i} a b", "en", "s", None) for i in range(30)] + [(7, f"y{i} a b", "en", "s", None) for i in range(30)] + [(8, "same a b", None, "s", None)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    counts = defaultdict(int)
    for r in line.mix(spark, docs, SF).collect():
        counts[r["text"]] += 1
    # One source of weight 3: the share of 1.5 stands, every row comes once or twice, equal rows are one text.
    assert sum(counts.values()) == mixing.mix_sources(docs).agg(F.sum("copies")).first()[0]
    assert len(counts) == 61 and all(n in (1, 2) for t, n in counts.items() if t != "same a b") and 4 <= counts["same a b"] <= 8


def test_licences(spark, messy, none):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x.py", "print(1)"), ("a/b/c/y.py", "no words on it"), ("a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0"),
        ("d/z.py", "# This work is licensed under the GNU General Public License, version 3.\ncode"), ("d/w.py", None), ("top.py", ""), (None, "x"), ("a/x.py", "print(1)"), ("d/long.py", LONG),
    ]
    files = spark.createDataFrame(rows, "path string, text string").withColumn("licence", F.lit("clash"))
    got = {r["path"]: (r["licence"], r["origin"]) for r in licences.inherit_licences(files, licences.find_licences(files)).collect()}
    assert got == {
        "a/LICENSE": ("MIT", "a/LICENSE"), "a/x.py": ("MIT", "a"), "a/b/c/y.py": ("Apache-2.0", "a/b"), "a/b/LICENSE.txt": ("Apache-2.0", "a/b/LICENSE.txt"),
        "d/z.py": ("GPL-3.0", "d/z.py"), "d/w.py": (None, None), "top.py": (None, None), "d/long.py": (None, None),
    }
    assert licences.find_licences(files.limit(0)).count() == 0
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.queries()["op1_license_scan"](spark, SF).collect():
        assert (r["similarity"] is not None) == bool(re.search("MIT License|Apache License|CC BY-NC 4.0|GNU General", docs[r["doc_id"]]))


def test_licences_of_like_wording_are_told_apart(spark):
    gnu = "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public License as published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version."
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    clauses = [
        "Copyright (c) 2020, Someone\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.",
    ]
    third = "3. Neither the name of the copyright holder nor the names of its contributors\n   may be used to endorse or promote products derived from this software without\n   specific prior written permission."
    end = next(t for name, t in licences.TEMPLATES if name == "BSD-2-Clause").partition("distribution. ")[2]
    notices = {
        gnu.format("program", ":", "", ",", "3"): "GPL-3.0",
        gnu.format("program", ";", "", ";", "2"): "GPL-2.0",
        gnu.format("program", ":", "Affero ", ",", "3"): "AGPL-3.0",
        gnu.format("library", ";", "Lesser ", ";", "2.1"): "LGPL-2.1",
        gnu.format("library", ":", "Lesser ", ",", "3"): "LGPL-3.0",
        gnu.format("library", ";", "Library ", ";", "2"): "LGPL-2.0",
        gnu.format("program", ";", "", ";", "1"): None,
        cc.format(""): "CC-BY-4.0",
        cc.format("-ShareAlike"): "CC-BY-SA-4.0",
        cc.format("-NonCommercial"): "CC-BY-NC-4.0",
        cc.format("-NonCommercial-NoDerivatives"): "CC-BY-NC-ND-4.0",
        "This work is licensed under a Creative Commons Attribution 3.0 International License.": None,
        "\n\n".join([*clauses, end]): "BSD-2-Clause",
        "\n\n".join([*clauses, third, end]): "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted": "BSD-2-Clause OR BSD-3-Clause",
        "// SPDX-License-Identifier: MIT\nint x;": "MIT",
        "# SPDX-License-Identifier: GPL-2.0-only OR MIT": "GPL-2.0-only OR MIT",
        "This project is licensed under the MIT License - see the LICENSE file for details.": "MIT",
        "This project is licensed under the BSD License - see the LICENSE file for details.": None,
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.": "Apache-2.0",
        "Licensed under the Apache License, Version 1.1": None,
    }
    rows = [(f"n/{i}", t) for i, t in enumerate(notices)] + [(f"doc/{d}", t) for d, t in enumerate(r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect())]
    rows += [("twice", "Released under the"), ("twice", "MIT License"), ("twice", "Licensed under CC BY-SA 4.0")]
    found = {r["path"]: r["licence"] for r in licences.find_licences(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {t: found.get(f"n/{i}") for i, t in enumerate(notices)} == notices
    assert found["twice"] == "CC-BY-SA-4.0"


def test_licences_weigh_every_term_by_its_own_lines(spark, monkeypatch):
    """An ordinary word beside a notice must not sink it, however large the corpus; equal to a plain scorer."""
    filler = [f"by and see the plain w{i % 997} under v{i % 31}" for i in range(4000)] + [f"released mit license u{i}" for i in range(300)]
    asked = ["Released under the MIT License by", "Released under the MIT License by w1 v2", "Released under the MIT License qq1 qq2 qq3", "see the work licensed under a v. v1 v2", "by Released under the MIT License\nw5 w6 by\nsee"]
    asked += ["w1\n #\n# This program is free software: you can redistribute it and/or modify it\n# under the terms of the GNU General Public License as published by the Free Software\n# Foundation, either version 3 of the License, or any later version.\n\n# w2 by and"]
    asked += ["   Apache License\n  Version 2.0, January 2004\n http://www.apache.org/licenses/\n\n TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n1. Definitions."]
    texts = [(f"f/{i}", t) for i, t in enumerate([*filler, *asked])]
    cut = lambda t: re.findall(licences.TERM, t.lower())
    lines = [cut(x) for _, t in texts for p in re.split(licences.BREAK, t) for x in p.split("\n")]
    df = defaultdict(int)
    for x in lines:
        for w in set(x):
            df[w] += 1
    idf = lambda w: np.log((1 + len(lines)) / (1 + df[w]))
    vector = lambda ws: {w: ws.count(w) * idf(w) for w in set(ws)}
    norm = lambda v: np.sqrt(sum(x * x for x in v.values()))
    versions = lambda ws: {f"version {b}" for a, b in zip(ws, ws[1:]) if a in ("version", "v") and b.isdigit()}  # noqa: B905, E731
    told = lambda ws: {w for w in ws if w in licences.MARKS or re.fullmatch(r"\d{1,2}\.\d{1,2}", w)} | versions(ws)
    models = [(name, vector(cut(t)), told(cut(t))) for name, t in licences.TEMPLATES]
    want = {}
    for path, t in texts:
        for unit in [*(cut(x) for x in t.split("\n")), *(cut(x) for x in re.split(licences.BREAK, t)), cut(t)]:
            v, near = vector(unit), {}
            for name, m, own in models:
                if len(v.keys() & m.keys()) >= min(3, len(m)) and own == told(unit):
                    s = round(sum(v[w] * m[w] for w in v.keys() & m.keys()) / norm(v) / norm(m), 9)
                    if s >= 0.75 and s > near.get(name, 0):
                        near[name] = s
            first, second = (sorted(near.values(), reverse=True) + [0, 0])[:2]
            if first and first - second >= licences.MARGIN and round(first, 6) > want.get(path, ("", 0))[1]:
                want[path] = (max(near, key=near.get), round(first, 6))
    assert {f"f/{len(filler)}", f"f/{len(filler) + 4}"} <= want.keys() and f"f/{len(filler) + 2}" not in want
    assert want[f"f/{len(filler) + 5}"][0] == "GPL-3.0" and want[f"f/{len(filler) + 6}"][0] == "Apache-2.0"
    for usual in (2, 1000):
        monkeypatch.setattr(licences, "USUAL", usual)
        files = spark.createDataFrame(texts, "path string, text string")
        assert {r["path"]: (r["licence"], round(r["similarity"], 6)) for r in licences.find_licences(files).collect()} == want


def test_pipeline(spark, messy, none):
    import corpus_pipeline as line

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in line.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        rows = [(r["doc_id"], r["text"]) for r in before.collect()]
        if name == "MinHash near-dedup":
            groups = brute_near(rows, 5)
            assert {r["doc_id"] for r in docs.collect()} == {d for d, (_, c) in groups.items() if c == d}
        if name == "suffix-array dedup":
            want = {r[0]: r[2] for r in brute_bytes(rows)}
            kept = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert len(kept) == len(rows) and all(len(kept[d].encode()) <= len((t or "").encode()) - want[d] < len(kept[d].encode()) + 7 * (1 + want[d] // 100) for d, t in rows)
        if name != "SentencePiece encoding and decoding":
            assert docs.columns == line.COLUMNS
    assert docs.where("NOT round_trip").count() == 0 and docs.count() > 100
    for table in (messy, none):
        for _, stage in line.STAGES:
            table = stage(spark, table, SF).cache()
            table.count()
