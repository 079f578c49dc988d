"""BPE against the public library, hard negatives and lexical search against plain loops."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliplake.llm import bpe, hard_negatives, lexical_search
from cliplake.llm.queries import BPE_MODEL


@pytest.fixture(scope="module")
def encoder():
    with open(BPE_MODEL, encoding="utf-8") as file:
        return bpe.Encoder(bpe.Model(file.read()))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE_MODEL)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _split(ids, counts):
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


PARTS = [" ", "  ", "\n", "\t", "a", "aa", "the", "ing", "'s", "'ll", "'", "1", "2024", "é", "日本", "😀", "　",
         "\x1c", "\x85", "<|endoftext|>", "<|end", "THE", "...", "__", "x" * 40, "́", "ﬁ", "�", "\x00"]


def test_bpe_equals_library(encoder, library):
    pick = random.Random(5)
    texts = ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 50))) for _ in range(3000)]
    texts += ["".join(pick.choice("abcdeinothrs") for _ in range(pick.randint(0, 200))) for _ in range(1000)]
    texts += [None, "", "ab" * 20_000, "<|endoftext|>" * 3]
    want = [library.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert _split(*encoder.encode(texts)) == want
    assert 0 < encoder.failed < encoder.proposed


def test_bpe_equals_library_on_all_characters(encoder, library):
    texts = [f"a{chr(c)}a {chr(c)}{chr(c)} {chr(c)}1 \n{chr(c)}" for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    want = [one.ids for one in library.encode_batch(texts, add_special_tokens=False)]
    assert _split(*encoder.encode(texts)) == want


def test_bpe_long_texts_in_parts(encoder, monkeypatch):
    text = "some words, " * 500 + "\n\n  " + "x" * 3000
    whole = encoder.encode([text])[0].tolist()
    monkeypatch.setattr(bpe, "LISTED", 10)
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(bpe, "REMEMBERED_PAIRS", 3)
    assert encoder.encode([text])[0].tolist() == whole


def _tiny(merges, letters="abc"):
    import json

    names = {byte: name for name, byte in bpe.byte_names().items()}
    vocabulary = {names[byte]: byte for byte in range(256)}
    for left, right in merges:
        vocabulary.setdefault(left + right, len(vocabulary))
    return bpe.Model(json.dumps({
        "normalizer": None, "added_tokens": [],
        "pre_tokenizer": {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False},
        "model": {"vocab": vocabulary, "merges": [list(m) for m in merges]},
    }))


@pytest.mark.parametrize("seed", range(30))
def test_bpe_random_merges(seed):
    """Small vocabularies with many repeats and ties, also such whose merges are no trees."""
    pick = random.Random(seed)
    pieces, merges = list("abc"), []
    for _ in range(pick.randint(0, 14)):
        pair = pick.choice(pieces), pick.choice(pieces)
        if pair not in merges:
            merges.append(pair)
            pieces.append("".join(pair))
    encoder = bpe.Encoder(_tiny(merges))

    def plain(word):
        parts = list(word)
        while True:
            ranks = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
            if not ranks:
                return parts
            i = min(ranks)[1]
            parts[i : i + 2] = ["".join(parts[i : i + 2])]

    texts = ["".join(pick.choice("abc") for _ in range(pick.randint(1, 30))) for _ in range(200)]
    got = [[encoder.model.bytes[i].decode() for i in ids] for ids in _split(*encoder.encode(texts))]
    assert got == [plain(text) for text in texts]


def test_bpe_frames(spark):
    rows = [(1, "Hello <|endoftext|> wörld", "x"), (1, "Hello <|endoftext|> wörld", "x"), (2, None, None), (None, "", "y")]
    docs = spark.createDataFrame(rows, "found long, text string, row string")
    model = bpe.shared_model(spark, BPE_MODEL)
    encoded = bpe.encode(docs, model)
    back = bpe.decode(encoded.select("row.*", F.col("found.ids").alias("ids")), model).select("row.text", "found.text")
    got = sorted((tuple(r) for r in back.collect()), key=repr)
    assert got == sorted([(text, text or "") for _, text, _ in rows], key=repr)
    assert bpe.encode(docs.limit(0), model).count() == 0
    odd = spark.createDataFrame([([None, 50_256, 99_999_999, -1],), (None,), ([0xE9],)], "ids array<int>")
    assert [r[0] for r in bpe.decode(odd, model).select("found.text").collect()][:2] == ["<|endoftext|>", ""]


def test_bpe_spelling_gathers_bytes(encoder, monkeypatch):
    """Texts are gathered from flat ids, in pieces, without a Python object for each token."""
    monkeypatch.setattr(bpe, "SPELT", 5)
    pick, known = random.Random(3), encoder.model.bytes
    rows = [[pick.randint(-2, len(known) + 2) if pick.random() < 0.2 else pick.randrange(400) for _ in range(n)] for n in (0, 1, 9, 40, 0, 5)]
    plain = [b"".join(known[i] or b"" for i in row if 0 <= i < len(known)).decode("utf-8", "replace") for row in rows]
    flat = np.array([i for row in rows for i in row], np.int32)
    spelling = bpe.Spelling(encoder.model)
    assert spelling.texts(flat, np.array(list(map(len, rows)))) == plain
    assert any("\ufffd" in text for text in plain)
    assert spelling.texts(flat[:0], np.zeros(2, np.int64)) == ["", ""]


def _mined(rows, every, positives, negatives, low, high, scale):
    """rows: (id, vector, label), usable ones only, distinct ids."""
    out = []
    whole = {i: [math.floor(scale * x) for x in v] for i, v, _ in rows}
    label = {i: name for i, _, name in rows}
    for a in whole:
        if a % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(whole[a], whole[b])), b) for b in whole if b != a)
        own = [(-s, b) for s, b in ranked if label[b] == label[a]][:positives]
        for p, positive in own:
            fit = [(-s, b) for s, b in ranked if label[b] != label[a] and low * p <= 100 * -s <= high * p]
            out += [(a, positive, r, b, p, s) for r, (s, b) in enumerate(fit[:negatives], 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int"


def _result(found):
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("seed, dim, shard", [(0, 8, 1 << 20), (1, 5, 100), (2, 1, 37), (3, 16, 400)])
def test_hard_negatives(spark, monkeypatch, seed, dim, shard):
    monkeypatch.setattr(hard_negatives, "SHARD", shard)
    monkeypatch.setattr(hard_negatives, "BLOCK", 3 * dim)
    monkeypatch.setattr(hard_negatives, "CHUNK", 7)
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(5, dim))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + 0.3 * pick.normal(size=dim)], int(pick.integers(3))) for i in range(300)]
    # A third of the rows are one vector.
    rows = [(i, rows[0][1] if i % 3 == 0 else v, name) for i, v, name in rows]
    odd = [(400, None, 1), (500, [1.0] * dim, None), (600, [float("nan")] * dim, 1), (700, [float("inf")] * dim, 1),
           (800, [None] * dim, 1), (900, [1.0] * (dim + 1), 1), (1000, [], 1)]
    table = spark.createDataFrame(rows + odd, VECTORS).withColumn("score", F.lit(1)).repartition(3)
    found = hard_negatives.mine(table, F.col("vec_id") % 20 == 0, codewords=4)
    assert _result(found) == _mined(rows, 20, 5, 5, 80, 100, 256)


def test_hard_negatives_edges(spark):
    none = spark.createDataFrame([], VECTORS)
    every = F.col("vec_id") % 100 == 0
    assert hard_negatives.mine(none, every).collect() == []
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1)], VECTORS), every).collect() == []
    # Repeated ids are rows of their own; a row without an id is a negative like any other.
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (None, [0.9, 0.0], 2)]
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), every).collect()
    assert [tuple(r) for r in got] == [(0, 0, 1, None, 65536, 58880)] * 2
    # Beyond the whole numbers that doubles hold.
    rows = [(0, [3.0e7, 1.0], 1), (1, [3.0e7, 2.0], 1), (2, [3.0e7, 1.5], 2), (3, [2.0e37, 0.0], 2), (4, [3.0e37, 0.0], 1)]
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), every)
    assert _result(got) == [t[:4] + t[4:] for t in _clamped(rows)]


def _clamped(rows):
    last = 2**63 - 1
    whole = {i: [int(math.floor(256 * float(np.float32(x)))) for x in v] for i, v, _ in rows}
    label = {i: name for i, _, name in rows}
    ranked = sorted((-min(last, sum(x * y for x, y in zip(whole[0], whole[b]))), b) for b in whole if b)
    own = [(-s, b) for s, b in ranked if label[b] == label[0]][:5]
    out = []
    for p, positive in own:
        fit = [(-s, b) for s, b in ranked if label[b] != label[0] and 80 * p <= 100 * -s <= 100 * p]
        out += [(0, positive, r, b, p, s) for r, (s, b) in enumerate(fit[:5], 1)]
    return sorted(out)


def test_shard_visits_cells_in_order(spark):
    """Bounds fall, hold for every row of their cell, and all rows are visited once."""
    pick = np.random.default_rng(4)
    rows = [(i, pick.normal(size=6).tolist(), 0) for i in range(200)]
    chosen = hard_negatives.points(spark.createDataFrame(rows, VECTORS), "vec_id", "embedding", "label", F.lit(True))
    books = hard_negatives.codebooks(chosen, 256.0, 4)
    batch = hard_negatives.build(chosen.coalesce(1), books, 256.0).toArrow().to_batches()[0]
    shard = hard_negatives.Shard(batch, 0, books)

    class One:
        grid = shard.grid[:1]
        largest = float(np.abs(shard.grid).max())
        dots = [shard.grid[:1, :3] @ books[0].T, shard.grid[:1, 3:] @ books[1].T]
        norms = [np.linalg.norm(shard.grid[:1, :3], axis=1), np.linalg.norm(shard.grid[:1, 3:], axis=1)]

    visited, last = [], np.inf
    for bound, start, end in shard.visit(One, 0):
        assert bound <= last
        assert (shard.scores(np.arange(start, end), One, 0) <= bound).all()
        visited += range(start, end)
        last = bound
    assert sorted(visited) == list(range(len(shard.ids)))


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def _ranking(docs, items, k):
    texts = [(doc, _terms(text)) for doc, text in docs]
    texts = [(doc, terms) for doc, terms in texts if terms]
    n, total = len(texts), sum(len(terms) for _, terms in texts)
    df = {}
    for _, terms in texts:
        for term in set(terms):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for doc, terms in texts:
            m = 75 + (25 * len(terms) * n) // total
            score = 0
            for term in _terms(text):
                tf = terms.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed, bucket, block", [(0, 4096, 1 << 20), (1, 5, 20), (2, 1, 1 << 20), (3, 16, 40)])
def test_lexical_search(spark, monkeypatch, seed, bucket, block):
    monkeypatch.setattr(lexical_search, "BUCKET", bucket)
    monkeypatch.setattr(lexical_search, "BUCKET_ENTRIES", 40 if seed == 3 else 1 << 20)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "WORD", "word", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda n: " ".join(pick.choices(vocabulary, weights, k=n)) + pick.choice(["", ".", "-x"])
    docs = [(i, text(pick.randint(0, 40))) for i in range(200)]
    # A third of the documents are copies of one text.
    docs = [(i, docs[0][1] if i % 3 == 0 else t) for i, t in docs] + [(900, None), (901, ""), (902, "!?")]
    items = [(i, text(pick.randint(1, 12))) for i in range(9)] + [(50, None), (51, "..."), (52, "unseen")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x")).repartition(3)
    found = lexical_search.search(frame, spark.createDataFrame(items, "item_id long, text string"), k=7)
    assert _result(found) == _ranking(docs, items, 7)


def test_lexical_search_edges(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "three")], "doc_id string, text string")
    items = spark.createDataFrame([(None, "one ONE"), (1, "one"), (1, "one")], "item_id int, text string")
    got = lexical_search.search(docs, items, k=3).collect()
    assert sorted(((r["item"], r["rank"], r["id"]) for r in got), key=repr) == sorted(
        [(i, k, d) for i in (None, 1, 1) for k, d in ((1, "a"), (2, "b"), (3, None))], key=repr
    )
    for left, right in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        none = lexical_search.search(left, right)
        assert none.collect() == [] and none.columns == ["item", "rank", "id", "score"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    rows = [(1, "word " * 300_000), (2, "word"), (3, "x")]
    asked = [(1, "other " * 100 + "word")]
    found = lexical_search.search(spark.createDataFrame(rows, schema), spark.createDataFrame(asked, "item_id long, text string"))
    assert _result(found) == _ranking(rows, asked, 20)
