"""Sizes, limits and odd inputs of the corpus operators."""

import random
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedlens.llm import common, fertility, language, neighbours, packing, suffix_dedup
from feedlens.llm.common import documents, vocabulary

SF = "/root/testdata/sf0.001"


# ---- Packing -------------------------------------------------------------------------

def packed(limits, lengths, flags=None):
    packer = packing.Packer(limits)
    for i, n in enumerate(lengths):
        packer.add(i, int(n), None if flags is None else flags[i])
    sequences = {}
    for key, start, length, loss, sequence, offset in [*packer.pack(500), *packer.flush()]:
        sequences.setdefault(sequence, []).append((offset, length, loss, key, start))
    return sequences


def test_words_are_normalised_once():
    path = vocabulary(packing.VOCABULARY)
    library = packing.part_ids(path).rule.library
    marks = {}
    for c in range(0x300, 0x1E00):
        marks.setdefault(unicodedata.combining(chr(c)), chr(c))
    capitals = [chr(c) for c in range(0x41, 0x600) if chr(c).isupper()]
    texts = [c + m + "stanbul" for c in capitals for k, m in marks.items() if k] + ["\u0130\u0327stanbul"]
    assert len(texts) > 10_000
    for text, ids in zip(texts, packing.document_ids(pa.array(texts), path, 2)):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("low,high,n", [(1, 10, 30_000), (10, 10, 10_000), (3, 3, 5000), (1, 1, 5000)])
def test_short_documents_leave_little_padding(low, high, n):
    lengths = np.random.default_rng(1).integers(low, high + 1, n)
    sequences = packed(packing.Limits(), lengths)
    padding = 0
    for pieces in sequences.values():
        size = sum(p[1] for p in pieces)
        assert len(pieces) <= packing.MAX_SEGMENTS and size <= packing.MAX_TOKENS
        padding += 0 if size & (size - 1) == 0 else packing.MAX_TOKENS - size
    assert padding <= 0.01 * lengths.sum()
    assert sum(p[1] for s in sequences.values() for p in s) == lengths.sum()


def test_each_limit_binds():
    rnd = np.random.default_rng(2)
    lengths = rnd.integers(1, 60, 400)
    flags = [rnd.integers(0, 2, n) for n in lengths]

    def most(limits):
        found = packed(limits, lengths, flags).values()
        return [max(f(s) for s in found) for f in (lambda s: sum(p[1] for p in s), len, lambda s: sum(p[2] for p in s))]

    assert most(packing.Limits(64, 1000, 1000))[0] == 64
    assert most(packing.Limits(1 << 20, 9, 1 << 20))[1] == 9
    tokens, segments, loss = most(packing.Limits(512, 1000, 40))
    assert loss == 40 and tokens < 512


def test_loss_spans(spark):
    path = vocabulary(packing.VOCABULARY)
    text = "Question: what? Answer: ቡና coffee 😀 end"
    at = text.index("Answer")
    rows = [(1, text, [(at, at + 15)]), (2, text, []), (3, text, None), (4, text, [(0, 999)]), (5, None, [(0, 5)]), (6, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans array<struct<start:bigint,end:bigint>>")
    found = {r["doc_id"]: r for r in packing.pack_documents(df.coalesce(1), loss_col="spans").collect()}
    encoded = packing.part_ids(path).rule.library.encode(text, add_special_tokens=False)
    n = len(encoded.ids) + 1
    assert found[1]["loss_tokens"] == sum(at <= a < at + 15 for a, _ in encoded.offsets) > 0
    assert [found[i]["loss_tokens"] for i in (2, 3, 4, 5, 6)] == [0, n - 1, n, 0, 0]
    assert {r["doc_tokens"] for i, r in found.items() if i < 5} == {n} and found[5]["doc_tokens"] == 1
    crc = zlib.crc32(np.array([*encoded.ids, 2], "<u4").tobytes())
    whole = [r for r in found.values() if r["length"] == n]
    assert whole and all(r["ids_crc32"] == crc for r in whole)


# ---- What workers remember -----------------------------------------------------------

def test_memory_is_bounded_by_bytes():
    def held(memo):
        return sum(len(k) + len(v) + common.ENTRY_BYTES for d in (memo, memo.old) for k, v in d.items())

    memo = common.Memo(lambda parts: [p[:4] for p in parts], 1 << 20)
    rnd = random.Random(1)
    for k in range(60):
        texts = [[rnd.randbytes(rnd.choice([3, 30, 250, 600])) for _ in range(100)] for _ in range(5)]
        assert memo.of(texts + texts[:1]) == [[p[:4] for p in t] for t in texts + texts[:1]]
        assert held(memo) <= 2.2 * (1 << 20)
    assert not any(len(p) > common.LONG_PART for p in [*memo, *memo.old])


def test_parts_are_those_of_a_split(monkeypatch):
    rnd = random.Random(7)
    texts = ["", " ", "a", " a", "a\n", None, "ab cd\tef\v\f\r x", *["".join(rnd.choices("ab é\u00a0\n \x1c", k=30)) for _ in range(50)]]
    found = common.Parts.of(pa.array(texts))
    at = 0
    for text, end in zip(texts, found.ends):
        assert [p for c in found.code[at:end] if (p := found.names[c])] == (text or "").encode().split()
        at = end
    assert common.Parts.of(pa.array([], pa.string())).names == []
    monkeypatch.setattr(common, "SLICE_BYTES", 10)
    for text in ("a" * 50, "ab cd\tef\n é" * 20, " " * 35):
        stretches = list(common.parts_of(pa.array([text])))
        assert [p for s in stretches for c in s.code if (p := s.names[c])] == text.encode().split()
        assert len(stretches) > 1 or " " not in text


def test_long_texts_count_and_pack_as_the_library(spark):
    text = "Ein Satz und noch ein Satz, ቡና İ 123. " * 260_000  # 11 MB
    from feedlens.llm import token_counts

    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = token_counts.count_tokens(df).first()
    path = vocabulary(packing.VOCABULARY)
    once = len(packing.part_ids(path).rule.library.encode("Ein Satz und noch ein Satz, ቡና İ 123. ", add_special_tokens=False).ids)
    assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), 260_000 * once)
    assert packing.pack_documents(df).agg(F.sum("length")).first()[0] == 260_000 * once + 1


@pytest.mark.parametrize("windows", [1, 7, 64])
def test_anchors_by_stretches(monkeypatch, windows):
    rnd = random.Random(4)
    texts = [bytes(rnd.choices(rnd.choice([b"ab", b"a", range(256)]), k=n)) for n in (0, 49, 50, 51, 76, 300, 900) for _ in range(4)]
    whole = [suffix_dedup.anchors(t) for t in texts]
    monkeypatch.setattr(suffix_dedup, "WINDOWS", windows)
    for text, want in zip(texts, whole):
        assert all(np.array_equal(a, b) for a, b in zip(suffix_dedup.anchors(text), want))


# ---- Neighbours ----------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>"


def test_huge_and_tiny_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [2.0, 2.0]), (2, [1e-200, 1e-200]), (3, [1e200, -1e200]), (4, [5e-324, 0.0]),
            (50, [-1e-200, 1e-200])]
    got = neighbours.search(spark.createDataFrame(rows, VECTORS)).orderBy("query_id", "rank").collect()
    found = [(r["query_id"], r["vec_id"]) for r in got]
    assert set(found[:2]) == {(0, 1), (0, 2)}  # equal but for the last digit
    assert found[2:] == [(0, 4), (0, 3), (0, 50), (50, 0), (50, 1), (50, 2), (50, 4), (50, 3)]
    scores = {(r["query_id"], r["vec_id"]): r["score"] for r in got}
    assert scores[0, 1] == pytest.approx(1) and scores[0, 2] == pytest.approx(1) and scores[50, 3] == pytest.approx(-1)
    assert scores[0, 4] == pytest.approx(0.5 ** 0.5)


def test_vectors_of_rarer_lengths_meet_their_own(spark):
    rows = [(i, [float(i % 7 + 1), 1.0, 2.0]) for i in range(1, 40)] + [(100, [1.0, 2.0]), (101, [1.0, 2.1]), (102, [-1.0, 0.0])]
    got = neighbours.search(spark.createDataFrame(rows, VECTORS)).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(100, 101), (100, 102)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_small_tables_are_searched_by_parts(spark, monkeypatch, sf):
    routers = []
    fit = neighbours.fit_router
    monkeypatch.setattr(neighbours, "fit_router", lambda *a: routers.append(fit(*a)) or routers[-1])
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    got = {(r["query_id"], r["vec_id"]) for r in neighbours.search(df).collect()}
    assert 1 < routers[0].probes < routers[0].parts
    x = np.array([r["embedding"] for r in df.orderBy("vec_id").collect()], float)
    ids = [r["vec_id"] for r in df.select("vec_id").orderBy("vec_id").collect()]
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    want = set()
    for k, q in enumerate(ids):
        if q % 50 == 0:
            near = x @ x[k]
            near[k] = -2
            want |= {(q, ids[j]) for j in np.argsort(-near, kind="stable")[:5]}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


# ---- Language and quality ------------------------------------------------------------

def test_languages_of_equal_rows_are_learned(spark):
    rows = [(1, "the quick brown fox jumps", "en"), (2, "over the lazy dog again", "en")]
    for k, text in enumerate(["der schnelle braune fuchs", "le renard brun saute", "el zorro salta rápido", "la volpe salta svelta", "de snelle vos springt"]):
        rows += [(10 + k, text, f"l{k}")] * 1000
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert language.fit(df).languages == ["en", "l0", "l1", "l2", "l3", "l4"]


def test_predictions_equal_a_plain_computation(spark):
    docs = documents(spark, SF)
    rows = docs.withColumn("held_out", language.held_out()).collect()
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    own = docs.where(~language.held_out()).select("doc_id", F.col("text").alias("text_"), "lang")
    ranks = {r["doc_id"]: r["rank"] for r in language.sample(own.where("lang is not null"), "doc_id", "lang", language.SAMPLE_PER_LANGUAGE).collect()}
    learned = [r for r in rows if r["doc_id"] in ranks]
    assert len(learned) > 100 and not any(r["held_out"] for r in learned)
    languages = sorted({r["lang"] for r in learned})
    each = max(language.LANDMARKS_PER_LANGUAGE, -(-language.LANDMARKS // len(languages)))

    def grams(text):
        return {int(b) for some in language.gram_buckets(language.letters(text)) for b in some}

    def kernel(a, b):
        return len(a & b) / np.sqrt(len(a) * len(b))

    sets = {r["doc_id"]: grams(r["text"]) for r in rows}
    marks = [r["doc_id"] for r in sorted((r for r in learned if ranks[r["doc_id"]] <= each), key=lambda r: (r["lang"], ranks[r["doc_id"]]))]
    near = np.array([[kernel(sets[r["doc_id"]], sets[m]) for m in marks] for r in rows])
    values, vectors = np.linalg.eigh(np.array([[kernel(sets[a], sets[b]) for b in marks] for a in marks]))
    good = values > 1e-6 * values.max()
    features = near @ vectors[:, good] / np.sqrt(values[good])
    train = np.array([r["doc_id"] in ranks for r in rows])
    target = np.array([[1.0 if r["lang"] == x else -1.0 for x in languages] for r in rows])
    phi = features[train]
    outputs = features @ np.linalg.solve(phi.T @ phi + language.RIDGE * np.eye(phi.shape[1]), phi.T @ target[train])
    for r, out in zip(rows, outputs):
        if not sets[r["doc_id"]]:
            continue
        assert got[r["doc_id"]]["score"] == pytest.approx(min(1, max(0, (out.max() + 1) / 2)), abs=2e-3)
        if np.sort(out)[-1] - np.sort(out)[-2] > 1e-2:
            assert got[r["doc_id"]]["lang_pred"] == languages[int(out.argmax())]


def test_verdicts_do_not_depend_on_other_documents_or_partitions(spark):
    docs = documents(spark, SF).select("doc_id", "text", "lang")
    alone = {r["doc_id"]: r["kept"] for r in fertility.quality(docs).collect()}
    other = spark.range(60_000).select((F.col("id") + 10**6).alias("doc_id"), F.lit("żółw " * 30).alias("text"), F.lit("pl").alias("lang"))
    both = fertility.quality(docs.unionByName(other).repartition(7)).where("doc_id < 1000000")
    assert {r["doc_id"]: r["kept"] for r in both.collect()} == alone
