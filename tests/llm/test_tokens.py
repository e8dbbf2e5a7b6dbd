"""Token counts, byte-level encoding and packing against the libraries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedlens.llm import byte_bpe, packing, token_counts
from feedlens.llm.common import SLICE_ROWS, documents, slices, vocabulary

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, n_tokens string, ids int, sequence_id string"
SIGNS = ["a", "b", "A", "É", "é", "́", "İ", "ß", "Σ", "ς", " ", "\n", "\x1c", "\x85", "\xa0", " ", "'s", "'LL",
         "1", "²", "٣", "<|endoftext|>", "<|startoftext|>", "<|", "日本", "😀", "\x00", "...", "ﬁ", "Ⅷ", "ΑΣ", "가"]


def odd_texts(n=400):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 25))) for _ in range(n)]
    return texts + [None, "", "   \n", "x" * 5000, "!?" * 2000, "word " * 30000, "é" * 3000]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "n", 1, "s") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame(rows + rows[:5] + [(None, "ab", None, None, None)], SCHEMA)


def library():
    return Tokenizer.from_file(vocabulary(token_counts.VOCABULARY))


def library_ids(text):
    return library_ids.known.encode(text or "", add_special_tokens=False).ids


library_ids.known = library()


def test_merged_length_merges_lowest_rank_first_and_equal_ranks_from_the_left():
    ranks, merged = {(1, 1): 0, (2, 1): 1}, [2, 3]
    assert token_counts.merged_length([1, 1, 1], ranks, merged) == 1  # 11 1 -> 2 1 -> 3
    assert token_counts.merged_length([1, 1, 1, 1], ranks, merged) == 2
    assert token_counts.merged_length([5], ranks, merged) == 1
    assert token_counts.merged_length([5, 6], ranks, merged) == 2


def test_counts_equal_the_library(odd):
    rows = token_counts.count_tokens(odd).collect()
    texts = {i: t for i, t in enumerate(odd_texts())} | {None: "ab"}
    assert len(rows) == odd.count()
    for row in rows:
        want = len(library_ids(texts[row["doc_id"]]))
        assert (row["n_tokens"], row["over_limit"]) == (want, want > 2048)
        assert row["n_bytes"] == len((texts[row["doc_id"]] or "").encode())


def test_query_counts_equal_the_library(spark):
    from feedlens.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    assert got == {i: len(library_ids(t)) for i, t in docs.items()}


def test_capitals_whose_small_letter_lies_above_the_plain_range(spark):
    capitals = [chr(c) for c in range(0x250) if chr(c).isalpha() and max(chr(c).lower()) >= "\u0250"]
    assert len(capitals) >= 20
    texts = ["SHAIƊA", "Ɓera", "HAƊARI", "GAƁA", *(f"AB{c}CD {c}x x{c}" for c in map(chr, range(0x80, 0x250))), *capitals]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df).collect()}
    assert got == {i: len(library_ids(t)) for i, t in enumerate(texts)}
    assert check_packing(packing.pack_documents(df).collect(), dict(enumerate(texts)), packing.Limits()) < 1


def test_empty_tables(spark, odd):
    none = odd.where("false")
    for fn in (token_counts.count_tokens, packing.pack_documents, byte_bpe.encode, byte_bpe.encode_digests):
        assert fn(none).collect() == []


def test_remembering_little_changes_no_count(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    counts = token_counts.PartCounts(vocabulary(token_counts.VOCABULARY))
    text = "one two three four five six one two seven eight nine one"
    assert sum(counts[p] for p in text.encode().split()) == len(library_ids(text))
    assert len(counts) <= 3


def test_byte_ids_equal_the_library_and_decode_to_the_text(odd):
    bpe = byte_bpe.byte_bpe(vocabulary(byte_bpe.VOCABULARY))
    texts = dict(enumerate(odd_texts())) | {None: "ab"}
    for row in byte_bpe.encode(odd).collect():
        text = texts[row["doc_id"]] or ""
        assert row["ids"] == bpe.check.encode_ordinary(text)
        assert bpe.decode(row["ids"]) == text
        assert len(row["starts"]) == len(row["ids"])


def test_offsets_point_at_the_character_of_each_id(spark):
    df = spark.createDataFrame([(1, "a 日本😀 b")], "doc_id bigint, text string")
    row = byte_bpe.encode(df).first()
    bpe = byte_bpe.byte_bpe(vocabulary(byte_bpe.VOCABULARY))
    at = 0
    for i, start in zip(row["ids"], row["starts"]):
        assert start == len("a 日本😀 b".encode()[:at].decode("utf-8", errors="ignore"))
        at += len(bpe.token_bytes[i])


def test_decoding_cut_characters(spark):
    bpe = byte_bpe.byte_bpe(vocabulary(byte_bpe.VOCABULARY))
    ids = bpe.encode("\U0001F9FF").tolist()
    assert len(ids) > 1
    assert bpe.decode(ids) == "\U0001F9FF"
    assert "�" in bpe.decode(ids[:1])
    df = spark.createDataFrame([(1, ids), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in byte_bpe.decode(df).collect()} == {1: "\U0001F9FF", 2: None, 3: ""}


def test_byte_table_is_a_bijection():
    from feedlens.llm.byte_table import byte_characters

    assert len(set(byte_characters())) == 256


def check_packing(rows, texts, limits):
    ids_of = {i: np.array(library_ids(t) + [2], "<u4") for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        part = ids_of[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["ids_crc32"] == zlib.crc32(part.tobytes())
        assert r["doc_tokens"] == len(ids_of[r["doc_id"]])
    assert set(by_doc) == set(ids_of)
    for doc, pieces in by_doc.items():
        copies = sum(p["length"] for p in pieces) // len(ids_of[doc])
        starts = sorted((p["start"], p["length"]) for p in pieces)
        assert sum(p["length"] for p in pieces) == copies * len(ids_of[doc])
        if copies == 1:
            at = 0
            for start, length in starts:
                assert start == at
                at += length
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limits.tokens and len(pieces) <= limits.segments
        assert sum(p["loss_tokens"] for p in pieces) <= limits.loss
        total += at
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding / max(1, total)


def test_packing_places_each_id_once(spark, odd):
    rows = packing.pack_documents(odd.where("doc_id is not null")).collect()
    assert check_packing(rows, dict(enumerate(odd_texts())), packing.Limits()) < 0.01


def test_packing_query(spark):
    from feedlens.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect()}
    rows = QUERIES["op6_packing"](spark, SF).collect()
    assert check_packing(rows, docs, packing.Limits()) < 0.01


@pytest.mark.parametrize("limits", [packing.Limits(64, 3, 64), packing.Limits(64, 100, 20), packing.Limits(16, 1, 9)])
def test_all_limits_hold_at_once(limits):
    rnd = np.random.default_rng(1)
    packer = packing.Packer(limits)
    lengths = rnd.integers(1, 90, 200)
    flags = [rnd.integers(0, 2, n) if i % 2 else None for i, n in enumerate(lengths)]
    for i, n in enumerate(lengths):
        packer.add(i, int(n), flags[i])
    placed = list(packer.pack(500)) + list(packer.flush())
    seen = {}
    for key, start, length, loss, sequence, offset in placed:
        seen.setdefault(sequence, []).append((offset, length, loss))
        own = flags[key]
        assert loss == (length - 1 if own is None else own[start:start + length].sum())
    for pieces in seen.values():
        assert sum(p[1] for p in pieces) <= limits.tokens and len(pieces) <= limits.segments
        assert sum(p[2] for p in pieces) <= limits.loss
        assert sorted(p[0] for p in pieces) == [0, *np.cumsum([p[1] for p in sorted(pieces)])[:-1]]
    covered = sorted((k, s, n) for k, s, n, *_ in placed)
    for key, n in enumerate(lengths):
        own = [(s, m) for k, s, m in covered if k == key]
        assert sum(m for _, m in own) == n and [s for s, _ in own] == [0, *np.cumsum([m for _, m in own])[:-1]]


def test_an_impossible_limit_is_an_error():
    packer = packing.Packer(packing.Limits(4, 1, 0))
    packer.add(0, 10, np.ones(10, int))
    with pytest.raises(ValueError):
        list(packer.pack(0))


def test_slices_bound_rows_and_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array(["x" * 10000] * 5000)], names=["a", "t"])
    parts = list(slices(batch))
    assert sum(p.num_rows for p in parts) == 5000 and max(p.num_rows for p in parts) <= SLICE_ROWS
    assert pa.Table.from_batches(parts).column("a").to_pylist() == list(range(5000))


def test_packing_again_gives_the_same(spark):
    df = documents(spark, SF).where(F.col("doc_id") < 50)
    first, second = (sorted(map(tuple, packing.pack_documents(df).collect())) for _ in range(2))
    assert first == second
