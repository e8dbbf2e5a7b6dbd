"""Fill-in-middle, near-duplicate vectors, collocations."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from feedlens.llm import collocations, fill_middle, vector_dedup

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, output string, form string, n int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "clash", "clash", 7) for i, t, lang in rows], DOCS)


def duck(**tables):
    connection = duckdb.connect()
    for name, table in tables.items():
        connection.register(name, table)
    return connection


def documents_table(rows):
    return pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
                     "lang": pa.array([r[2] for r in rows], pa.string())})


def bag(rows):
    return sorted(map(tuple, rows), key=str)


# ---- Fill-in-middle ------------------------------------------------------------------

SIGNS = ["a", "é", "😀", "<", "P", "S", "M", ">", "漢", "\n", " "]


def odd_texts(seed, n=200):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, 10**9), "".join(rnd.choices(SIGNS, k=rnd.choice([0, 1, 2, 7, 60]))), "en") for _ in range(n)]
    return rows + rows[:20] + [(1, None, None), (None, "abc", "x"), (5, "ab<P>cd", "en"), (6, "<M", "en"), (7, "P>x<S", "en")]


def test_middle_equals_the_sql(spark):
    rows = odd_texts(1)
    want = duck(documents=documents_table(rows)).execute(fill_middle.FILL_MIDDLE_SQL).fetchall()
    assert bag(fill_middle.digests(docs_of(spark, rows)).collect()) == bag(want)
    assert fill_middle.digests(docs_of(spark, rows).where("false")).collect() == []


def test_outputs_and_restored_texts(spark):
    rows = [(i, f"<{i}é" * 9, "en") for i in range(60)]
    got = {r["doc_id"]: r for r in fill_middle.restore(fill_middle.transform(docs_of(spark, rows))).collect()}
    assert {r["form"] for r in got.values()} == {"plain", "psm", "spm"}
    for i, text, _ in rows:
        r = got[i]
        assert r["restored"] == text and r["n"] == len(text)
        if r["form"] == "plain":
            assert r["output"] == text and r["prefix_chars"] is None
            continue
        a, b = r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]
        parts = {"P": text[:a], "M": text[a:b], "S": text[b:]}
        order = "PSM" if r["form"] == "psm" else "SPM"
        assert r["output"] == "".join(f"<{k}>{parts[k]}" for k in order)


@pytest.mark.parametrize("stretch,counted", [(1, 1), (7, 5), (1 << 20, 1 << 12)])
def test_displacements_by_stretches(monkeypatch, stretch, counted):
    monkeypatch.setattr(fill_middle, "STRETCH", stretch)
    monkeypatch.setattr(fill_middle, "COUNTED", counted)
    rows = odd_texts(2, 60)
    data, at = fill_middle._bytes_of(pa.array([r[1] for r in rows], pa.string()))
    form, counts, places = fill_middle.plan([r[0] for r in rows], data, at)
    assert counts[:, 0].tolist() == [len(r[1] or "") for r in rows]
    out, to = fill_middle.scatter(data, at, form, places)
    back, begin = fill_middle.gather(out, to, form)
    assert fill_middle._strings(back, begin).to_pylist() == [r[1] or "" for r in rows]


def test_a_very_long_text(spark):
    text = "漢字 и text, " * 700_000
    row = fill_middle.digests(docs_of(spark, [(4, text, "zh"), (3, "b", "en")])).where("doc_id = 4").first()
    assert row["n"] == len(text) and row["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# ---- Near-duplicate vectors ----------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, node bigint, links string"


def clusters(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(25):
        base = rng.normal(size=12)
        rows += [(base + rng.normal(size=12) * rng.choice([0, .1, .2, .3])).tolist() for _ in range(rng.integers(1, 40))]
    rows += [[1e200] * 12, [2e200] * 11 + [1.9e200], [1e-200] * 12, None, [], [0.0] * 12, [float("nan")] * 12,
             [float("inf")] * 12, [1.0, None] + [1.0] * 10, [1.0, 2.0], [1.0, 2.1], [-0.0, 1.0], [0.0, 1.0]]
    data = [(int(i), r) for i, r in zip(rng.permutation(len(rows)), rows)]
    return data + data[:7] + [(None, rows[0]), (3, rows[5])]


@pytest.mark.parametrize("block", [4096, 15])
def test_vector_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", block)
    data = clusters(5)
    df = spark.createDataFrame([(i, v, 1, 9, "x") for i, v in data], VECTORS)
    table = pa.table({"vec_id": pa.array([d[0] for d in data], pa.int64()),
                      "embedding": pa.array([d[1] for d in data], pa.list_(pa.float64()))})
    want = duck(embeddings=table).execute(vector_dedup.VECTOR_DEDUP_SQL).fetchall()
    got = vector_dedup.classes(df).collect()
    assert sum(r["n_links"] for r in got) > 1000
    assert bag(got) == bag(want)


def test_many_equal_vectors_are_compared_once(spark):
    data = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i), -1.0, 0.5]) for i in range(3000)]
    df = spark.createDataFrame([(i, v, 1, 9, "x") for i, v in data], VECTORS)
    got = {r["vec_id"]: r for r in vector_dedup.classes(df).collect()}
    assert all(got[i]["n_links"] == 1999 and got[i]["component_id"] == 1 for i in range(3000) if i % 3)
    assert vector_dedup.classes(df.where("false")).collect() == []


def test_tables_suffice_for_the_threshold():
    for n in (0, 1, 10**4, 10**9, 10**12):
        planes, tables = vector_dedup.planes_for(n)
        meet = (1 - np.arccos(vector_dedup.LINKED) / np.pi) ** planes
        assert (1 - meet) ** tables <= vector_dedup.MISSED


# ---- Collocations --------------------------------------------------------------------

def prose(seed, n=120):
    rnd = random.Random(seed)
    names = ["the", "Of", "und", "straße", "new", "york", "city", "a", "b", "ÄB", "i", "😀"]
    passage = "New York City of the Straße und so weiter und so fort"
    rows = []
    for i in range(n):
        words = [rnd.choice(names) + rnd.choice([" ", " ", "  ", "\t", ", ", ". ", "\n", "\v", "\x85", "\xa0"]) for _ in range(rnd.randint(0, 120))]
        text = "".join(words) + (passage if i % 3 == 0 else "") + ("the " * 40 if i % 10 == 0 else "")
        rows.append((i, text, rnd.choice(["en", "de", None, "und"])))
    return rows + rows[:15] + [(900, None, "en"), (901, "", None), (902, " .,;\n", "en"), (903, "the", "xx")]


@pytest.mark.parametrize("least,every,bits", [(5, 2, 1 << 26), (12, 16, 1 << 15)])
def test_collocations_equal_the_sql(spark, monkeypatch, least, every, bits):
    monkeypatch.setattr(collocations, "BITS", bits)
    rows = prose(3)
    sql = collocations.COLLOCATIONS_SQL.replace("f >= 100", f"f >= {least}")
    want = duck(documents=documents_table(rows)).execute(sql).fetchall()
    got = collocations.collocations(docs_of(spark, rows), least=least, every=every).collect()
    assert len(want) > 50 and bag(got) == bag(want)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(docs_of(spark, prose(1)).where("false")).collect() == []
    assert collocations.collocations(docs_of(spark, [(1, None, None), (2, "", "en")])).collect() == []


def test_equal_passages_are_cut_alike():
    rnd = random.Random(8)
    passage = " ".join(f"w{rnd.randint(0, 500)}" for _ in range(400))
    texts = [f"x{i} y{i} z{i} {passage} q{i}" for i in range(20)]
    table = collocations.chunks_of(pa.array(["en"] * 20), pa.array([t.encode() for t in texts], pa.large_binary()))
    counts = sorted(table.column("n").to_pylist())
    assert counts[-1] == 20 and sum(c == 20 for c in counts) > 10


def test_every_phrase_lies_in_one_chunk():
    rnd = random.Random(9)
    words = [rnd.choice("abcd") for _ in range(3000)]
    table = collocations.chunks_of(pa.array(["en"]), pa.array([" ".join(words).encode()], pa.large_binary()))
    found = {}
    for shared, chunk, n in zip(*(table.column(c).to_pylist() for c in ("shared", "chunk", "n"))):
        own = chunk.split(" ")
        for i in range(len(own) - shared):
            for size in range(1, min(5, len(own) - i) + 1):
                key = " ".join(own[i:i + size])
                found[key] = found.get(key, 0) + n
    want = {}
    for i in range(len(words)):
        for size in range(1, min(5, len(words) - i) + 1):
            key = " ".join(words[i:i + size])
            want[key] = want.get(key, 0) + 1
    assert found == want and table.num_rows > 50


def test_long_texts_are_read_in_stretches(monkeypatch):
    monkeypatch.setattr(collocations, "STRETCH", 50)
    text = "one two three, four five. " * 20
    batch = pa.record_batch({"lang": ["en"], "text": [text]})
    parts = [t[0].as_py() for _, t in collocations.stretches(batch)]
    assert b"".join(parts).decode() == text and len(parts) > 5 and all(p[-1:] in b",. " for p in parts)
