"""Neighbour search, preference formatting, and the pipeline."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.llm import neighbours, preferences

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int, part string, score string"


def plain_nearest(rows, k=5, every=50):
    out = set()
    for q, x in rows:
        if q % every:
            continue
        scored = [(-float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum()))), i) for i, y in rows if i != q]
        out |= {(q, i) for _, i in sorted(scored)[:k]}
    return out


def test_recall_on_a_whole_table(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    df = spark.read.parquet(path)
    got = neighbours.search(df).collect()
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in df.collect()]
    want = plain_nearest(rows)
    assert len(got) == len(want)
    assert len({(r["query_id"], r["vec_id"]) for r in got} & want) >= 0.9 * len(want)


def test_recall_with_many_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 150)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r["query_id"], r["vec_id"]) for r in neighbours.search(df).collect()}
    want = plain_nearest([(r["vec_id"], np.array(r["embedding"], float)) for r in df.collect()])
    assert len(got & want) >= 0.9 * len(want)


def test_unusable_vectors_ties_and_repeats(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]),
            (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, None]), (9, [1.0]), (None, [1.0, 0.0]),
            (1, [2.0, 0.0]), (10, []), (50, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "p", "s") for i, v in rows], VECTORS)
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 3), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 3)]
    scores = {r["vec_id"]: r["score"] for r in neighbours.search(df).where("query_id = 0").collect()}
    assert scores[1] == scores[2] == 1.0 and scores[50] == pytest.approx(math.sqrt(0.5), abs=1e-12)
    assert neighbours.search(df.where("false")).collect() == []


def test_many_equal_vectors_give_the_smallest_ids(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(3)
    same = rng.normal(size=16).astype(np.float32).tolist()
    rows = [(i, same if i % 3 else rng.normal(size=16).astype(np.float32).tolist(), 1, "", "") for i in range(600)]
    df = spark.createDataFrame(rows, VECTORS)
    got = {}
    for r in neighbours.search(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    for q in (50, 100, 200):
        assert [v for _, v in sorted(got[q])] == [i for i in range(600) if i % 3 and i != q][:5]


def test_parts_are_balanced():
    x = neighbours._unit(np.random.default_rng(0).normal(size=(1000, 8)))
    part = neighbours.balanced_parts(x, neighbours.neighbour_graph(x, 5), 8)
    assert np.bincount(part).max() <= math.ceil(1000 / 8 * neighbours.SLACK) and len(np.bincount(part)) == 8


# ---- Preferences ---------------------------------------------------------------------

TURNS = "conv_id bigint, turn int, role string, text string, id string, turns int, prompt string"


def test_longest_common_prefix_and_masks(spark):
    def turns(*pairs):
        return [{"role": r, "text": t} for r, t in pairs]

    common = [("system", "be brief"), ("user", "hi 😀")]
    rows = [(1, turns(*common, ("assistant", "héllo"), ("user", "more"), ("assistant", "ok")),
             turns(*common, ("assistant", "go away"))),
            (2, turns(*common), turns(*common)), (3, None, turns(("assistant", ""))), (4, None, None),
            (5, turns(("user", "a")), turns(("assistant", "a")))]
    kind = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame(rows, f"id int, chosen {kind}, rejected {kind}")
    got = {r["id"]: r for r in preferences.format_pairs(df, ["id"]).collect()}
    one = got[1]
    assert one["n_prompt_turns"] == 2 and one["prompt"].count("<|im_start|>") == 2
    spans = [tuple(map(int, s.split(":"))) for s in one["chosen_loss"].split(",")]
    assert [one["chosen"][a:b] for a, b in spans] == ["héllo", "ok"]
    assert one["rejected"][slice(*map(int, one["rejected_loss"].split(":")))] == "go away"
    assert (got[2]["n_prompt_turns"], got[2]["chosen"], got[2]["rejected"]) == (2, "", "")
    assert got[3]["rejected_loss"] == "" and got[3]["prompt"] == ""
    assert got[4]["n_prompt_turns"] == 0
    assert got[5]["n_prompt_turns"] == 0 and got[5]["chosen_loss"] == ""


def odd_turns(spark):
    rnd = random.Random(6)
    rows = []
    for conv in range(40):
        for turn in range(rnd.randint(1, 5)):
            rows.append((conv, rnd.choice([turn, turn, None, 1]), rnd.choice(["user", "assistant", None, "system"]),
                         rnd.choice(["a", "b", "", None, "x" * 20000, "é😀"]), "i", 1, "p"))
    return spark.createDataFrame(rows + rows[:5] + [(None, 1, "assistant", "lost", "", 1, "")], TURNS)


def test_odd_turns_equal_the_sql(spark):
    df = odd_turns(spark)
    connection = duckdb.connect()
    pdf = df.toPandas()
    import pyarrow as pa
    connection.register("conversations", pa.Table.from_pandas(pdf).cast(pa.schema([
        ("conv_id", pa.int64()), ("turn", pa.int32()), ("role", pa.string()), ("text", pa.string()),
        ("id", pa.string()), ("turns", pa.int32()), ("prompt", pa.string())])))
    want = connection.execute(preferences.PREFERENCES_SQL).fetchall()
    assert sorted(map(tuple, preferences.preferences(df).collect())) == sorted(want)
    assert preferences.preferences(df.where("false")).collect() == []


def test_main_path_is_native(spark):
    plan = preferences.preferences(odd_turns(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_prefix_length(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, 2, 4]), ([1], [1, 2]), ([], [1]), ([None, 2], [None, 2]), ([1], [2])],
                               "a array<int>, b array<int>")
    rows = df.select(preferences.common_turns(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r["n"] for r in rows] == [2, 1, 0, 2, 0]


# ---- Pipeline ------------------------------------------------------------------------

def test_stages_follow_each_other(spark):
    import corpus_pipeline

    from feedlens.llm import fertility, near_dedup
    from feedlens.session import stored

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, now, left = docs.columns, docs, []
    for name, stage in corpus_pipeline.STAGES:
        now = stored(stage(spark, now, SF), name)
        left.append(now)
        if name != "packing":
            assert now.columns == columns and now.dtypes == docs.dtypes
    kept = {r["doc_id"] for r in fertility.quality(docs).where("kept").collect()}
    assert {r["doc_id"] for r in left[0].collect()} == kept
    alone = {r["doc_id"] for r in near_dedup.classes(left[0]).where("kept").collect()}
    assert {r["doc_id"] for r in left[1].collect()} == alone
    assert {r["doc_id"] for r in left[3].collect()} == alone
    text = "\n".join(r["text"] for r in left[3].collect())
    assert "@mail" not in text and "<EMAIL>" in text
    assert {r["doc_id"] for r in left[4].collect()} == alone


def test_run_equals_the_stages(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF)
    now = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
    # Sequences are numbered by task; what they hold and how documents are cut may follow it.
    texts = lambda df: sorted((r["doc_id"], r["n"], r["tokens"]) for r in df.groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("tokens")).collect())
    assert texts(rows) == texts(now) and rows.columns == now.columns
    assert all(n == tokens for _, n, tokens in texts(rows))


def test_pipeline_of_odd_documents(spark):
    import corpus_pipeline

    prose = " ".join(f"word{i} and some more of it" for i in range(40))
    other = " ".join(f"another{i} sentence, quite unlike the first" for i in range(40))
    rows = [(1, prose), (2, prose), (2, prose), (3, None), (None, other), (4, ""), (5, other + " tail"), (5, "short"), (6, prose.upper())]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, text_ string, lang_ string, digest_ string, id_ int"
    now = spark.createDataFrame([(i, t, None, None, None, "x", "y", "z", 1) for i, t in rows], schema)
    for name, stage in corpus_pipeline.STAGES:
        columns = now.columns
        now = stage(spark, now, SF)
        if name != "packing":
            assert now.columns == columns
            assert all(r["n_chars"] == len(r["text"] or "") for r in now.collect() if r["n_chars"] is not None)
    assert {r["doc_id"] for r in now.collect()} <= {1, None, 5}


def test_pipeline_on_an_empty_table(spark):
    import corpus_pipeline

    now = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
    assert now.collect() == []
