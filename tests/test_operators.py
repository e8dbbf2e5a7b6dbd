import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedlens import rules
from feedlens.operators import cleaning as C
from feedlens.operators import profile as R
from feedlens.operators import topn as N
from feedlens.operators import user_functions as K
from feedlens.operators.skew import hot_rows, join_by_key_counts
from feedlens.session import stored


@pytest.fixture(scope="module")
def feed(spark):
    """One channel holds most of the rows."""
    rng = random.Random(1)
    rows = [(i, "@big" if rng.random() < 0.6 else f"@c{rng.randint(0, 5)}", rng.randint(0, 50)) for i in range(3000)]
    rows.append((3000, None, 1))
    return rows, spark.createDataFrame(rows, "id bigint, channel_username string, views bigint")


def test_latest_n_is_exact_under_skew(spark, feed):
    rows, df = feed
    got = {(r["channel_username"], r["id"]) for r in N.latest_n_per_channel(df, 7).collect()}
    want = set()
    for channel in {r[1] for r in rows}:
        want |= {(channel, i) for i in sorted((r[0] for r in rows if r[1] == channel), reverse=True)[:7]}
    assert got == want
    ranked = N.top_n_per_group(df.select("channel_username", "id"), ["channel_username"], [F.desc("id")], ["id"], 7)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ties_and_salts(spark):
    df = spark.createDataFrame([(i, "a", 1) for i in range(50)], "id bigint, k string, v int")
    for salts in (1, 3, 64):
        got = N.top_n_per_group(df, ["k"], [F.desc("v"), F.asc("id")], ["id"], 4, salts=salts)
        assert sorted(r["id"] for r in got.collect()) == [0, 1, 2, 3]


def test_head_per_channel(feed):
    rows, df = feed
    got = N.head_per_channel(df, 5, ["@big", "@c1", "@none"]).collect()
    assert {r["channel_username"] for r in got} == {"@big", "@c1"} and len(got) == 10
    assert None not in {r["channel_username"] for r in N.head_per_channel(df, 5).collect()}


def test_filter_by_list_or_table(spark, feed):
    _, df = feed
    names = ["@c1", "@c2"]
    table = spark.createDataFrame([(n,) for n in names * 3], "channel_username string")
    assert sorted(C.channel_filter(df, names).select("id").collect()) == sorted(
        C.channel_filter(df, table).select("id").collect())


def test_first_rows(feed):
    _, df = feed
    assert [r["id"] for r in C.first_n(df, ["id"], 3).collect()] == [0, 1, 2]
    assert [tuple(r) for r in C.preview(df, ["id"], [F.desc("id")], 2).collect()] == [(3000,), (2999,)]


def test_text_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x  y")], "id bigint, message string")
    assert [r["id"] for r in C.drop_null_text(df).collect()] == [2, 3]
    assert [r["message"] for r in C.clean_messages(df).collect()] == ["x y"]
    views = C.default_views(df)
    assert all(50 <= r["views"] <= 5000 for r in views.collect())
    assert views.collect() == C.default_views(df.repartition(3)).orderBy("id").collect()
    assert C.default_views(views) is views


def test_default_entities(spark):
    text = "coffee machine\n500 ETB 0911223344\nBole road"
    df = spark.createDataFrame([(1, text), (2, None), (3, "only a name")], "id bigint, message string")
    rows = [[tuple(e) for e in r["entities"]] for r in C.default_entities(df, places=["Bole"]).collect()]
    assert rows[0] == [
        ("B-PRODUCT", "coffee machine", "500"), ("I-PRICE", "500 ETB", None),
        ("I-PHONE", "0911223344", None), ("I-LOC", "Bole", None)]
    assert rows[1] == [] and rows[2] == [("B-PRODUCT", "only a name", None)]


def test_message_record(spark):
    df = spark.createDataFrame(
        [("T", "@t", 1, " a\n b ", "d", True), ("T", "t", 2, None, "d", False)],
        "channel_title string, channel_username string, id bigint, message string, date string, has_photo boolean")
    assert [tuple(r) for r in C.message_record(df, "m").collect()] == [
        ("T", "@t", 1, "a b", "d", "m/t_1.jpg"), ("T", "t", 2, "", "d", None)]


def test_profile(spark):
    raw = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "channel_username string")
    clean = spark.createDataFrame([("a",), ("c",)], "channel_username string")
    assert [tuple(r) for r in R.channel_counts(raw).collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in R.raw_vs_clean(raw, clean).collect()] == [("a", 2, 1), ("b", 1, 0), ("c", 0, 1)]
    names = spark.createDataFrame(
        [(n,) for n in ("shop_a_1.jpg", "shop_b_2.jpg", "solo_3.jpg", "solo_4.png")], "image string")
    assert [tuple(r) for r in R.image_counts(names).collect()] == [("shop_a", 1), ("shop_b", 1), ("solo", 1)]
    assert [tuple(r) for r in R.image_counts(names, compat=True).collect()] == [("shop", 2), ("solo", 1)]


def test_hot_keys_join(spark):
    rng = random.Random(2)
    keys = ["hot" if rng.random() < 0.4 else f"k{rng.randint(0, 300)}" for _ in range(4000)]
    rows = spark.createDataFrame(list(enumerate(keys)), "id bigint, k string")
    lookup = stored(
        rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.upper("k")), "lookup")
    assert 1 <= hot_rows(lookup, max_keys=20).count() <= 20
    want = sorted((i, k, k.upper()) for i, k in enumerate(keys))
    for limit in (0, 1 << 20):
        joined = join_by_key_counts(rows, lookup, ["k"], max_keys=20, broadcast_bytes=limit)
        assert sorted(tuple(r) for r in joined.select("id", "k", "v").collect()) == want
    split = join_by_key_counts(rows, lookup, ["k"], max_keys=20, broadcast_bytes=0)
    assert "Union" in split._jdf.queryExecution().executedPlan().toString()


def test_user_functions(spark, feed):
    rows, df = feed
    doubled = df.select(K.apply_text_fn("channel_username", lambda t: t * 2).alias("x"))
    assert {r["x"] for r in doubled.collect()} == {r[1] and r[1] * 2 for r in rows}

    mapped = K.map_batches(df.select("id"), lambda b: pd.DataFrame({"id": b["id"], "y": b["id"] + 1}), "id bigint, y bigint")
    assert all(r["y"] == r["id"] + 1 for r in mapped.collect())

    result = K.apply_per_group(
        df.repartition(9), "channel_username",
        partial=lambda p: {"total": int(p["views"].sum()), "n": len(p)},
        merge=lambda s: {"total": int(s["total"].sum()), "n": int(s["n"].sum())},
        finish=lambda s: {"mean": s["total"] / s["n"]},
        state_schema="total bigint, n bigint", result_schema="mean double")
    got = {r["channel_username"]: r["mean"] for r in result.collect()}
    want = {r["channel_username"]: r["m"] for r in df.where("channel_username is not null")
            .groupBy("channel_username").agg(F.avg("views").alias("m")).collect()}
    assert got == pytest.approx(want)


def test_rule_tables():
    assert len(rules.LOCATIONS) == len(set(rules.LOCATIONS)) == 31
    assert rules.TAGS == sorted(rules.TAGS)


def test_user_aggregate_with_few_states_and_decimal_state(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(f"v{i % 50}", i) for i in range(1000)], "vendor string, views bigint")
    result = K.apply_per_group(
        df, "vendor", lambda p: {"t": Decimal(int(p["views"].sum())), "n": len(p)},
        lambda s: {"t": sum(s["t"], Decimal(0)), "n": int(s["n"].sum())}, lambda s: {"total": int(s["t"]), "n": s["n"]},
        "t decimal(30,10), n bigint", "total bigint, n bigint", max_states=3)
    want = {f"v{k}": (sum(range(k, 1000, 50)), 20) for k in range(50)}
    assert {r["vendor"]: (r["total"], r["n"]) for r in result.collect()} == want


def test_late_top_n_equals_a_sort_of_whole_rows(spark):
    import random

    rng = random.Random(9)
    rows = [(rng.choice(["@a", "@b", None]), rng.choice([None, *range(12)]), f"text {i}") for i in range(150)]
    df = spark.createDataFrame(rows, "channel_username string, id bigint, message string")
    for n in (1, 3, 20, 500):
        got = N.latest_n_per_channel(df, n).collect()
        assert got and all(tuple(r) in rows for r in got)
        for channel in ("@a", "@b", None):
            own = sorted((r[1] for r in rows if r[0] == channel), key=lambda x: -1 if x is None else x, reverse=True)
            assert sorted((r["id"] for r in got if r["channel_username"] == channel), key=str) == sorted(own[:n], key=str)
        assert len({r["message"] for r in got}) == len(got)
    assert N.latest_n_per_channel(df.where("false"), 3).collect() == []


def test_late_top_n_sorts_no_messages(spark, tmp_path):
    path = str(tmp_path / "messages")
    spark.range(100).select(F.lit("@a").alias("channel_username"), "id", F.col("id").cast("string").alias("message")).write.parquet(path)
    plan = N.latest_n_per_channel(spark.read.parquet(path), 5)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan


def test_labelling_run(spark, tmp_path):
    from feedlens.plans.labelling import run_labelling

    df = spark.createDataFrame([(1, "ቡና 500 ሻይ"), (2, None), (3, "abc"), (4, "ቡና\nቦሌ")], "id bigint, message string")
    counts = {r["label"]: r["tokens"] for r in run_labelling(df, str(tmp_path / "out")).collect()}
    assert counts == {"B-PRODUCT": 2, "I-PRODUCT": 2}


def test_text_function_holds_few_texts(spark, monkeypatch):
    from feedlens.operators import user_functions as K

    monkeypatch.setattr(K, "TEXTS_HELD", 7)
    df = spark.range(100).selectExpr("id", "if(id % 5 = 0, null, concat('t', id)) as t").coalesce(1)
    rows = df.select("id", K.apply_text_fn("t", lambda t: t + "!").alias("x"),
                     K.apply_text_fn("t", len, "bigint").alias("n")).collect()
    assert all(r["x"] == (None if r["id"] % 5 == 0 else f"t{r['id']}!") for r in rows)
    assert all(r["n"] == (None if r["id"] % 5 == 0 else len(f"t{r['id']}")) for r in rows)
    assert df.where("id < 0").select(K.apply_text_fn("t", len, "bigint")).count() == 0
