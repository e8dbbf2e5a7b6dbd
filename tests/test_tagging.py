import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedlens import rules
from feedlens.operators import dataset as D
from feedlens.operators import entities as E
from feedlens.operators import tagging as G
from feedlens.plans import tagging as T

from test_pieces_and_spans import spans_by_hand

VOCABULARY = ["coffee", "toffee", "500", "0911223344", "ቦሌ", "birr", "road", "broad", "in", "on", "ቡና"]


@pytest.fixture(scope="module")
def sentences(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choice(VOCABULARY) + rng.choice(["", "s", "x"]) for _ in range(rng.randint(0, 6)))
                 for _ in range(rng.randint(0, 4))]
        rows.append((i, "\n".join([*lines, f"{'abc'[i % 3]}{i}ffees {i}z"])))
    return D.label_sentences(spark.createDataFrame(rows, "id bigint, text string"))


@pytest.fixture(scope="module")
def tokens(sentences):
    return T.split_tokens(D.token_rows(sentences))


def keys_of(feature, row):
    return {"token": row["token"], "suffix": row["token"][-3:],
            "prev_token": row["previous"] + "\t" + row["token"], "prior": ""}[feature]


class ByHand:
    """The same tagger with dictionaries."""

    def __init__(self, rows, features):
        self.features = [*features, "prior"]
        self.counts = defaultdict(Counter)
        for r in rows:
            for f in self.features:
                self.counts[f, keys_of(f, r)][r["label"]] += 1

    def scores(self, row):
        for f in self.features:
            c = self.counts.get((f, keys_of(f, row)))
            if c:
                total = sum(c.values())
                return [(c[t] + 1) / (total + len(rules.TAGS)) for t in rules.TAGS]


@pytest.mark.parametrize("variant", list(G.VARIANTS))
def test_tagger_against_dictionaries(tokens, variant):
    train, test = T.train_part(tokens).collect(), T.test_part(tokens).collect()
    assert train and test
    model = ByHand(train, G.VARIANTS[variant])
    rows = T.tag_test_part(tokens, variant).collect()
    assert len(rows) == len(test)
    assert {r["token"] for r in test} - {r["token"] for r in train}
    loss, by_sid = 0.0, defaultdict(list)
    for r in rows:
        scores = model.scores(r)
        assert list(r["scores"]) == pytest.approx(scores)
        assert r["prediction"] == rules.TAGS[scores.index(max(scores))]
        assert r["score"] == pytest.approx(max(scores))
        loss -= math.log(scores[rules.TAGS.index(r["label"])])
        by_sid[r["sid"]].append((r["pos"], r["label"], r["prediction"]))
    truth, guess = set(), set()
    for sid, items in by_sid.items():
        items.sort()
        truth |= {(sid, *s) for s in spans_by_hand([x[1] for x in items])}
        guess |= {(sid, *s) for s in spans_by_hand([x[2] for x in items])}
    result = G.evaluate(T.tag_test_part(tokens, variant)).first()
    assert result["eval_loss"] == pytest.approx(loss / len(rows), abs=1e-6)
    assert result["eval_f1"] == pytest.approx(2 * len(truth & guess) / (len(truth) + len(guess)), abs=1e-6)


def test_shuffled_lookup_gives_the_same_tags(tokens, monkeypatch):
    whole = T.tag_test_part(tokens).select("sid", "pos", "prediction", "score")
    import feedlens.operators.tagging as module

    monkeypatch.setattr(
        module, "join_by_key_counts",
        lambda rows, lookup, keys: _split_join(rows, lookup, keys))
    split = T.tag_test_part(tokens).select("sid", "pos", "prediction", "score")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect()))


def _split_join(rows, lookup, keys):
    from feedlens.operators.skew import join_by_key_counts

    return join_by_key_counts(rows, lookup, keys, max_keys=5, broadcast_bytes=0)


def test_model_scores_sum_to_one(tokens):
    model = G.train_tagger(T.train_part(tokens), ["token", "suffix"])
    sums = G.model_rows(model).groupBy("feature", "key").agg(F.sum("score").alias("s"), F.sum("n").alias("n"), F.first("total").alias("t"))
    assert sums.where("abs(s - 1) > 1e-9 or n <> t").count() == 0


def test_untrained_model_is_even(spark, tokens):
    model = G.train_tagger(T.train_part(tokens).where("false"), ["token"])
    row = G.apply_tagger(T.test_part(tokens), model, ["token"]).first()
    assert list(row["scores"]) == pytest.approx([1 / 6] * 6) and row["prediction"] == rules.TAGS[0]


def test_argmax_takes_the_first_of_equal_scores(spark):
    df = spark.createDataFrame(
        [(1, 0, "b", 2, 0.4), (1, 0, "a", 1, 0.4), (1, 0, "c", 0, 0.2)], "sid int, pos int, label string, label_id int, score double")
    assert G.argmax_labels(df, ["sid", "pos"]).first()["label"] == "a"


def test_comparison_table(tokens):
    table = T.compare_models(tokens)
    rows = table.collect()
    assert table.columns == ["model", "eval_loss", "eval_f1"]
    assert [r["eval_f1"] for r in rows] == sorted((r["eval_f1"] for r in rows), reverse=True)
    timed = T.compare_models(tokens, timed=True)
    assert timed.columns == ["model", "eval_loss", "eval_f1", "runtime"]
    assert [tuple(r)[:3] for r in timed.collect()] == [tuple(r) for r in rows]


def test_tag_new_texts(spark, tokens):
    features = G.VARIANTS["token+suffix"]
    model = G.store_model(G.train_tagger(T.train_part(tokens), features))
    texts = spark.createDataFrame([(1, "coffee 500 birr"), (2, "")], "id bigint, text string")
    rows = T.tag_texts(texts, model, features).orderBy("sid", "pos").collect()
    assert [r["token"] for r in rows] == ["coffee", "500", "birr"]
    assert all(r["prediction"] in rules.TAGS and 0 < r["score"] < 1 for r in rows)


def test_group_entities(spark):
    rows = [(1, 0, "big", "B-PRODUCT", 0.9), (1, 1, "pot", "I-PRODUCT", 0.7), (1, 2, "in", "O", 0.99),
            (1, 3, "ቦሌ", "I-LOC", 0.6), (2, 0, "x", "O", 0.9), (3, 0, "a", "B-LOC", 0.5), (3, 1, "b", "B-LOC", 0.7)]
    df = spark.createDataFrame(rows, "sid int, pos int, token string, prediction string, score double")
    got = [tuple(r) for r in E.group_entities(df).orderBy("sid", "start").collect()]
    want = [(1, "PRODUCT", "big pot", 0.8, 0, 7), (1, "LOC", "ቦሌ", 0.6, 11, 13),
            (3, "LOC", "a", 0.5, 0, 1), (3, "LOC", "b", 0.7, 2, 3)]
    assert [(g[0], g[1], g[2], round(g[3], 9), g[4], g[5]) for g in got] == want

    texts = {r["sid"]: r for r in E.texts_with_entities(df).collect()}
    assert {s: r["text"] for s, r in texts.items()} == {1: "big pot in ቦሌ", 2: "x", 3: "a b"}
    for sid, r in texts.items():
        assert [(sid, e["entity"], e["word"], e["start"], e["end"]) for e in r["entities"]] == [
            (w[0], w[1], w[2], w[4], w[5]) for w in want if w[0] == sid]
        assert all(r["text"][e["start"]:e["end"]] == e["word"] for e in r["entities"])
    report = E.entity_report(E.texts_with_entities(df))
    assert report.columns == ["text", "word", "label", "score"] and report.count() == 4
    flags = E.low_confidence(df.select("sid").distinct(), E.group_entities(df))
    assert {r["sid"]: r["flagged"] for r in flags.collect()} == {1: False, 2: True, 3: False}
    plan = E.texts_with_entities(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_one_pass_gives_what_single_passes_give(tokens):
    model = T.train_model(tokens, list(G.VARIANTS))
    together = {r["model"]: tuple(r)[1:] for r in G.evaluate_variants(T.test_part(tokens), model, G.VARIANTS).collect()}
    for variant in G.VARIANTS:
        alone = G.evaluate(T.tag_test_part(tokens, variant, model=model)).first()
        assert together[variant] == pytest.approx(tuple(alone), abs=2e-6)


def test_variants_share_the_exchange_on_sentences(tokens):
    model = T.train_model(tokens, list(G.VARIANTS))
    plan = G.evaluate_variants(T.test_part(tokens), model, G.VARIANTS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(sid") == 1 and "CartesianProduct" not in plan


def test_offsets_lie_in_the_message(spark):
    rng = random.Random(3)
    gaps = [" ", "  ", "\n", "\t \n", "\u00a0", " \u2003 "]
    rows = []
    for i in range(60):
        text = rng.choice(["", " ", "\n\n", "😀 "])
        for _ in range(rng.randint(1, 30)):
            text += rng.choice(VOCABULARY + ["😀x", "é"]) + rng.choice(gaps)
        rows.append((i, text if i % 2 else text.rstrip()))
    rows += [(100, ""), (101, " \n"), (102, None)]
    texts = spark.createDataFrame(rows, "id bigint, text string")
    rows = dict(rows)
    tokens = D.labeled_tokens(texts, gaps=True)
    plain = D.labeled_tokens(texts).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, tokens.drop("gap", "tail").collect()))
    tagged = tokens.withColumn("prediction", F.col("label")).withColumn("score", F.lit(0.5))
    found = E.group_entities(tagged).collect()
    assert len(found) > 100
    for e in found:
        assert rows[e["sid"]][e["start"]:e["end"]] == e["word"] != ""
    whole = E.texts_with_entities(tagged).collect()
    assert len(whole) == 60
    for r in whole:
        assert r["text"] == rows[r["sid"]]
        assert all(r["text"][e["start"]:e["end"]] == e["word"] for e in r["entities"])


def test_report_from_texts_to_a_file(spark, tokens, tmp_path):
    features = G.VARIANTS["token+suffix"]
    model = T.train_model(tokens, ["token+suffix"])
    texts = spark.createDataFrame([(1, "coffee  500\nbirr ቦሌ"), (2, " ")], "id bigint, text string")
    T.run_report(texts, model, features, str(tmp_path / "report"))
    back = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "report"))
    assert back.columns == ["text", "word", "label", "score"] and back.count() > 0
    assert {r["text"] for r in back.collect()} == {"coffee  500\nbirr ቦሌ"}
    assert all(r["word"] in r["text"] for r in back.collect())


@pytest.mark.parametrize("few", [10_000, 3, 1])
@pytest.mark.parametrize("share", [0.2, 0.333, 0.0, 1.0])
def test_exact_split_by_rounds(spark, monkeypatch, few, share):
    monkeypatch.setattr(D, "FEW_ROWS", few)
    monkeypatch.setattr(D, "_ROUND_DIGITS", 1)
    df = spark.range(301).withColumn("test_", F.lit(1))
    got = D.exact_split(df, "id", share)
    digests = {r["id"]: r["d"] for r in df.select("id", F.md5(F.col("id").cast("string")).alias("d")).collect()}
    want = set(sorted(digests, key=digests.get)[:math.ceil(301 * share)])
    assert {r["id"] for r in got.where("test").collect()} == want and got.count() == 301
    assert D.exact_split(df.where("false"), "id", share).collect() == []


def test_gazetteer_equals_the_list(spark):
    from feedlens.operators.gazetteer import mark_places

    rng = random.Random(12)
    letters = "abcቦሌ😀"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(300)] + [None, ""]
    places = ["".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(40)]
    rows = spark.createDataFrame([(i, rng.choice(words)) for i in range(2000)], "n int, token string")
    for listed in (places, ["ቦ"], ["abca", None, "x"], [], ["", "a"]):
        table = spark.createDataFrame([(p,) for p in listed], "place string")
        got = sorted(((r["n"], r["is_place"]) for r in mark_places(rows, table).collect()))
        want = sorted((r["n"], r["token"] is not None and any(p in r["token"] for p in listed if p is not None)) for r in rows.collect())
        assert got == want
    # As labels, by list and by table.
    texts = spark.createDataFrame([(1, "a b\nቦሌ 500 xቦሌy birr\n0911223344"), (2, "ቦሌ")], "id bigint, text string")
    table = spark.createDataFrame([(p,) for p in rules.LOCATIONS], "place string")
    by_table = D.labeled_tokens(texts, places=table).collect()
    assert sorted(map(tuple, by_table)) == sorted(map(tuple, D.labeled_tokens(texts).collect()))


def test_a_long_gazetteer(spark):
    from feedlens.operators.gazetteer import mark_places

    places = spark.range(100_000).select(F.concat(F.lit("place"), F.col("id").cast("string"), F.lit("x")).alias("place"))
    rows = spark.range(5000).select(F.concat(F.lit("in-place"), (F.col("id") * 40).cast("string"), F.lit("xy")).alias("token"))
    assert mark_places(rows, places).where("is_place").count() == 2500
