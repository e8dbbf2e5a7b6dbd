import pytest
from pyspark.sql import functions as F

from feedlens.functions import labels as L
from feedlens.operators import dataset as D

PLACES = ["ቦሌ", "መገናኛ", "ሞል", "Addis Ababa"]
MESSAGE = "  ቡና   ማሽን \n 500 ብር\n0911223344 ቦሌ  "


def labels_of(value, text, **kw):
    out = value(text, lambda c: L.label_message(c, places=PLACES, **kw))
    return [(t["token"], t["label"]) for t in out]


def test_whole_message(value):
    assert [t[1] for t in labels_of(value, MESSAGE)] == [
        "B-PRODUCT", "I-PRODUCT", "I-PRICE", "I-PRICE", "I-PHONE", "I-LOC"]
    assert [t[1] for t in labels_of(value, MESSAGE, collapse_first=True)] == ["B-PRODUCT"] + ["I-PRODUCT"] * 5


def test_edge_messages(value):
    assert labels_of(value, "\n500 ብር") == [("500", "I-PRICE"), ("ብር", "I-PRICE")]
    assert labels_of(value, "one") == [("one", "B-PRODUCT")]
    for blank in ("", "   ", "\n \n", None):
        assert labels_of(value, blank) == []


@pytest.mark.parametrize("token, label", [
    ("0911223344", "I-PHONE"), ("09112233445", "I-PRICE"), ("1200.50", "I-PRICE"), ("1200.505", "O"),
    ("1,200", "O"), ("500ብር", "I-PRICE"), ("$5", "I-PRICE"), ("Birr", "O"), ("በቦሌ", "I-LOC"),
    ("ETBቦሌ", "I-PRICE"), ("Addis", "O"),
])
def test_single_tokens(value, token, label):
    assert value(token, lambda c: L.rest_label(c, places=PLACES)) == label


def test_counts_agree_with_labelled_arrays(spark):
    texts = [MESSAGE, "\n99 birr only", "", None, "a\n\n  b 0911223344\n$5", "one line only"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    sentences = D.label_sentences(df)
    counts = {r["label"]: r["tokens"] for r in D.label_counts(df).collect()}
    exploded = D.token_rows(sentences).groupBy("label").count().collect()
    assert counts == {r["label"]: r["count"] for r in exploded}
    assert D.labeled_message_count(sentences).first()["messages"] == 6
    columns = ["sid", "pos", "token", "previous", "label"]
    direct = D.labeled_tokens(df).select(columns).collect()
    assert sorted(direct) == sorted(D.token_rows(sentences).select(columns).collect())


def test_labelling_needs_no_exchange(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, text string")
    plan = D.label_sentences(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_previous_token(spark):
    df = spark.createDataFrame([(1, "a b\nc"), (2, "x")], "id bigint, text string")
    rows = D.token_rows(D.label_sentences(df)).orderBy("sid", "pos").collect()
    assert [(r["token"], r["previous"]) for r in rows] == [("a", ""), ("b", "a"), ("c", "b"), ("x", "")]


def test_label_names(value):
    assert value("LABEL_2", L.label_name) == "I-PRODUCT"
    assert value("LABEL_9", L.label_name) is None


def test_label_index_and_codes(spark):
    df = spark.createDataFrame([(1, "a b\n5 x"), (2, "c\n0911223344")], "id bigint, text string")
    sentences = D.label_sentences(df)
    names = [r["label"] for r in D.label_list(sentences).collect()]
    assert names == ["B-PRODUCT", "I-PHONE", "I-PRICE", "I-PRODUCT", "O"]
    index = {r["label"]: r["label_id"] for r in D.label_index(sentences).collect()}
    assert index == {n: i for i, n in enumerate(names)}
    ids = sentences.select(D.encode_tags(D.tag_array(), names).alias("ids"), D.tag_array().alias("tags"))
    for r in ids.select("ids", "tags", D.decode_tags("ids", names).alias("back")).collect():
        assert r["back"] == r["tags"]
        assert r["ids"] == [names.index(t) for t in r["tags"]]


@pytest.mark.parametrize("n", [1, 5, 7, 100, 1003])
def test_exact_split(spark, n):
    df = spark.range(n).withColumnRenamed("id", "sid")
    split = D.exact_split(df, "sid", 0.2, seed=3)
    rows = split.collect()
    assert len(rows) == n
    assert sum(r["test"] for r in rows) == -(-n // 5)
    train, test = D.train_test_split(df, exact=True, seed=3)
    assert train.count() + test.count() == n


def test_hash_split_is_a_partition(spark):
    df = spark.range(1000).withColumnRenamed("id", "sid")
    for share in (0.2, 0.3):
        train, test = D.train_test_split(df, test_share=share, seed=1)
        assert train.union(test).distinct().count() == 1000
        assert abs(test.count() / 1000 - share) < 0.06


def test_labelling_plan(spark, tmp_path):
    from feedlens.plans.labelling import run_labelling
    from feedlens.sources.conll import read_conll

    rows = [(1, "ቡና ማሽን\n500 ብር"), (2, None), (3, "ጫማ")]
    messages = spark.createDataFrame(rows, "id bigint, message string")
    counts = run_labelling(messages, str(tmp_path / "conll"))
    written = read_conll(spark, str(tmp_path / "conll"))
    tokens = written.selectExpr("explode(tokens) as t").select("t.label").collect()
    assert written.count() == 2
    assert {r["label"]: r["tokens"] for r in counts.collect()} == {
        label: sum(t["label"] == label for t in tokens) for label in {t["label"] for t in tokens}}


def test_one_look_spares_no_label(spark):
    import random

    rng = random.Random(5)
    signs = ["ETB", "birr", "$", "ቦሌ", "4ኪሎ", "a", "b", "E", "1", "0911223344", "12.50", "\u0661", "\U0001d7d9", "\xe9", "ቡ", "x.", "-"]
    tokens = ["".join(rng.choices(signs, k=rng.randint(0, 4))) for _ in range(3000)] + [None, "1", "\u0661" * 10]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    for marks, places in ((None, None), ([], []), ([""], []), (["x"], ["\xe9", "b"])):
        plain = (F.when(L.is_phone("t"), "I-PHONE").when(L.is_price("t", marks), "I-PRICE")
                 .when(L.is_location("t", places), "I-LOC").otherwise("O"))
        assert df.where(plain != L.rest_label("t", marks, places)).count() == 0
        look = F.col("t").rlike(L._any_of([*(marks or []), *(places or [])]))
        assert df.where(~look & (L.is_phone("t") | L.is_price("t", marks or []) | L.is_location("t", places or []))).count() == 0
