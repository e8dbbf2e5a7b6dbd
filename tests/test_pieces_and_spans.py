import random

import pytest
from pyspark.sql import functions as F

from feedlens.functions import pieces as P
from feedlens.functions import spans as N
from feedlens.operators import metrics as M


def spans_by_hand(tags):
    """Lenient rule, one token at a time."""
    out, current = [], None
    for i, tag in enumerate(tags):
        kind = None if tag == "O" else tag[2:]
        if kind and (tag[0] == "B" or current is None or current[0] != kind):
            if current:
                out.append(tuple(current))
            current = [kind, i, i]
        elif kind:
            current[2] = i
        else:
            if current:
                out.append(tuple(current))
            current = None
    return out + ([tuple(current)] if current else [])


CASE = "I-LOC I-LOC O B-PRODUCT I-PRODUCT B-PRODUCT I-LOC I-PRICE O".split()
TAGS = ["O", "B-PRODUCT", "I-PRODUCT", "I-LOC", "I-PRICE", "B-LOC"]


@pytest.fixture(scope="module")
def sequences():
    rng = random.Random(5)
    made = [[rng.choice(TAGS) for _ in range(rng.randint(0, 25))] for _ in range(300)]
    return [CASE, [], ["O"], ["I-LOC"], ["O", "O"], *made]


def test_array_spans(spark, sequences):
    df = spark.createDataFrame(list(enumerate(sequences)), "sid bigint, tags array<string>")
    for r in df.select("tags", N.tag_spans("tags").alias("s")).collect():
        assert [(s["type"], s["start"], s["end"]) for s in r["s"]] == spans_by_hand(r["tags"])
    assert spans_by_hand(CASE) == [
        ("LOC", 0, 1), ("PRODUCT", 3, 4), ("PRODUCT", 5, 5), ("LOC", 6, 6), ("PRICE", 7, 7)]


def test_window_spans_match_array_spans(spark, sequences):
    df = spark.createDataFrame(list(enumerate(sequences)), "sid bigint, tags array<string>")
    rows = df.select("sid", F.posexplode("tags").alias("pos", "tag"))
    got = {(r["sid"], r["type"], r["start"], r["end"]) for r in M.entity_spans(rows).collect()}
    assert got == {(i, *s) for i, tags in enumerate(sequences) for s in spans_by_hand(tags)}


def test_spans_need_one_exchange(spark):
    rows = spark.createDataFrame([(1, 0, "O")], "sid bigint, pos int, tag string")
    plan = M.entity_spans(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_scores_against_brute_force(spark, sequences):
    rng = random.Random(9)
    pairs = []
    for i, tags in enumerate(sequences):
        guess = [t if rng.random() < 0.7 else rng.choice(TAGS) for t in tags]
        pairs.append((i, tags, guess))
    df = spark.createDataFrame(pairs, "sid bigint, labels array<string>, predictions array<string>")
    truth = {(i, *s) for i, t, _ in pairs for s in spans_by_hand(t)}
    guess = {(i, *s) for i, _, g in pairs for s in spans_by_hand(g)}
    hits = truth & guess
    row = M.entity_f1(df).first()
    assert (row["found"], row["predicted"], row["actual"]) == (len(hits), len(guess), len(truth))
    assert row["f1"] == pytest.approx(2 * len(hits) / (len(truth) + len(guess)))

    def table(spans):
        return spark.createDataFrame(sorted(spans), "sid bigint, type string, start int, end int")

    assert M.entity_f1_from_spans(table(truth), table(guess)).first() == row

    report = {r["name"]: r for r in M.classification_report(df).collect()}
    kinds = sorted({s[1] for s in truth | guess})
    assert list(report) == [*kinds, "micro avg", "macro avg", "weighted avg"]
    parts = []
    for kind in kinds:
        t, g, h = (len([s for s in x if s[1] == kind]) for x in (truth, guess, hits))
        p, r = h / g if g else 0, h / t if t else 0
        parts.append((p, r, 2 * h / (t + g) if t + g else 0, t))
        assert tuple(report[kind])[1:] == pytest.approx(parts[-1])
    assert tuple(report["micro avg"])[1:] == pytest.approx(
        (len(hits) / len(guess), len(hits) / len(truth), row["f1"], len(truth)))
    for k in range(3):
        assert report["macro avg"][k + 1] == pytest.approx(sum(x[k] for x in parts) / len(parts))
        assert report["weighted avg"][k + 1] == pytest.approx(
            sum(x[k] * x[3] for x in parts) / sum(x[3] for x in parts))


def test_small_scores(spark):
    schema = "labels array<string>, predictions array<string>"
    truth = "B-PRODUCT I-PRODUCT O I-LOC".split()
    guess = "B-PRODUCT O O I-LOC".split()
    row = M.entity_f1(spark.createDataFrame([(truth, guess)], schema)).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.5, 0.5, 0.5)
    none = spark.createDataFrame([(["O"], ["O"])], schema)
    assert M.entity_f1(none).first()["f1"] == 0.0
    assert M.entity_f1(none.where("false")).first()["f1"] == 0.0
    assert M.classification_report(none).count() == 0


def pieces_of(spark, words, labels):
    data = [([(None if w is None else f"p{w}", w) for w in words], labels)]
    return spark.createDataFrame(data, "pieces array<struct<piece:string,word:int>>, labels array<int>")


def test_alignment(spark):
    df = pieces_of(spark, [None, 0, 0, 1, None], [2, 5])
    assert df.select(P.align_labels("pieces", "labels")).first()[0] == [-100, 2, -100, 5, -100]
    assert pieces_of(spark, [], [1]).select(P.align_labels("pieces", "labels")).first()[0] == []


def test_word_pieces(spark):
    df = spark.createDataFrame([(["coffee", "ab", "abcd", "ቡናማሽን"],)], "w array<string>")
    got = df.select(P.word_pieces("w", special=True)).first()[0]
    assert [(p["piece"], p["word"]) for p in got] == [
        ("<s>", None), ("coff", 0), ("ee", 0), ("ab", 1), ("abcd", 2), ("ቡናማሽ", 3), ("ን", 3), ("</s>", None)]
    assert "".join(p["piece"] for p in got if p["word"] is not None) == "coffeeababcdቡናማሽን"


def test_every_whole_word_gets_one_label(spark):
    df = spark.createDataFrame([(["a" * n for n in range(1, 30)], list(range(1, 30)))], "w array<string>, l array<int>")
    aligned = df.select(P.word_pieces("w", special=True).alias("p"), "l").select(P.align_labels("p", "l")).first()[0]
    assert [x for x in aligned if x != -100] == list(range(1, 30))


def test_truncate_and_pad(spark):
    df = spark.createDataFrame([(["abcdefgh"] * 100,), (["ab"],)], "w array<string>")
    cut = df.select(P.truncate_pieces(P.word_pieces("w", special=True), 128).alias("p")).collect()
    assert [len(r["p"]) for r in cut] == [128, 3]
    assert cut[0]["p"][-1]["piece"] == "</s>" and cut[0]["p"][-2]["word"] == 62
    bare = df.select(P.truncate_pieces(P.word_pieces("w"), 128).alias("p")).collect()
    assert [len(r["p"]) for r in bare] == [128, 1]
    ids = spark.createDataFrame([([1, 2],), (list(range(200)),)], "x array<int>")
    padded = ids.select(P.pad_labels(P.truncate_labels("x", 128), 128).alias("x")).collect()
    assert padded[0]["x"] == [1, 2] + [-100] * 126 and padded[1]["x"] == list(range(128))


def test_mask_and_argmax(spark):
    df = spark.createDataFrame([([1, 2, 3], [-100, 2, 0], [0.4, 0.4, 0.2])], "p array<int>, t array<int>, s array<double>")
    pairs = df.select(P.mask_pairs("p", "t")).first()[0]
    assert [(x["predicted"], x["label"]) for x in pairs] == [(2, 2), (3, 0)]
    assert df.select(P.argmax_label("s", ["a", "b", "c"])).first()[0] == "a"
