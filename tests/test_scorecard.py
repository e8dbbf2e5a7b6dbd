import pytest

from feedlens.functions import entities as E
from feedlens.operators import scorecard as S
from feedlens.plans.scorecard import run_scorecard, scorecard_of
from feedlens.schemas import SCORECARD_HEADER
from feedlens.session import stored

P = "'label': 'B-PRODUCT'"


@pytest.mark.parametrize("text, expected", [
    ("[]", []), ("not a list", []), (None, []), ("{" + P + ", 'word': 'x'}", []),
    ("[{" + P + ", 'word': 'x', 'price': 10}, 3]", [("B-PRODUCT", "x", "10")]),
    ("""[{'label': 'B-PRODUCT', 'word': "O'Neil", 'price': '5'}]""", [("B-PRODUCT", "O'Neil", "5")]),
    ('[{"label": "I-PRICE", "word": "9"}]', [("I-PRICE", "9", None)]),
    ("[{'word': 'a'}] trailing", []),
    ("[{" + P + ", 'word': None}]", [("B-PRODUCT", None, None)]),
])
def test_parse_entities(value, text, expected):
    assert [tuple(e) for e in value(text, E.parse_entities)] == expected


def test_python_literals(value):
    text = "[{" + P + ", 'word': None, 'price': '7'}, (1, 2)]"
    parsed = value(text, lambda c: E.parse_entities(c, python_literals=True))
    assert [tuple(e) for e in parsed] == [("B-PRODUCT", None, "7")]
    assert value("[__import__('os')]", lambda c: E.parse_entities(c, python_literals=True)) == []


ENTITIES = ("[{" + P + ", 'price': '1,200 ETB'}, {" + P + ", 'word': '300'}, "
            "{'label': 'I-PRODUCT', 'price': 5}, {" + P + ", 'price': 0, 'word': 'abc'}]")


def test_prices(value):
    parsed = value(ENTITIES, lambda c: E.product_prices(E.parse_entities(c)))
    assert parsed == [1200.0, 300.0]
    assert value("[]", lambda c: E.product_prices(E.parse_entities(c))) == []


def test_top_product_and_price(value):
    text = "[{" + P + ", 'word': '', 'price': 10}, {" + P + ", 'word': 'x', 'price': 20}, {" + P + ", 'price': 'n/a'}]"
    assert value(text, lambda c: E.top_product(E.parse_entities(c))) == "x"
    assert value(text, lambda c: E.top_price(E.parse_entities(c))) == 20.0
    assert value("[]", lambda c: E.top_product(E.parse_entities(c))) == ""
    assert value("[]", lambda c: E.top_price(E.parse_entities(c))) == 0.0


SCHEMA = "id bigint, channel_title string, message string, date string, views bigint, entities string"


def feed(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [
    (1, "A", "first", "2024-01-01 00:00:00", 100, ENTITIES),
    (2, "A", "second", "2024-01-21 23:00:00", 100, "[]"),
    (3, "A", "third", "2024-01-10 00:00:00", 40, None),
    (4, "A", "dropped", "bad", 9999, "[]"),
    (5, "B", None, "2024-03-01 12:00:00", 7, "[{" + P + ", 'word': 'tea', 'price': '9'}]"),
    (6, None, "no vendor", "2024-03-01 12:00:00", 7, "[]"),
]


def test_scorecard(spark):
    rows = [tuple(r) for r in scorecard_of(feed(spark, ROWS)).collect()]
    # 20 whole days: 3 / (20 / 7) = 1.05; the first of the two posts with 100 views wins.
    assert rows == [("A", 80.0, 1.05, 750.0, "300", 0.0, 40.53), ("B", 7.0, 1.0, 9.0, "tea", 9.0, 4.0)]


def test_single_metrics_agree_with_the_scorecard(spark):
    posts = S.scorecard_input(feed(spark, ROWS))
    card = {r["vendor"]: r for r in S.vendor_scorecard(posts).collect()}
    for df, column in ((S.avg_views(posts), "avg_views"), (S.posts_per_week(posts), "posts_per_week"),
                       (S.avg_price(posts), "avg_price"), (S.top_products(posts), "top_product")):
        assert {r["vendor"]: r[column] for r in df.collect()} == {v: r[column] for v, r in card.items()}
    assert [tuple(r) for r in S.vendor_groups(posts).collect()] == [("A", 3), ("B", 1)]
    top = {r["vendor"]: (r["message"], r["views"]) for r in S.top_post(posts).collect()}
    assert top == {"A": ("first", 100), "B": (None, 7)}


def test_lending_score(spark):
    df = spark.createDataFrame([(100.0, 2.5)], "v double, p double")
    assert df.select(S.lending_score_of("v", "p")).first()[0] == 51.25


def test_empty_feed_and_missing_columns(spark, tmp_path):
    empty = scorecard_of(feed(spark, ROWS).where("false"))
    assert empty.count() == 0 and len(empty.columns) == 7
    bare = feed(spark, ROWS).drop("views", "entities")
    first, again = scorecard_of(bare).collect(), scorecard_of(bare.repartition(3)).collect()
    assert first == again and {r["vendor"] for r in first} == {"A", "B"}
    assert {r["vendor"]: r["top_product"] for r in first}["B"] == ""
    path = str(tmp_path / "card")
    run_scorecard(feed(spark, ROWS), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == list(SCORECARD_HEADER.values()) and back.count() == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_per_metric(spark, tmp_path):
    path = str(tmp_path / "posts")
    S.scorecard_input(feed(spark, ROWS)).write.parquet(path)
    posts = spark.read.parquet(path)
    for df in (S.posts_per_week(posts), S.avg_price(posts)):
        plan = plan_of(df)
        assert plan.count("Exchange") == 1 and "Python" not in plan
    # The winners come by broadcast, and meet in one shuffle.
    for df in (S.top_products(posts), S.top_post(posts), S.vendor_scorecard(posts)):
        plan = plan_of(df)
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastExchange") == 1
        assert "Python" not in plan


def test_tops_are_found_without_sorting(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "posts")
    S.scorecard_input(feed(spark, ROWS)).write.parquet(path)
    posts, plans = spark.read.parquet(path), []

    def noted(df, name, *rest):
        plans.append(plan_of(df))
        return stored(df, name, *rest)

    monkeypatch.setattr(S, "stored", noted)
    for df in (S.top_products(posts), S.top_post(posts), S.vendor_scorecard(posts)):
        plans.append(plan_of(df).split("Exchange rangepartitioning")[-1])  # below the order of the result
    assert len(plans) == 6
    assert not any(word in plan for plan in plans for word in ("SortAggregate", "Sort [", "SortMergeJoin"))
    assert all("HashAggregate" in plan for plan in plans)


@pytest.mark.parametrize("order", ["id", "name"])
def test_tops_with_missing_views_ties_and_text_orders(spark, order):
    views = [5, None, 7, 7, None, 7, -3, 2 ** 60]
    rows = [(i, "AB"[i % 2], f"m{i}", "2024-01-01", v, "[]", f"n{9 - i}") for i, v in enumerate(views)]
    rows += [(20, "C", "x", "2024-01-01", None, "[]", "b"), (21, "C", "y", "2024-01-01", None, "[]", "a"),
             (None, "D", "u", "2024-01-01", 4, "[]", None), (30, "D", "v", "2024-01-01", 4, "[]", "z")]
    posts = S.scorecard_input(spark.createDataFrame(rows, SCHEMA + ", name string"))
    got = {r["vendor"]: (r["message"], r["views"]) for r in S.top_post(posts, order=order).collect()}
    column = {"id": 0, "name": 6}[order]
    last = {"id": 2 ** 70, "name": "~"}[order]
    want = {}
    for vendor in "ABCD":
        best = min((r for r in rows if r[1] == vendor), key=lambda r: (
            -(r[4] if r[4] is not None else -2 ** 70), last if r[column] is None else r[column]))
        want[vendor] = best[2], best[4]
    assert got == want


def test_highlight(spark):
    schema = "text string, entities array<struct<start:int,end:int,entity:string,word:string,score:double>>"
    df = spark.createDataFrame([
        ("buy coffee in Bole now", [(14, 18, "LOC", "Bole", 0.9), (4, 10, "PRODUCT", "coffee", 0.8)]),
        ("nothing", []),
    ], schema)
    html = [r[0] for r in df.select(E.highlight_entities("text", "entities")).collect()]
    gold, blue = (f'<span style="background-color:{c};padding:2px;border-radius:4px;">' for c in ("#FFD700", "#87CEEB"))
    assert html == [f"buy {gold}coffee</span> in {blue}Bole</span> now", "nothing"]


def test_low_confidence_flag(spark):
    schema = "entities array<struct<score:double>>"
    df = spark.createDataFrame([(None,), ([],), ([(0.69,)],), ([(0.69,), (0.7,)],)], schema)
    assert [r[0] for r in df.select(E.is_low_confidence("entities")).collect()] == [True, True, True, False]


def test_literals_that_only_python_has_keep_their_list(value):
    text = "[{" + P + ", 'word': 'a\\xa0b', 'price': 7, 'new': True}, {" + P + ", 'word': 'c', 'price': None}]"
    assert [tuple(e) for e in value(text, E.parse_entities)] == [
        ("B-PRODUCT", "a\xa0b", "7"), ("B-PRODUCT", "c", None)]
    assert value(text, lambda c: E.product_prices(E.parse_entities(c))) == [7.0]


def test_top_post_is_one_row_per_vendor(spark):
    rows = [(1, "A", "x", "2024-01-01", 9, "[]"), (1, "A", "x", "2024-01-01", 9, "[]"),
            (1, "A", "w", "2024-01-01", 9, "[]"), (2, "A", "y", "2024-01-01", 3, "[]"),
            (7, "B", "z", "2024-01-01", None, "[]")]
    posts = S.scorecard_input(feed(spark, rows))
    got = sorted(map(tuple, S.top_post(posts).collect()))
    assert got == [("A", "w", 9), ("B", "z", None)]
