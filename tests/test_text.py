import pytest
from hypothesis import given, settings, strategies as st

from feedlens import rules
from feedlens.functions import text as X
from feedlens.functions.numbers import clean_price, round_to

PY_SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0      　"


@pytest.mark.parametrize("text, expected", [
    (" a   b　c\n\nd\x1c", "a b c d"),
    ("a​b", "a​b"),
    ("a፡b", "a፡b"),
    ("", ""),
    (None, None),
])
def test_normalize_ws(value, text, expected):
    assert value(text, X.normalize_ws) == expected


def test_whitespace_matches_python_split(spark):
    texts = [f"x{c}{d}y {c}" for c in PY_SPACES for d in PY_SPACES] + ["", " ", "a", "​ b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select("text", X.normalize_ws("text").alias("n"), X.ws_tokens("text").alias("w")).collect()
    for r in rows:
        assert r["w"] == r["text"].split()
        assert r["n"] == " ".join(r["text"].split())


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="abሀሐሠ \n\t \x1c", max_size=30), min_size=200, max_size=200))
def test_normalising_twice_changes_nothing(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for fn in (X.normalize_ws, X.norm_chars, X.remove_emoji):
        once = df.select(fn("text").alias("text"))
        assert once.collect() == once.select(fn("text").alias("text")).collect()


def test_remove_emoji_keeps_other_ranges(value):
    assert value("x😀y🚗z☎️w🤖v", X.remove_emoji) == "xyz️w🤖v"


@pytest.mark.parametrize("text, expected", [
    ("ሙዋል ሙአል", "ሟል ሟል"), ("ቡዋ ኩዋ", "ቧ ኳ"), ("ቊጥር", "ቁጥር"), ("ሰላም", "ሰላም"),
])
def test_labialized(value, text, expected):
    assert value(text, X.norm_labialized) == expected


def test_short_forms_only_as_whole_tokens(value):
    assert value("ዶ/ር  አበበ\nት/ቤት", X.norm_short_forms) == "ዶክተር  አበበ\nትምህርት ቤት"
    assert value("xዶ/ር", X.norm_short_forms) == "xዶ/ር"
    assert value(None, X.norm_short_forms) is None


def test_punctuation(value):
    assert value("«ሰላም»፡፡ a::b", X.norm_punct) == '"ሰላም"። a።b'


def test_homophones(value):
    assert value("ሐመር ሠላም ዐይን ኀይል ጸሐይ ዓለም ሃገር", X.norm_chars) == "ሀመር ሰላም አይን ሀይል ፀሀይ አለም ሀገር"
    folded = rules.homophone_map()
    assert not set(folded) & set(folded.values())
    assert not set("ሐሠኀዐጸ") & set(folded.values())


def test_word_tokens(value):
    assert value("4ኪሎ ABC 100 ቡና፣ ማሽን።", X.word_tokenize) == ["ኪሎ", "ቡና", "ማሽን"]
    assert value("4ኪሎ ABC 100", lambda c: X.word_tokenize(c, "letters")) == ["ኪሎ", "ABC"]


def test_preprocess_message(value):
    assert value("😀 ሠላም ዶ/ር ቡዋ 500 ብር!", X.preprocess_message) == "ሰላም ዶክተር ቧ ብር"
    assert value(None, X.preprocess_message) == ""


def test_lines(value):
    text = "first\n\nsecond \nthird"
    assert value(text, X.first_line) == "first"
    assert value(text, X.rest_of_text) == "\nsecond \nthird"
    assert value("one", X.rest_of_text) == ""
    assert value("\nsecond \n", X.text_lines) == ["", "second ", ""]


@pytest.mark.parametrize("text, expected", [
    ("1,200 ETB", 1200.0), (" 300 ", 300.0), ("12d", None), ("nan", None), ("inf", None),
    ("1_000", None), ("abc", None), ("", None), (None, None), ("-1.5e2", -150.0), (".5", 0.5),
])
def test_clean_price(value, text, expected):
    assert value(text, clean_price) == expected


def test_rounding(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (1e300,), (None,)], "x double")
    assert [r[0] for r in df.select(round_to("x")).collect()] == [2.68, 0.13, 1e300, None]


def test_contains_any_long_list(value):
    words = [f"w{i}" for i in range(500)]
    assert value("a w499 b", lambda c: X.contains_any(c, words)) is True
    assert value("a b", lambda c: X.contains_any(c, words)) is False
    assert value("a b", lambda c: X.contains_any(c, [])) is False


def test_text_functions_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("a",)], "text string")
    plan = df.select(X.preprocess_message("text"), X.ws_tokens("text"))._jdf.queryExecution().toString()
    assert "Python" not in plan.replace("PythonRDD", "")
    assert "Exchange" not in plan


def test_one_pass_equals_the_replacements_one_by_one(spark):
    import random
    from functools import reduce

    from pyspark.sql import functions as F

    from feedlens import rules
    from feedlens.functions import text as X

    pairs = rules.labialized_pairs()
    rng = random.Random(2)
    letters = sorted({c for k, v in pairs for c in k + v} | set(rules.LABIAL_U_LETTERS) | set("ቡና ዋአ/ab\n"))
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(100_000)] + [k for k, _ in pairs]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = str.maketrans(rules.LABIAL_U_LETTERS)
    got = [r[0] for r in df.select(X.norm_labialized("t")).collect()]
    assert got == [reduce(lambda t, p: t.replace(*p), pairs, t).translate(plain) for t in texts]


def test_longest_key_first(value):
    from feedlens.functions import text as X

    table = {"ab": "1", "abc": "2", "b": "3", "(": "4", "a\n": "5"}
    assert value("abcab bca(\na\nb", lambda c: X.replace_longest(c, table)) == "21 3ca4\n53"
    assert value("xyz", lambda c: X.replace_longest(c, table)) == "xyz"
    assert value("xyz", lambda c: X.replace_longest(c, {})) == "xyz"
    assert value(None, lambda c: X.replace_longest(c, table)) is None


def test_preprocessing_without_its_shortcut(spark):
    import random

    from pyspark.sql import functions as F

    from feedlens import rules
    from feedlens.functions import text as X

    rng = random.Random(4)
    parts = [*rules.SHORT_FORMS, "abc", "x9", "ቡና", "ሐመር", "ቡዋ", "😀", "...", "::", "፡፡", "`a", " ", " ", "  ", "\n", "/", "."]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(5000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.col("t")
    for step in (X.remove_emoji, X.norm_labialized, X.norm_short_forms, X.norm_punct, X.norm_chars):
        whole = step(whole)
    whole = F.array_join(X.word_tokenize(whole, "ethiopic"), " ")
    assert df.select(whole.alias("a"), X.preprocess_message("t").alias("b")).where("a <> b").count() == 0


def test_preprocessing_a_long_run_of_plain_words(spark):
    from pyspark.sql import functions as F

    run = F.repeat(F.concat(F.lit("word"), F.col("id"), F.lit(" ")), 50_000)
    df = spark.range(1).select(F.concat(F.lit("ቡና "), run, F.lit("ዶ/ር ማሽን")).alias("t"))
    assert df.select(X.preprocess_message("t")).first()[0] == "ቡና ዶክተር ማሽን"


def test_gaps_and_tokens_are_the_text(spark):
    from pyspark.sql import functions as F

    from feedlens.functions import text as X

    texts = ["", " ", "a", " a", "a ", "\u00a0a\n\nb\u2003", "x  y\tz", "xx"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", X.ws_tokens("t").alias("w"), X.ws_gaps("t").alias("g")).collect():
        assert len(r["g"]) == len(r["w"]) + 1
        assert "".join(g + w for g, w in zip(r["g"], [*r["w"], ""])) == r["t"]
