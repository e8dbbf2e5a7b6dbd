from pyspark.sql import functions as F

from feedlens.functions import media
from feedlens.functions.text import canonical_username
from feedlens.operators import cleaning as C
from feedlens.operators import dataset as D
from feedlens.schemas import MESSAGES
from feedlens.session import new_path, shared_dir, stored
from feedlens.sources import conll, images, tables

RAW = (
    "Channel Title,Channel Username,ID,Message,Date,Media Path\r\n"
    'Shop A,@a,1,"say ""hi"", x",2024-01-01 10:00:00+00:00,\r\n'
    'Shop A,@a,2,"two\nlines \\ here",2024-01-02 10:00:00+00:00,p/a_2.jpg\r\n'
    "Shop B,b,3,,bad,\r\n"
    'Shop B,b,4,NA,2024-01-03 10:00:00+00:00,""\r\n'
    "Shop B,b,5,  spaced  ,2024-01-03 10:00:00+00:00,\r\n"
)


def test_read_messages(spark, tmp_path):
    (tmp_path / "raw.csv").write_bytes(RAW.encode())
    df = tables.read_messages(spark, str(tmp_path))
    assert df.schema.simpleString() == MESSAGES.simpleString()
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["message"] == 'say "hi", x' and rows[1]["media_path"] is None
    assert rows[2]["message"] == "two\nlines \\ here"
    assert rows[3]["message"] is None and rows[4]["media_path"] is None
    assert rows[4]["message"] == "NA" and rows[5]["message"] == "  spaced  "
    with_na = tables.read_messages(spark, str(tmp_path), na_words=True)
    assert with_na.where("id = 4").first()["message"] is None
    assert sorted(r["id"] for r in C.clean_messages(with_na).collect()) == [1, 2, 5]
    parsed = C.parse_timestamp(df)
    assert sorted(r["id"] for r in parsed.collect()) == [1, 2, 4, 5]
    assert parsed.where("id = 1").select(F.unix_seconds("timestamp")).first()[0] == 1704103200


def test_optional_columns(spark, tmp_path):
    head, *lines = RAW.replace("\r\n", "\x00").split("\x00")[:2]
    text = head + ",views,entities\n" + lines[0] + ",7,\"[{'label': 'B-PRODUCT'}]\"\n"
    (tmp_path / "raw.csv").write_text(text)
    row = tables.read_messages(spark, str(tmp_path), views=True, entities=True).first()
    assert row["views"] == 7 and row["entities"] == "[{'label': 'B-PRODUCT'}]"


def test_written_messages_come_back(spark, tmp_path):
    data = [("S", "@s", i, m, "d", None) for i, m in enumerate(
        ['q"uote', "a\nb", " lead", "trail ", "back\\slash", "comma,", '"', 'x\r\ny', "ቡና 😀", None, "\\\""])]
    df = spark.createDataFrame(data, MESSAGES)
    path = str(tmp_path / "out")
    tables.write_messages(df.repartition(3), path)
    back = tables.read_messages(spark, path)
    assert sorted(back.collect(), key=lambda r: r["id"]) == df.collect()


def test_media(spark):
    df = spark.createDataFrame(
        [("@@a@", 1, True), ("shop_b", 2, True), ("c", 3, False)], "u string, id bigint, p boolean")
    rows = [r[0] for r in df.select(media.media_path(F.col("p"), "u", "id", "m/")).collect()]
    assert rows == ["m/a_1.jpg", "m/shop_b_2.jpg", None]
    assert [r[0] for r in df.select(canonical_username("u")).collect()] == ["a", "shop_b", "c"]


def test_list_images(spark, tmp_path):
    for name in ("shop_a_1.jpg", "solo_4.png", "solo_3.jpg"):
        (tmp_path / name).write_bytes(b"x")
    listed = images.list_images(spark, str(tmp_path))
    assert sorted(r["image"] for r in listed.collect()) == ["shop_a_1.jpg", "solo_3.jpg"]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def read(spark, tmp_path, text, **kw):
    (tmp_path / "x.conll").write_bytes(text.encode())
    rows = conll.read_conll(spark, str(tmp_path), **kw).orderBy("sid").collect()
    assert len({r["sid"] for r in rows}) == len(rows)
    return [[(t["token"], t["label"]) for t in r["tokens"]] for r in rows]


A, B = [("a", "O"), ("b", "I-LOC")], [("c", "B-PRODUCT")]


def test_read_conll(spark, tmp_path):
    assert read(spark, tmp_path, "a\tO\nb\tI-LOC\n\n\n\nc\tB-PRODUCT\n\n") == [A, B]
    assert read(spark, tmp_path, "a\tO\nb\tI-LOC\n \nc\tB-PRODUCT\n") == [A, B]
    assert read(spark, tmp_path, "a O\nx y z\nb\tI-LOC\nalone\n\nc  B-PRODUCT") == [A, B]
    assert read(spark, tmp_path, "\n\n \n\na\tO\nb\tI-LOC\n\n\n") == [A]
    windows = "a\tO\r\nb\tI-LOC\r\n\r\nc\tB-PRODUCT\r\n"
    assert read(spark, tmp_path, windows) == [A, B]
    assert read(spark, tmp_path, windows.replace("\n", "")) == [A, B]
    assert read(spark, tmp_path, "") == []


def test_conll_round_trip(spark, tmp_path):
    texts = ["a b\n5 x", "", "  ", "one", "one", "c\n0911223344 ቦሌ\n\nz"]
    sentences = D.label_sentences(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string"))
    path = str(tmp_path / "out")
    conll.write_conll(sentences.repartition(2), path)
    back = conll.read_conll(spark, path)

    def bag(df):
        return sorted(tuple(map(tuple, r["tokens"])) for r in df.collect() if r["tokens"])

    assert bag(back) == bag(sentences)


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured
    assert new_path(spark, "x").startswith(configured) and new_path(spark, "x") != new_path(spark, "x")
    df = stored(spark.range(10).withColumn("p", F.col("id") % 2), "t", partition_by=["p"])
    assert df.columns == ["id", "p"] and df.where("p = 1").count() == 5


def test_sentence_numbers_follow_the_file_whatever_the_split(spark, tmp_path):
    for name in ("b", "a"):
        blocks = [f"{name}{i}\tO\n" * (1 + i % 3) + ("\n" * (1 + i % 2)) for i in range(200)]
        (tmp_path / f"{name}.conll").write_text("".join(blocks))
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = []
    try:
        for size in ("100b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            rows = conll.read_conll(spark, str(tmp_path)).orderBy("sid").collect()
            got.append([(r["sid"], r["tokens"][0]["token"], len(r["tokens"])) for r in rows])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", whole)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [(k, f"{name}{i}", 1 + i % 3) for k, (name, i) in enumerate((n, i) for n in "ab" for i in range(200))]
    assert got == [want] * 2


def odd_messages(n):
    import random

    rng = random.Random(6)
    parts = ['"', ",", "\n", "\r\n", "a", "ቡና😀", " ", "'", '""', "x,y"]
    return [("S", f"@s{i % 3}", i, "".join(rng.choices(parts, k=rng.randint(0, 40))) or None, "d", rng.choice([None, "p/a.jpg"]))
            for i in range(n)]


def test_quoted_newlines_are_read_by_many_tasks(spark, tmp_path):
    import csv

    rows = odd_messages(400)
    for part in range(2):
        with open(tmp_path / f"{part}.csv", "w", newline="", encoding="utf-8") as file:
            out = csv.writer(file, lineterminator="\r\n" if part else "\n")
            out.writerow(list(tables.MESSAGE_HEADER))
            out.writerows(rows[part::2])
    # One field over many ranges.
    long = ("S", "@s", 1000, 'begin\n"' * 300 + ",\n" * 200, "d", None)
    with open(tmp_path / "2.csv", "w", newline="", encoding="utf-8") as file:
        out = csv.writer(file)
        out.writerow(list(tables.MESSAGE_HEADER))
        out.writerows([long, ("S", "@s", 1001, "after", "d", None)])
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = [(*r[:3], r[3] or None, *r[4:]) for r in [*rows, long, ("S", "@s", 1001, "after", "d", None)]]
    # One task per file gives the same, but for line ends inside the fields of a "\r\n" file.
    single = tables.read_messages(spark, str(tmp_path), split=False).where("id % 2 = 0 and id < 1000")
    assert sorted(map(tuple, single.collect()), key=lambda r: r[2]) == [r for r in want if r[2] % 2 == 0 and r[2] < 1000]
    try:
        for size in ("700b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            got = tables.read_messages(spark, str(tmp_path))
            assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", whole)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_that_break_the_rules_are_refused(spark, tmp_path):
    import pytest

    head = ",".join(tables.MESSAGE_HEADER) + "\n"
    for i, (text, error) in enumerate([
        (head + 'S,@s,1,"open,d,\n', "do not pair up"),
        (head + 'S,@s,1,5" and 6" wide,d,\n', "stray quote"),
        (head.replace("ID", "Id") + "S,@s,1,m,d,\n", "header"),
    ]):
        path = tmp_path / str(i)
        path.mkdir()
        (path / "x.csv").write_text(text)
        with pytest.raises(Exception, match=error):
            tables.read_messages(spark, str(path)).collect()
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.csv").write_text("\ufeff" + head + "\n\n")
    assert tables.read_messages(spark, str(tmp_path / "empty")).collect() == []


def test_lines_of_two_fields_by_range():
    import pyarrow as pa

    from feedlens.sources import conll

    lines = [("a", 0, "x\tO"), ("a", 0, " y  B \r"), ("a", 0, "\u3000"), ("a", 0, "one"), ("a", 0, ""), ("a", 0, "z\tO\r\rw O"),
             ("a", 9, "v\tO"), ("a", 9, ""), ("b", 0, "u\tO"), ("b", 0, "")]
    batches = [pa.RecordBatch.from_pylist([dict(zip(["file", "start", "value"], r)) for r in lines[i:i + 3]])
               for i in range(0, len(lines), 3)]
    found = [tuple(r.values()) for b in conll._blocks(iter(batches)) for r in b.to_pylist()]
    assert found == [
        ("a", 0, 0, "whole", "x\tO\ny\tB"), ("a", 0, 1, "whole", "z\tO"), ("a", 0, 2, "open", "w\tO"),
        ("a", 9, 0, "more", "v\tO"), ("a", 9, 0, "closed", ""),
        ("b", 0, 0, "whole", "u\tO"), ("b", 0, 1, "closed", ""),
    ]
