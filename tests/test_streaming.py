import pytest
from pyspark.sql import functions as F

from feedlens.operators.cleaning import clean_messages, message_record
from feedlens.plans.feed import run_feed
from feedlens.streaming import ingest as J

SCHEMA = ("channel_title string, channel_username string, id bigint, message string, date string, "
          "has_photo boolean, timestamp timestamp")


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")

    def land(rows):
        df = spark.createDataFrame(rows, SCHEMA.replace("timestamp timestamp", "timestamp string"))
        df.withColumn("timestamp", F.to_timestamp("timestamp")).coalesce(1).write.mode("append").parquet(path)

    land([("T", f"@c{i % 3}", i, f" m {i}\n", "d", i % 2 == 0, f"2024-01-01 00:{i % 60:02d}:00") for i in range(40)])
    land([("T", f"@c{i % 3}", i, "  ", "d", False, "2024-01-02 00:00:00") for i in range(40, 50)])
    return path, land


def read(spark, path, n=None):
    from pyspark.sql.types import _parse_datatype_string

    return J.read_landing(spark, path, _parse_datatype_string(SCHEMA), max_files_per_trigger=n)


def drain(stream, tmp_path, name):
    out = str(tmp_path / name)
    J.append_to(stream, out, out + "-state", once=True).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def test_ingest_equals_batch_and_resumes(spark, landing, tmp_path):
    path, land = landing
    stream = J.ingest(read(spark, path, 1), "m", ["@c0", "@c1"])
    got = drain(stream, tmp_path, "raw")
    batch = message_record(spark.read.parquet(path).where("channel_username <> '@c2'"), "m")
    assert sorted(got.collect()) == sorted(batch.collect(), key=lambda r: tuple(r))
    land([("T", "@c1", 99, "late", "d", False, "2023-01-01 00:00:00")])
    assert drain(stream, tmp_path, "raw").count() == batch.count() + 1


def test_stream_clean_equals_batch(spark, landing, tmp_path):
    path, _ = landing
    columns = ["id", "message"]
    got = drain(clean_messages(read(spark, path)).select(columns), tmp_path, "clean")
    assert sorted(got.collect()) == sorted(clean_messages(spark.read.parquet(path)).select(columns).collect())


def test_backfill_and_live_rows_land_once(spark, landing, tmp_path):
    path, _ = landing
    live = read(spark, path).withColumn("channel_username", F.ltrim(F.col("channel_username"), F.lit("@")))
    out = drain(J.backfill_then_follow(read(spark, path), live), tmp_path, "all")
    rows = out.collect()
    assert len(rows) == 50 and {r["channel_username"] for r in rows} == {"c0", "c1", "c2"}


def test_watermark_is_optional(spark, landing, tmp_path):
    path, _ = landing
    both = J.backfill_then_follow(read(spark, path), read(spark, path), delay="10 days")
    assert drain(both, tmp_path, "marked").count() == 50


def test_feed_run(spark, landing, tmp_path):
    path, _ = landing
    out = str(tmp_path / "feed")
    run_feed(spark.read.parquet(path), "m", out)
    assert spark.read.parquet(f"{out}/raw").count() == 50
    clean = spark.read.parquet(f"{out}/clean")
    assert clean.columns[:3] == ["Channel Title", "Channel Username", "ID"] and clean.count() == 40
    assert spark.read.parquet(f"{out}/preprocessed").where("Message <> ''").count() == 0


def test_allow_list_takes_names_in_either_spelling(spark, tmp_path):
    rows = [("T", "@shop", 1, "a", "d", False, "2023-01-01 00:00:00"),
            ("T", "shop", 2, "b", "d", False, "2023-01-01 00:00:00"),
            ("T", "other", 3, "c", "d", False, "2023-01-01 00:00:00")]
    names = "channel_title string, channel_username string, id bigint, message string, date string, has_photo boolean, timestamp string"
    landed = spark.createDataFrame(rows, names)
    for channels in (["@shop"], ["shop"], landed.where("id = 1")):
        assert {r["id"] for r in J.ingest(landed, "m", channels).collect()} == {1, 2}


def test_feed_keeps_all_messages(spark, tmp_path):
    rows = [("T", "@c", i, "text", "2024-01-01", False) for i in range(1500)]
    landed = spark.createDataFrame(
        rows, "channel_title string, channel_username string, id bigint, message string, date string, has_photo boolean")
    run_feed(landed, "m", str(tmp_path / "all"))
    assert spark.read.parquet(str(tmp_path / "all" / "raw")).count() == 1500
    run_feed(landed, "m", str(tmp_path / "some"), n=10)
    assert spark.read.parquet(str(tmp_path / "some" / "clean")).count() == 10


def test_live_plan_goes_on_after_a_restart(spark, landing, tmp_path):
    from feedlens.plans.live import run_live

    path, land = landing
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        for flow in run_live(read(spark, path, 1), "m", out, checkpoint, once=True):
            flow.awaitTermination()
        return spark.read.parquet(f"{out}/raw").count(), spark.read.parquet(f"{out}/clean").count()

    first = run()
    assert first[0] == spark.read.parquet(path).count() >= first[1]
    assert run() == first
    land([("T", "@c1", 99, "late", "d", False, "2023-01-01 00:00:00")])
    assert run() == (first[0] + 1, first[1] + 1)


def test_intervals_equal_a_set():
    import random

    from feedlens.streaming.seen import add

    rng = random.Random(1)
    starts, ends, seen = [], [], set()
    for _ in range(4000):
        n = rng.randint(-300, 300)
        assert add(starts, ends, n) == (n not in seen)
        seen.add(n)
        assert len(starts) == len(ends) == sum(x - 1 not in seen for x in seen)


def test_late_repeats_over_restarts(spark, landing, tmp_path):
    path, land = landing
    land([(None, None, None, "no id", "d", False, None), (None, "c0", None, "no id", "d", False, None)] * 2)

    def rows():
        live = read(spark, path, 1).withColumn("channel_username", F.ltrim(F.col("channel_username"), F.lit("@")))
        return [(r["channel_username"], r["id"]) for r in drain(J.backfill_then_follow(read(spark, path, 1), live), tmp_path, "all").collect()]

    assert len(rows()) == 52
    # Very late: the very first messages again, and new ones.
    land([("T", f"@c{i % 3}", i, "again", "d", False, "2020-01-01 00:00:00") for i in range(45, 60)])
    got = rows()
    assert len(got) == len(set(got)) == 62 and {i for _, i in got} == {None, *range(60)}
    land([("T", "@c0", 0, "again", "d", False, "2020-01-01 00:00:00")])
    assert sorted(rows(), key=str) == sorted(got, key=str)


def test_state_of_ids_without_gaps_stays_flat(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "channel_username string, id bigint"

    def run(first, last):
        spark.range(first, last).select(F.lit("c").alias("channel_username"), "id").coalesce(1).write.mode("append").parquet(path)
        from pyspark.sql.types import _parse_datatype_string

        stream = J.first_of_each(J.read_landing(spark, path, _parse_datatype_string(schema)))
        query = J.append_to(stream, out, out + "-state", once=True)
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert run(0, 1000) == run(1000, 40_000) == run(500, 60_000) == 1
    assert run(60_000, 70_000) == 2
    assert spark.read.parquet(out).count() == 70_000


def test_live_plan_lands_a_message_of_both_feeds_once(spark, landing, tmp_path):
    from feedlens.plans.live import run_live

    path, land = landing
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        for flow in run_live(read(spark, path), "m", out, checkpoint, ["c0", "@c1"], once=True, backfill=read(spark, path)):
            flow.awaitTermination()
        return [spark.read.parquet(f"{out}/{t}").count() for t in ("raw", "clean")]

    first = run()
    assert first == [34, 27]
    land([("T", "@c1", 99, "late", "d", False, "2023-01-01 00:00:00")])
    assert run() == [35, 28]
