"""Message tables derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.schemas import ENTITY

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

# Seeded first lines with what the prose lacks: Ethiopic text, emoji, phones, odd spaces,
# short forms, labialised spellings. One per remainder of the id; shared with the SQL checks.
SEED_TEXTS = [
    "  ቡና   ማሽን \n 500 ብር\n0911223344 ቦሌ  ",
    "ጫማ😀 ኦርጂናል\nዋጋ፡ 1200.50\nበመገናኛ ሞል",
    "ሐመር ሠላም ዐይን\nETB 1,200 0911223344\nfree delivery «ቡዋ» ሙአል፡፡",
    "\n99 birr only ዶ/ር አበበ ት/ቤት",
    "🇪🇹 ኀይል ጸሐይ\n09112233445 Birr $5 1200.505",
    "a\u00a0b  c\u001cd\u0085e",
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seed_text(doc_id: Column) -> Column:
    out = F.lit(SEED_TEXTS[-1])
    for remainder in reversed(range(len(SEED_TEXTS) - 1)):
        out = F.when(doc_id % len(SEED_TEXTS) == remainder, SEED_TEXTS[remainder]).otherwise(out)
    return out


def to_posts(documents: DataFrame) -> DataFrame:
    """Message columns that need ``documents`` only; also works on a stream."""
    doc_id, source, text = F.col("doc_id"), F.col("source"), F.col("text")
    return documents.select(
        doc_id.alias("id"),
        source.alias("channel_title"),
        F.when(doc_id % 2 == 0, F.concat(F.lit("@"), source))
        .otherwise(F.concat(F.lit("@shop_"), source)).alias("channel_username"),
        # The seeded lines come first, then the whole prose.
        F.concat(seed_text(doc_id), F.lit("\n"), text).alias("text"),
        F.when(doc_id % 17 == 0, "").when(doc_id % 23 != 0, text).alias("message"),
        F.col("n_chars").alias("views"),
        (doc_id % 4 == 0).alias("has_photo"),
    )


#: Session setting: deal the rows of a small one-file table out to so many partitions before
#: costly text work. Unset, nothing is shuffled, whatever the table's size.
SPREAD = "spark.feedlens.spread"


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    partitions = spark.conf.get(SPREAD, None)
    return to_posts(documents.repartition(int(partitions), "doc_id") if partitions else documents)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with their date text and entity list (joins events and parts)."""
    events = read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts0")
    )
    parts = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), "p_name", "p_retailprice"
    )
    entity = F.struct(
        F.lit("B-PRODUCT").alias("label"),
        F.col("p_name").alias("word"),
        F.concat(F.col("p_retailprice").cast("string"), F.lit(" ETB")).alias("price"),
    )
    price_note = F.struct(
        F.lit("I-PRICE").alias("label"), F.lit("5").alias("word"), F.lit("5").alias("price")
    )
    entities = F.when(
        (F.col("id") % 5 < 3) & F.col("p_name").isNotNull(), F.array(price_note, entity)
    ).otherwise(F.array().cast(f"array<{ENTITY.simpleString()}>"))
    return (
        to_posts(read(spark, sf_dir, "documents"))
        .join(events, "id")
        .join(parts, "id", "left")
        .withColumn(
            "date", F.when(F.col("id") % 29 == 0, "bad").otherwise(F.col("ts0").cast("string"))
        )
        .withColumn("entities", entities)
        .drop("p_name", "p_retailprice")
    )
