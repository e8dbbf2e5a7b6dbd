"""Declared schemas; nothing is inferred from data."""

from pyspark.sql import types as T

# Header names of the message file, in file order.
MESSAGE_HEADER = {
    "Channel Title": "channel_title",
    "Channel Username": "channel_username",
    "ID": "id",
    "Message": "message",
    "Date": "date",
    "Media Path": "media_path",
}
OPTIONAL_HEADER = {"views": "views", "entities": "entities"}

# Header names of the scorecard and the report files.
SCORECARD_HEADER = {
    "vendor": "Vendor",
    "avg_views": "Avg Views/Post",
    "posts_per_week": "Posts/Week",
    "avg_price": "Avg Price (ETB)",
    "top_product": "Top Product",
    "top_price": "Top Price",
    "lending_score": "Lending Score",
}
RAW_VS_CLEAN_HEADER = {"raw_count": "Raw Count", "cleaned_count": "Cleaned Count"}

# Dates stay text until parse_timestamp: the landing files may hold unparsable ones.
MESSAGES = T.StructType([
    T.StructField("channel_title", T.StringType()),
    T.StructField("channel_username", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("media_path", T.StringType()),
])

LABELED_TOKEN = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("label", T.StringType()),
])

ENTITY = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("word", T.StringType()),
    T.StructField("price", T.StringType()),
])
