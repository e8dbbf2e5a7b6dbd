"""Message table -> labelled sentences as CoNLL text, with counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.operators import dataset as D
from feedlens.operators.cleaning import drop_null_text, preprocess_messages
from feedlens.sources.conll import read_conll, write_conll


def labelled_sentences(messages: DataFrame, key: str = "id", script: str = "ethiopic") -> DataFrame:
    """Preprocessed messages with text as ``sid, tokens``. Preprocessing leaves no line break,
    so a message is one line and all its tokens get the labels of a first line."""
    rows = preprocess_messages(drop_null_text(messages), script)
    return D.label_sentences(rows, key=key, text="message")


def run_labelling(messages: DataFrame, out: str, key: str = "id", script: str = "ethiopic") -> DataFrame:
    """Write the sentences below ``out`` as CoNLL text and return the tokens per label, counted
    in what was written: the messages are preprocessed and labelled once."""
    write_conll(labelled_sentences(messages, key, script), out)
    tokens = read_conll(messages.sparkSession, out).select(F.explode("tokens").alias("t"))
    return tokens.groupBy(F.col("t.label").alias("label")).agg(F.count(F.lit(1)).alias("tokens"))
