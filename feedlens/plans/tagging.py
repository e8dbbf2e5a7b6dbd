"""Labelled sentences -> trained, evaluated and compared taggers."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.operators import dataset as D
from feedlens.operators import entities as E
from feedlens.operators import tagging as G
from feedlens.sources.tables import write_table


def split_tokens(rows: DataFrame) -> DataFrame:
    """Token rows with the split in ``test``. They are not stored: a token table is larger
    than its messages, and each part labels only its own messages again."""
    return rows if "test" in rows.columns else rows.withColumn("test", D.is_test("sid"))


def train_part(tokens: DataFrame) -> DataFrame:
    return tokens.where(~F.col("test")).drop("test")


def test_part(tokens: DataFrame) -> DataFrame:
    return tokens.where("test").drop("test")


def train_model(
    tokens: DataFrame, variants: list[str], labels: list[str] | None = None
) -> DataFrame:
    """One stored model with the features of all these variants, from one pass over the
    training part."""
    features = dict.fromkeys(f for variant in variants for f in G.VARIANTS[variant])
    return G.store_model(G.train_tagger(train_part(tokens), list(features), labels))


def tag_test_part(
    tokens: DataFrame,
    variant: str = "token+suffix",
    labels: list[str] | None = None,
    model: DataFrame | None = None,
) -> DataFrame:
    """Tag the test part with a given model, or with one trained on the other part."""
    if model is None:
        model = train_model(tokens, [variant], labels)
    return G.apply_tagger(test_part(tokens), model, G.VARIANTS[variant], labels)


def compare_models(
    tokens: DataFrame,
    variants: list[str] | None = None,
    labels: list[str] | None = None,
    timed: bool = False,
) -> DataFrame:
    """``model, eval_loss, eval_f1`` of each variant on one split, best F1 first.

    The variants share one training pass and one tagging pass. ``timed`` trains and runs each
    on its own, one after the other, and adds ``runtime`` in seconds.
    """
    variants = variants or list(G.VARIANTS)
    columns = ["model", "eval_loss", "eval_f1"]

    def result(variant: str, model: DataFrame | None) -> DataFrame:
        scores = G.evaluate(tag_test_part(tokens, variant, labels, model), labels)
        return scores.withColumn("model", F.lit(variant)).select(columns)

    if timed:
        spark = tokens.sparkSession
        rows = []
        for variant in variants:
            started = time.perf_counter()
            row = result(variant, None).first()  # one row per model
            rows.append((*row, round(time.perf_counter() - started, 2)))
        table = spark.createDataFrame(rows, "model string, eval_loss double, eval_f1 double, runtime double")
    else:
        model = train_model(tokens, variants, labels)
        table = G.evaluate_variants(test_part(tokens), model, {v: G.VARIANTS[v] for v in variants}, labels)
    return table.orderBy(F.desc("eval_f1"), "model")


def tag_texts(
    texts: DataFrame, model: DataFrame, features: list[str], key: str = "id", text: str = "text",
    labels: list[str] | None = None,
) -> DataFrame:
    """Tag unlabelled texts: token rows with ``prediction`` and ``score``, and the gaps that
    entity offsets need."""
    return G.apply_tagger(D.text_tokens(texts, key, text), model, features, labels)


def report_texts(
    texts: DataFrame, model: DataFrame, features: list[str], key: str = "id", text: str = "text",
    labels: list[str] | None = None,
) -> DataFrame:
    """``text, word, label, score`` of every entity found in unlabelled texts."""
    return E.entity_report(E.texts_with_entities(tag_texts(texts, model, features, key, text, labels)))


def run_report(
    texts: DataFrame, model: DataFrame, features: list[str], out: str, fmt: str = "csv", key: str = "id",
    text: str = "text", labels: list[str] | None = None,
) -> None:
    """Write the entity report of unlabelled texts."""
    write_table(report_texts(texts, model, features, key, text, labels), out, fmt)
