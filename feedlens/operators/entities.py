"""Predicted entities: grouping, reports, low-confidence texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens import rules
from feedlens.operators.metrics import mark_spans


def with_gaps(tokens: DataFrame) -> DataFrame:
    """Token rows with the whitespace before each token (``gap``) and behind the last one
    (``tail``). Without these columns the text is taken to be the tokens joined by one space."""
    if "gap" in tokens.columns:
        return tokens
    return tokens.withColumn("gap", F.when(F.col("pos") == 0, "").otherwise(" ")).withColumn("tail", F.lit(""))


def with_offsets(tokens: DataFrame) -> DataFrame:
    """Adds ``start`` and ``end`` (excluded) of every token in its text, in code points."""
    upto = Window.partitionBy("sid").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = with_gaps(tokens)
    end = F.sum(F.length("gap") + F.length("token")).over(upto)
    return placed.withColumn("end", end).withColumn("start", F.col("end") - F.length("token"))


def _segments(tokens: DataFrame, tag: str, score: str) -> DataFrame:
    """Tokens of one entity, or tokens between two entities (``entity`` NULL), as one row; the
    word is the text from the first token's start to the last one's end."""
    items = F.sort_array(F.collect_list(F.struct("pos", "gap", "token", "tail")))
    return (
        mark_spans(with_offsets(tokens), tag=tag)
        .groupBy("sid", "span", F.col("type").alias("entity"))
        .agg(
            items.alias("items"),
            F.avg(score).alias("score"),
            F.min("start").alias("start"),
            F.max("end").alias("end"),
        )
        .select(
            "sid", "span", "entity", "score", "start", "end",
            F.array_join(
                F.transform("items", lambda x, i: F.when(i == 0, x["token"]).otherwise(F.concat(x["gap"], x["token"]))), ""
            ).alias("word"),
            F.get("items", F.lit(0))["gap"].alias("lead"),
            F.element_at("items", -1)["tail"].alias("tail"),
        )
    )


def group_entities(tokens: DataFrame, tag: str = "prediction", score: str = "score") -> DataFrame:
    """Adjacent tokens of one type -> ``sid, entity, word, score, start, end``; a ``B-`` tag
    starts a new entity, the score is the mean and the prefix is stripped. ``word`` is the
    slice of the text from ``start`` to ``end``, whatever whitespace stands inside.

    Offsets, islands and the grouping all use one exchange on the sentence.
    """
    found = _segments(tokens, tag, score).where(F.col("entity").isNotNull())
    return found.select("sid", "entity", "word", "score", "start", "end")


def texts_with_entities(tokens: DataFrame, tag: str = "prediction", score: str = "score") -> DataFrame:
    """Tagged tokens -> ``sid, text, entities``, one row per sentence, in the same single
    exchange. The text is the one that the tokens with their gaps come from; entities are in
    text order."""
    record = F.struct("start", "end", "entity", "word", "score", "lead", "tail")
    sentences = _segments(tokens, tag, score).groupBy("sid").agg(
        F.sort_array(F.collect_list(record)).alias("segments")
    )
    kept = F.filter("segments", lambda s: s["entity"].isNotNull())
    return sentences.select(
        "sid",
        F.array_join(F.transform("segments", lambda s: F.concat(s["lead"], s["word"], s["tail"])), "").alias("text"),
        F.transform(kept, lambda s: F.struct(
            *[s[c].alias(c) for c in ("start", "end", "entity", "word", "score")])).alias("entities"),
    )


def entity_report(texts: DataFrame) -> DataFrame:
    """One row per (text, word, label, score) from an ``entities`` array."""
    return texts.select("text", F.explode("entities").alias("e")).select(
        "text", F.col("e.word").alias("word"), F.col("e.entity").alias("label"), F.col("e.score").alias("score")
    )


def low_confidence(
    texts: DataFrame, entities: DataFrame, key: str = "sid", threshold: float = rules.LOW_CONFIDENCE
) -> DataFrame:
    """Every text with ``flagged``: no entity, or all scores below the threshold."""
    best = entities.groupBy(key).agg(F.max("score").alias("best_score"))
    flagged = F.coalesce(F.col("best_score"), F.lit(0.0)) < threshold
    return texts.join(best, key, "left").withColumn("flagged", flagged)
