"""Entity spans and entity-level scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.spans import opens_span, span_key_type, span_keys, tag_type


def mark_spans(tags: DataFrame, sid: str = "sid", pos: str = "pos", tag: str = "tag") -> DataFrame:
    """Adds ``type`` (NULL outside an entity) and ``span``, the number of spans opened so
    far in the sentence.

    Gaps and islands over one sentence: one exchange on the sentence key, which later
    groupings by (sentence, span) reuse.
    """
    order = Window.partitionBy(sid).orderBy(pos)
    opened = opens_span(F.col(tag), F.lag(tag).over(order))
    return (
        tags.withColumn("_open", opened.cast("int"))
        .withColumn("span", F.sum("_open").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("type", tag_type(F.col(tag)))
        .drop("_open")
    )


def entity_spans(tags: DataFrame, sid: str = "sid", pos: str = "pos", tag: str = "tag") -> DataFrame:
    """Tag rows -> ``sid, type, start, end`` (end included). For tags held in an array,
    ``functions.spans.tag_spans`` does the same without an exchange."""
    return (
        mark_spans(tags, sid, pos, tag)
        .where(F.col("type").isNotNull())
        .groupBy(sid, "span")
        .agg(F.first("type").alias("type"), F.min(pos).alias("start"), F.max(pos).alias("end"))
        .drop("span")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _scores(found: Column, predicted: Column, actual: Column) -> list[Column]:
    precision, recall = _ratio(found, predicted), _ratio(found, actual)
    return [
        precision.alias("precision"),
        recall.alias("recall"),
        # 2PR / (P + R), written on the counts
        _ratio(found * 2, predicted + actual).alias("f1"),
    ]


def sentence_spans(df: DataFrame, actual: str = "labels", predicted: str = "predictions") -> DataFrame:
    """Adds ``actual_spans`` and ``predicted_spans`` (text keys) to rows with tag arrays."""
    return df.withColumn("actual_spans", span_keys(actual)).withColumn(
        "predicted_spans", span_keys(predicted)
    )


def entity_f1(df: DataFrame, actual: str = "labels", predicted: str = "predictions") -> DataFrame:
    """Micro precision, recall and F1 over exact (type, start, end) matches; 0 where the
    denominator is 0. One row per sentence in, so no join: only counts are shuffled."""
    counts = sentence_spans(df, actual, predicted).agg(
        F.coalesce(F.sum(F.size(F.array_intersect("actual_spans", "predicted_spans"))), F.lit(0)).alias("found"),
        F.coalesce(F.sum(F.size("predicted_spans")), F.lit(0)).alias("predicted"),
        F.coalesce(F.sum(F.size("actual_spans")), F.lit(0)).alias("actual"),
    )
    found, predicted_n, actual_n = F.col("found"), F.col("predicted"), F.col("actual")
    return counts.select(*_scores(found, predicted_n, actual_n), "found", "predicted", "actual")


def entity_f1_from_spans(actual: DataFrame, predicted: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The same scores from two span tables: one grouping over their union, no join."""
    keys = keys or ["sid", "type", "start", "end"]
    both = actual.select(*keys, F.lit(1).alias("a"), F.lit(0).alias("p")).unionByName(
        predicted.select(*keys, F.lit(0).alias("a"), F.lit(1).alias("p"))
    )
    spans = both.groupBy(*keys).agg(F.max("a").alias("a"), F.max("p").alias("p"))
    counts = spans.agg(
        F.coalesce(F.sum(F.col("a") * F.col("p")), F.lit(0)).alias("found"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("predicted"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("actual"),
    )
    found, predicted_n, actual_n = F.col("found"), F.col("predicted"), F.col("actual")
    return counts.select(*_scores(found, predicted_n, actual_n), "found", "predicted", "actual")


def classification_report(df: DataFrame, actual: str = "labels", predicted: str = "predictions") -> DataFrame:
    """``name, precision, recall, f1, support``: a row per type, then the micro, macro
    and weighted averages. The averages come from the few per-type rows."""
    spans = sentence_spans(df, actual, predicted)
    each = spans.select(
        F.explode(
            F.concat(
                _marked("actual_spans", 1, 0, 0),
                _marked("predicted_spans", 0, 1, 0),
                _marked(F.array_intersect("actual_spans", "predicted_spans"), 0, 0, 1),
            )
        ).alias("s")
    )
    per_type = each.groupBy(F.col("s.type").alias("name")).agg(
        F.sum("s.found").alias("found"),
        F.sum("s.predicted").alias("predicted"),
        F.sum("s.actual").alias("support"),
    )
    names = ["precision", "recall", "f1"]
    scored = per_type.select(
        "*", *_scores(F.col("found"), F.col("predicted"), F.col("support"))
    )
    # The rollup adds one total row to the few per-type rows; it becomes the three averages.
    sums = [F.sum(c).alias(c) for c in ("found", "predicted", "support")]
    means = [F.avg(c).alias(c) for c in names]
    weighted = [
        _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}") for c in names
    ]
    rolled = scored.rollup("name").agg(F.grouping("name").alias("total"), *sums, *means, *weighted)

    def row(order: int, name: Column, values: list[Column]) -> Column:
        named = [v.alias(c) for v, c in zip(values, names)]
        return F.struct(F.lit(order).alias("order"), name.alias("name"), *named, "support")

    mean = [F.col(c) for c in names]
    averages = F.array(
        row(1, F.lit("micro avg"), _scores(F.col("found"), F.col("predicted"), F.col("support"))),
        row(2, F.lit("macro avg"), mean),
        row(3, F.lit("weighted avg"), [F.col(f"weighted_{c}") for c in names]),
    )
    own = F.array(row(0, F.col("name"), mean))
    return (
        rolled.where(F.col("support").isNotNull())
        .select(F.explode(F.when(F.col("total") == 1, averages).otherwise(own)).alias("r"))
        .orderBy("r.order", "r.name")
        .select("r.name", *[f"r.{c}" for c in names], "r.support")
    )


def _marked(keys: Column | str, actual: int, predicted: int, found: int) -> Column:
    return F.transform(
        keys,
        lambda k: F.struct(
            span_key_type(k).alias("type"),
            F.lit(actual).alias("actual"),
            F.lit(predicted).alias("predicted"),
            F.lit(found).alias("found"),
        ),
    )
