"""A count-based token tagger whose model is a table.

``P(tag | key) = (n(key, tag) + 1) / (n(key) + number of tags)`` for several kinds of
key ("features"), tried in order until one was seen in training; the tag prior comes last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens import rules
from feedlens.functions.numbers import round_to
from feedlens.functions.spans import span_keys
from feedlens.operators.skew import join_by_key_counts
from feedlens.session import stored

SUFFIX_LENGTH = 3
PRIOR = "prior"

# Model variants: the features tried before the prior, in order.
VARIANTS = {
    "token": ["token"],
    "token+suffix": ["token", "suffix"],
    "prev+token": ["prev_token", "token"],
}


def feature_key(feature: str) -> Column:
    """Key of a token row under one feature. Tokens hold no whitespace, so a tab separates."""
    if feature == "token":
        return F.col("token")
    if feature == "suffix":
        return F.right(F.col("token"), F.lit(SUFFIX_LENGTH))
    if feature == "prev_token":
        return F.concat_ws("\t", "previous", "token")
    if feature == PRIOR:
        return F.lit("")
    raise ValueError(f"unknown feature {feature!r}")


def _inputs(features: list[str]) -> list[str]:
    """Columns a token row needs for these features."""
    return ["previous", "token"] if "prev_token" in features else ["token"]


def train_tagger(
    rows: DataFrame, features: list[str], labels: list[str] | None = None
) -> DataFrame:
    """Token rows -> model ``feature, key, counts, total, scores`` (arrays in label order).

    Counts are first combined per distinct token, and only then spread over the features.
    All buffers are plain numbers, so both steps are hash aggregates with a map side.
    """
    labels = labels or rules.TAGS
    names = [f"n{i}" for i in range(len(labels))]
    per_input = rows.groupBy(*_inputs(features)).agg(
        *[F.count_if(F.col("label") == lab).alias(n) for n, lab in zip(names, labels)]
    )
    keys = F.array(
        *[F.struct(F.lit(f).alias("feature"), feature_key(f).alias("key")) for f in [*features, PRIOR]]
    )
    per_key = (
        per_input.select(F.explode(keys).alias("k"), *names)
        .groupBy("k.feature", "k.key")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return (
        per_key.withColumn("total", total)
        .select(
            "feature", "key", F.array(*names).alias("counts"), "total",
            F.array(*[(F.col(n) + 1) / (F.col("total") + len(labels)) for n in names]).alias("scores"),
        )
    )


def store_model(model: DataFrame) -> DataFrame:
    """The model as a stored table with one folder per feature."""
    return stored(model, "model", partition_by=["feature"])


def model_rows(model: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """The model as one row per (feature, key, label)."""
    names = F.array(*map(F.lit, labels or rules.TAGS))
    entries = F.arrays_zip(names.alias("label"), F.col("counts").alias("n"), F.col("scores").alias("score"))
    return model.select("feature", "key", "total", F.inline(entries))


def resolve(
    vocabulary: DataFrame, model: DataFrame, variants: list[list[str]], labels: list[str] | None = None
) -> DataFrame:
    """Adds ``scores<i>`` for each list of features to a table of distinct tokens: the scores of
    the first feature that was seen in training. Each feature of the model is joined once,
    however many variants use it. Pass a stored model."""
    labels = labels or rules.TAGS
    features = list(dict.fromkeys(f for variant in variants for f in variant))
    for i, feature in enumerate(features):
        part = model.where(F.col("feature") == feature).select(
            F.col("key").alias(f"_k{i}"), F.col("scores").alias(f"_s{i}")
        )
        vocabulary = vocabulary.join(part, feature_key(feature) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    # An untrained model has no prior row either: every tag is then equally likely.
    even = F.array_repeat(F.lit(1.0 / len(labels)), len(labels))
    prior = model.where(F.col("feature") == PRIOR).select("scores").scalar()
    columns = [c for c in vocabulary.columns if c not in {f"_s{i}" for i in range(len(features))}]
    return vocabulary.select(*columns, *[
        F.coalesce(*[F.col(f"_s{features.index(f)}") for f in variant], prior, even).alias(f"scores{v}")
        for v, variant in enumerate(variants)
    ])


def best_label(scores: Column, labels: list[str] | None = None) -> Column:
    """The label of the highest score, the first of equal ones."""
    at = F.array_position(scores, F.array_max(scores)).cast("int") - 1
    return F.get(F.array(*map(F.lit, labels or rules.TAGS)), at)


def apply_tagger(
    rows: DataFrame, model: DataFrame, features: list[str], labels: list[str] | None = None
) -> DataFrame:
    """Adds ``prediction``, ``score`` and ``scores`` to token rows.

    Equal tokens get equal tags, so the back-off runs once per distinct token. That
    vocabulary is stored (it is read several times, and its size decides the join), and
    the token rows are joined to it, frequent tokens by broadcast. Pass a stored model.
    """
    inputs = _inputs(features)
    vocabulary = rows.groupBy(*inputs).agg(F.count(F.lit(1)).alias("n"))
    scores = F.col("scores0")
    resolved = resolve(vocabulary, model, [features], labels).select(
        *inputs, "n", scores.alias("scores"), F.array_max(scores).alias("score"),
        best_label(scores, labels).alias("prediction"),
    )
    return join_by_key_counts(rows, stored(resolved, "vocabulary"), inputs)


def evaluate_variants(
    rows: DataFrame, model: DataFrame, variants: dict[str, list[str]], labels: list[str] | None = None
) -> DataFrame:
    """``model, eval_loss, eval_f1`` of several variants on labelled token rows, in one pass.

    One vocabulary holds a prediction per variant; the loss is summed over it, by the number
    of occurrences of each label. The token rows meet it once and are brought together by
    sentence once, with all predictions side by side.
    """
    labels = labels or rules.TAGS
    features = list(variants.values())
    inputs = _inputs([f for variant in features for f in variant])
    counts = [f"n{i}" for i in range(len(labels))]
    vocabulary = rows.groupBy(*inputs).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("label") == lab).alias(n) for n, lab in zip(counts, labels)],
    )

    def loss(scores: Column) -> Column:
        of_label = [-F.ln(F.get(scores, F.lit(i))) * F.col(n) for i, n in enumerate(counts)]
        return sum(of_label[1:], of_label[0])

    number = range(len(features))
    resolved = stored(
        resolve(vocabulary, model, features, labels).select(
            *inputs, "n",
            *[best_label(F.col(f"scores{v}"), labels).alias(f"p{v}") for v in number],
            *[loss(F.col(f"scores{v}")).alias(f"loss{v}") for v in number],
        ),
        "vocabulary",
    )
    losses = resolved.agg(F.sum("n").alias("n"), *[F.sum(f"loss{v}").alias(f"loss{v}") for v in number])
    guesses = [f"p{v}" for v in number]
    tagged = join_by_key_counts(rows, resolved.select(*inputs, "n", *guesses), inputs)
    items = F.sort_array(F.collect_list(F.struct("pos", "label", *guesses)))
    sentences = tagged.groupBy("sid").agg(items.alias("items"))
    spans = sentences.select(*[span_keys(F.col(f"items.{c}")).alias(c) for c in ["label", *guesses]])
    sums = spans.agg(
        *[F.sum(F.size(F.array_intersect("label", g))).alias(f"found_{g}") for g in guesses],
        *[F.sum(F.size("label") + F.size(g)).alias(f"spans_{g}") for g in guesses],
    )

    def row(v: int, name: str) -> Column:
        found, total = F.col(f"found_p{v}"), F.col(f"spans_p{v}")
        f1 = F.when(total > 0, found * 2 / total).otherwise(F.lit(0.0))
        loss_v = round_to(F.col(f"losses.loss{v}") / F.col("losses.n"), 6)
        return F.struct(F.lit(name).alias("model"), loss_v.alias("eval_loss"), round_to(f1, 6).alias("eval_f1"))

    both = sums.withColumn("losses", losses.select(F.struct("*")).scalar())
    return both.select(F.inline(F.array(*[row(v, m) for v, m in enumerate(variants)])))


def argmax_labels(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Long score rows (``keys, label, label_id, score``) -> the best label per key; the
    smallest id wins ties."""
    best = F.max_by("label", F.struct(F.col("score"), -F.col("label_id")))
    return scores.groupBy(*keys).agg(best.alias("label"))


def token_loss(labels: list[str] | None = None) -> Column:
    """Cross-entropy of one tagged token: -ln P(true label)."""
    names = F.array(*map(F.lit, labels or rules.TAGS))
    at = F.array_position(names, F.col("label")).cast("int") - 1
    return -F.ln(F.get("scores", at))


def eval_loss(tagged: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Mean cross-entropy over all tagged tokens."""
    return tagged.agg(round_to(F.avg(token_loss(labels)), 6).alias("eval_loss"))


def tagged_sentences(tagged: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Tagged token rows -> one row per sentence: ``sid, labels, predictions, loss, tokens``."""
    items = F.sort_array(F.collect_list(F.struct("pos", "label", "prediction")))
    grouped = tagged.withColumn("_loss", token_loss(labels)).groupBy("sid").agg(
        items.alias("items"), F.sum("_loss").alias("loss"), F.count(F.lit(1)).alias("tokens")
    )
    return grouped.select(
        "sid",
        F.transform("items", lambda x: x["label"]).alias("labels"),
        F.transform("items", lambda x: x["prediction"]).alias("predictions"),
        "loss",
        "tokens",
    )


def evaluate(tagged: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """``eval_loss, eval_f1`` of tagged token rows: one exchange on the sentence."""
    sentences = (
        tagged_sentences(tagged, labels)
        .withColumn("a", span_keys("labels"))
        .withColumn("p", span_keys("predictions"))
    )
    sums = sentences.agg(
        F.sum("loss").alias("loss"),
        F.sum("tokens").alias("tokens"),
        F.sum(F.size(F.array_intersect("a", "p"))).alias("found"),
        F.sum(F.size("a") + F.size("p")).alias("spans"),
    )
    f1 = F.when(F.col("spans") > 0, F.col("found") * 2 / F.col("spans")).otherwise(F.lit(0.0))
    return sums.select(
        round_to(F.col("loss") / F.col("tokens"), 6).alias("eval_loss"), round_to(f1, 6).alias("eval_f1")
    )
