"""Labelled sentences as training data.

A sentence table has key columns (``sid`` by default) and
``tokens array<struct<token,label>>``; a token table has one row per token.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.labels import first_line_label, label_message, rest_label
from feedlens.functions.text import _col, first_line, text_lines, ws_gaps, ws_tokens
from feedlens.operators.gazetteer import mark_places
from feedlens.session import stored


def label_sentences(
    df: DataFrame,
    key: str = "id",
    text: str = "text",
    marks: list[str] | None = None,
    places: list[str] | None = None,
    collapse_first: bool = False,
) -> DataFrame:
    """Messages -> ``sid, tokens``; one narrow step, sentences without tokens kept."""
    return df.select(
        F.col(key).alias("sid"),
        label_message(text, marks, places, collapse_first).alias("tokens"),
    )


def _word_rows(df: DataFrame, keys: list[str], text: str, gaps: bool) -> DataFrame:
    """Token rows ``pos, token, previous`` of the texts, and with ``gaps`` the whitespace before
    each token (``gap``) and behind the last one (``tail``)."""
    arrays = [F.col("_words").alias("token"), F.concat(F.array(F.lit("")), F.col("_words")).alias("previous")]
    columns = ["pos", "t.token", "t.previous"]
    words = df.select(*keys, ws_tokens(text).alias("_words"), *([ws_gaps(text).alias("_gaps")] if gaps else []))
    if gaps:
        arrays += [F.col("_gaps").alias("gap"), F.slice("_gaps", F.lit(2), F.size("_gaps")).alias("tail")]
        last = F.col("pos") == F.size("_words") - 1
        columns += ["t.gap", F.when(last, F.col("t.tail")).otherwise("").alias("tail")]
    # The shifted arrays are one longer: their last item has no token.
    return (
        words.select(*keys, *(["_words"] if gaps else []), F.posexplode(F.arrays_zip(*arrays)).alias("pos", "t"))
        .where(F.col("t.token").isNotNull())
        .select(*keys, *columns)
    )


def labeled_tokens(
    df: DataFrame,
    key: str = "id",
    text: str = "text",
    marks: list[str] | None = None,
    places: list[str] | DataFrame | None = None,
    keep: list[str] | None = None,
    gaps: bool = False,
) -> DataFrame:
    """Messages -> token rows ``sid, pos, token, previous, label`` and the columns in ``keep``.

    The same rows as ``token_rows(label_sentences(df))``. The label comes after the explode
    here, so that it is a plain column in generated code. ``gaps`` adds ``gap`` and ``tail``,
    the whitespace before each token and behind the last one. ``places`` is a short list, or
    a table with a ``place`` column of any size.
    """
    keys = ["sid", *(keep or [])]
    words = df.withColumn("sid", F.col(key)).withColumn("_first", F.size(ws_tokens(first_line(text))))
    rows = _word_rows(words, [*keys, "_first"], text, gaps)
    rest = rest_label("token", marks, None if isinstance(places, DataFrame) else places)
    if isinstance(places, DataFrame):
        rows = mark_places(rows, places, out="_place")
        plain = rest_label("token", marks, [])
        rest = F.when((plain == "O") & F.col("_place"), F.lit("I-LOC")).otherwise(plain)
    label = F.when(F.col("pos") < F.col("_first"), first_line_label(F.col("pos"))).otherwise(rest)
    return rows.select(
        *keys, "pos", "token", "previous", label.alias("label"), *(["gap", "tail"] if gaps else [])
    )


def text_tokens(df: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """Unlabelled texts -> token rows ``sid, pos, token, previous, gap, tail``."""
    return _word_rows(df.withColumn("sid", F.col(key)), ["sid"], text, gaps=True)


def label_counts(
    df: DataFrame, text: str = "text", marks: list[str] | None = None, places: list[str] | None = None
) -> DataFrame:
    """Tokens per label over all messages.

    Line by line, so that every step is a plain column in generated code (a per-message
    column carried through the explode would be computed again for each token); the count
    is combined before its one tiny shuffle.
    """
    lines = df.select(F.posexplode(text_lines(text)).alias("line", "body"))
    tokens = lines.select("line", F.posexplode(ws_tokens("body")).alias("pos", "token"))
    label = F.when(F.col("line") == 0, first_line_label(F.col("pos"))).otherwise(
        rest_label("token", marks, places)
    )
    return tokens.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("tokens"))


def labeled_message_count(sentences: DataFrame) -> DataFrame:
    """Number of labelled messages, blank ones included."""
    return sentences.agg(F.count(F.lit(1)).alias("messages"))


def tag_array(tokens: Column | str = "tokens") -> Column:
    return F.transform(_col(tokens), lambda t: t["label"])


def word_array(tokens: Column | str = "tokens") -> Column:
    return F.transform(_col(tokens), lambda t: t["token"])


def token_rows(sentences: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per token: ``sid, pos, token, previous, label`` (previous: empty at the
    start) and the sentence columns in ``keep``."""
    keys = ["sid", *(keep or [])]
    words = sentences.select(*keys, "tokens", word_array().alias("_words"))
    shifted = F.zip_with(
        "tokens",
        F.concat(F.array(F.lit("")), F.col("_words")),
        lambda t, p: F.struct(t["token"].alias("token"), p.alias("previous"), t["label"].alias("label")),
    )
    # The shifted array is one longer: its last item has no token.
    return (
        words.select(*keys, F.posexplode(shifted).alias("pos", "t"))
        .where(F.col("t.token").isNotNull())
        .select(*keys, "pos", "t.token", "t.previous", "t.label")
    )


def label_list(sentences: DataFrame) -> DataFrame:
    """Distinct labels, sorted."""
    return sentences.select(F.explode(tag_array()).alias("label")).distinct().orderBy("label")


def label_index(sentences: DataFrame) -> DataFrame:
    """``label, label_id`` with ids 0..n-1 in label order. The window has one partition,
    but only one row per distinct label reaches it."""
    labels = sentences.select(F.explode(tag_array()).alias("label")).distinct()
    position = F.row_number().over(Window.orderBy("label")) - 1
    return labels.select("label", position.cast("int").alias("label_id"))


def encode_tags(tags: Column | str, labels: list[str], unknown: int | None = None) -> Column:
    """Tags -> ids; the position in ``labels`` is the id."""
    lookup = F.create_map(*[F.lit(x) for i, lab in enumerate(labels) for x in (lab, i)])
    miss = F.lit(unknown).cast("int")
    return F.transform(_col(tags), lambda t: F.coalesce(lookup[t], miss))


def decode_tags(ids: Column | str, labels: list[str]) -> Column:
    names = F.array(*map(F.lit, labels))
    return F.transform(_col(ids), lambda i: F.get(names, i))


_DIGEST_DIGITS = 32


def _digest(key: Column | str, seed: int) -> Column:
    text = _col(key).cast("string")
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), text) if seed else text)


def is_test(key: Column | str = "sid", buckets: int = 5, seed: int = 0) -> Column:
    """True for one hash bucket of ``buckets``: the same rows on every run and cluster."""
    digits = F.substring(_digest(key, seed), 1, 4)
    return F.conv(digits, 16, 10).cast("int") % buckets == 0


def train_test_split(
    df: DataFrame, key: str = "sid", test_share: float = 0.2, seed: int = 0, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by a hash of the key, without a shuffle.

    The share of a hash split varies a little; ``exact`` takes the ceil(share x n) rows
    with the smallest digests instead.
    """
    if exact:
        marked = exact_split(df, key, test_share, seed)
        return marked.where(~F.col("test")).drop("test"), marked.where("test").drop("test")
    # 16 bits of the digest: the share is met to within 1/65536.
    test = F.conv(F.substring(_digest(key, seed), 1, 4), 16, 10).cast("int")
    buckets = round(1 / test_share)
    in_test = is_test(key, buckets, seed) if math.isclose(test_share * buckets, 1) else (
        test < round(test_share * 65536)
    )
    return df.where(~in_test), df.where(in_test)


#: A digest prefix of at most so many rows is sorted to find the boundary inside it.
FEW_ROWS = 10_000
_ROUND_DIGITS = 4


def exact_split(df: DataFrame, key: str = "sid", test_share: float = 0.2, seed: int = 0) -> DataFrame:
    """``df`` with ``test``: true for exactly ceil(share x n) rows, those with the smallest
    digest of the (unique) key.

    No global sort: each round counts the rows per next four digits of the digest (65,536
    counts at most) within the prefix that holds the boundary, one scan a round, until that
    prefix holds ``FEW_ROWS`` at most. A round has a 65,536th of the rows of the one before,
    so no task ranks a part that grows with them. Runs while it is called.
    """
    df = df.withColumn("_digest", _digest(key, seed))
    prefix, wanted = "", None
    while True:
        digits = len(prefix) + _ROUND_DIGITS
        some = df.where(F.col("_digest").startswith(prefix))
        counts = some.groupBy(F.substring("_digest", 1, digits).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        counts = stored(counts, "digest-counts")
        if wanted is None:
            total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
            wanted = math.ceil(total * test_share)
            if not wanted:
                return df.withColumn("test", F.lit(False)).drop("_digest")
        upto = F.sum("n").over(Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
        edge = counts.select("prefix", "n", upto.alias("upto")).where(F.col("upto") >= wanted).orderBy("prefix").first()
        prefix, wanted = edge["prefix"], wanted - (edge["upto"] - edge["n"])
        if edge["n"] <= FEW_ROWS or digits >= _DIGEST_DIGITS:
            break
    boundary = some.where(F.col("_digest").startswith(prefix)).select("_digest").orderBy("_digest").limit(wanted)
    last = boundary.agg(F.max("_digest").alias("last")).first()["last"]
    return df.withColumn("test", F.coalesce(F.col("_digest") <= last, F.lit(False))).drop("_digest")
