"""Entity spans of one tag sequence, in linear time and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.functions.text import _col, bind


def _inside(tag: Column) -> Column:
    return tag.startswith("B-") | tag.startswith("I-")


def tag_type(tag: Column) -> Column:
    """``PRODUCT`` for ``B-PRODUCT`` and ``I-PRODUCT``; NULL outside an entity."""
    return F.when(_inside(tag), F.substr(tag, F.lit(3)))


def opens_span(tag: Column, previous: Column) -> Column:
    """``B-`` opens a span; ``I-`` opens one unless it continues the same type."""
    return tag.startswith("B-") | (
        tag.startswith("I-") & ~tag_type(tag).eqNullSafe(tag_type(previous))
    )


def tag_spans(tags: Column | str) -> Column:
    """``array<struct<type,start,end>>`` (token positions, end included).

    A boundary is a token that opens a span or lies outside; a span runs from its
    boundary to the token before the next one.
    """
    return bind(_col(tags), lambda t: bind(_boundaries(t), lambda b: _between(t, b)))


def _boundaries(tags: Column) -> Column:
    """Positions of the boundaries."""
    def is_boundary(i: Column) -> Column:
        tag = F.get(tags, i)
        return ~_inside(tag) | opens_span(tag, F.get(tags, i - 1))

    return F.filter(F.transform(tags, lambda t, i: i), is_boundary)


def _between(tags: Column, bounds: Column) -> Column:
    following = F.slice(bounds, F.lit(2), F.greatest(F.size(bounds), F.lit(1)))
    spans = F.zip_with(
        bounds,
        F.concat(following, F.array(F.size(tags))),
        lambda start, stop: F.struct(
            tag_type(F.get(tags, start)).alias("type"),
            start.alias("start"),
            (stop - 1).alias("end"),
        ),
    )
    # Tokens outside an entity, and the lone stop of an empty sequence, have no type.
    return F.filter(spans, lambda s: s["type"].isNotNull())


def span_keys(tags: Column | str) -> Column:
    """Spans as ``TYPE:start:end`` text, so that set functions hash them."""
    return F.transform(
        tag_spans(tags), lambda s: F.concat_ws(":", s["type"], s["start"], s["end"])
    )


def span_key_type(key: Column) -> Column:
    return F.substring_index(key, ":", 1)
