"""Entity lists: parsing, prices, report helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens import rules
from feedlens.functions.numbers import clean_price
from feedlens.functions.text import WS, _col, bind
from feedlens.schemas import ENTITY

_JSON_OPTIONS = {"allowSingleQuotes": "true"}
_ENTITY_LIST = f"array<{ENTITY.simpleString()}>"


# Parts of a Python literal: quoted text, brackets and separators, bare words.
_LITERAL_PARTS = r"""(?s)"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[\[\]{}(),:]|[^\s\[\]{}(),:'"]+"""
_JSON_WORDS = {"None": "null", "True": "true", "False": "false", "(": "[", ")": "]"}


def _literal_to_json(c: Column) -> Column:
    """A list as Python writes it -> JSON: quotes, escapes, tuples, None and truth values.
    What is inside quotes stays as it is."""
    parts = F.regexp_extract_all(c, F.lit(_LITERAL_PARTS), F.lit(0))

    def text(part: Column) -> Column:
        inner = F.substr(part, F.lit(2), F.length(part) - 2)
        inner = F.regexp_replace(inner, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
        inner = F.regexp_replace(inner, r"\\'", "'")
        inner = F.regexp_replace(inner, r'(?<!\\)"', r'\\"')
        return F.concat(F.lit('"'), inner, F.lit('"'))

    def rewritten(parts: Column, part: Column, i: Column) -> Column:
        out = F.when(part.startswith("'") | part.startswith('"'), text(part))
        for word, plain in _JSON_WORDS.items():
            out = out.when(part == word, plain)
        # A comma before a closing bracket means nothing.
        last = (part == ",") & F.get(parts, i + 1).isin("]", "}", ")")
        return out.when(last, "").otherwise(part)

    return bind(parts, lambda own: F.array_join(F.transform(own, lambda p, i: rewritten(own, p, i)), ""))


def _parse_json(c: Column) -> Column:
    """Two steps, so that one item of another kind does not void the whole list."""
    items = F.from_json(c, "array<string>", _JSON_OPTIONS)
    return F.transform(items, lambda x: F.from_json(x, ENTITY, _JSON_OPTIONS))


def parse_entities(c: Column | str, python_literals: bool = True) -> Column:
    """Text of a list of records -> ``array<struct<label,word,price>>``; anything else
    gives an empty list.

    JSON and single-quoted text is parsed as it is. Unless ``python_literals`` is off, what
    that does not read is parsed as a Python literal (``None``, ``True``, ``\\x`` escapes,
    tuples), so that one such record does not void its list.
    """
    c = _col(c)
    listed = F.when(c.rlike(rf"(?s)^{WS}*\[.*\]{WS}*$"), c)
    parsed = _parse_json(listed)
    if python_literals:
        left_over = F.when(parsed.isNull(), listed)
        parsed = F.coalesce(parsed, _parse_json(_literal_to_json(left_over)))
    parsed = F.coalesce(parsed, F.array().cast(_ENTITY_LIST))
    return F.filter(
        parsed,
        lambda e: e.isNotNull() & (e["label"].isNotNull() | e["word"].isNotNull() | e["price"].isNotNull()),
    )


def _products(entities: Column) -> Column:
    return F.filter(entities, lambda e: e["label"] == "B-PRODUCT")


def product_prices(entities: Column | str) -> Column:
    """Prices of the product entities: the price, or the word where the price is missing,
    empty or zero; items that are not numbers are left out."""
    prices = F.transform(
        _products(_col(entities)),
        lambda e: clean_price(
            F.when(e["price"].isin("", "0", "0.0") | e["price"].isNull(), e["word"])
            .otherwise(e["price"])
        ),
    )
    return F.filter(F.coalesce(prices, F.array().cast("array<double>")), lambda p: p.isNotNull())


def top_product(entities: Column | str) -> Column:
    """First non-empty product word, else empty text."""
    words = F.filter(_products(_col(entities)), lambda e: F.length(e["word"]) > 0)
    return F.coalesce(F.get(words, F.lit(0))["word"], F.lit(""))


def top_price(entities: Column | str) -> Column:
    """Last product price that is a number, else 0."""
    prices = F.filter(
        F.transform(_products(_col(entities)), lambda e: clean_price(e["price"])),
        lambda p: p.isNotNull(),
    )
    return F.coalesce(F.try_element_at(prices, F.lit(-1)), F.lit(0.0))


def highlight_entities(text: Column | str, entities: Column | str) -> Column:
    """Text with every entity span (``entity``, ``start``, ``end``; end excluded) wrapped
    in a coloured HTML span."""
    ordered = F.array_sort(
        F.transform(
            _col(entities),
            lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["entity"].alias("entity")),
        )
    )
    return bind(_col(text), lambda t: bind(ordered, lambda o: _highlight(t, o)))


def _highlight(text: Column, ordered: Column) -> Column:
    ends = F.concat(F.array(F.lit(0)), F.transform(ordered, lambda e: e["end"].cast("int")))

    def cut(start: Column, end: Column) -> Column:
        return F.substring(text, start.cast("int") + 1, (end - start).cast("int"))

    def opening(e: Column) -> Column:
        return F.when(
            e["entity"] == "PRODUCT", F.lit(rules.SPAN_OPEN.format(color=rules.PRODUCT_COLOR))
        ).otherwise(F.lit(rules.SPAN_OPEN.format(color=rules.OTHER_COLOR)))

    # ends has one item more than ordered: the pair without an entity is the tail.
    parts = F.zip_with(
        ordered, ends,
        lambda e, last_end: F.when(e.isNull(), cut(last_end, F.length(text))).otherwise(
            F.concat(
                cut(last_end, e["start"]), opening(e), cut(e["start"], e["end"]),
                F.lit(rules.SPAN_CLOSE),
            )
        ),
    )
    return F.array_join(parts, "")


def is_low_confidence(entities: Column | str, threshold: float = rules.LOW_CONFIDENCE) -> Column:
    """No entity at all, or every score below the threshold."""
    return ~F.coalesce(F.exists(_col(entities), lambda e: e["score"] >= threshold), F.lit(False))
