"""Rule-based token labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens import rules
from feedlens.functions.text import (
    _col, contains_any, first_line, normalize_ws, rest_of_text, ws_tokens,
)


_OTHER_DIGITS = "\u0660"  # no sign from 0x80 up to it is a decimal digit


def is_phone(token: Column | str) -> Column:
    return _col(token).rlike(r"(?U)^\d{10}$")


def is_price(token: Column | str, marks: list[str] | None = None) -> Column:
    token = _col(token)
    marks = rules.PRICE_MARKS if marks is None else marks
    return token.rlike(r"(?U)^\d+(\.\d{1,2})?$") | contains_any(token, marks)


def is_location(token: Column | str, places: list[str] | None = None) -> Column:
    return contains_any(token, rules.LOCATIONS if places is None else places)


def rest_label(
    token: Column | str, marks: list[str] | None = None, places: list[str] | None = None
) -> Column:
    """Label of a token after the first line: phone, then price, then place, else O.

    Most tokens hold no sign that a digit or a listed word begins with: one look for such a sign
    spares them the search for each word.
    """
    token = _col(token)
    words = dict.fromkeys([*(rules.PRICE_MARKS if marks is None else marks),
                           *(rules.LOCATIONS if places is None else places)])
    named = (
        F.when(is_phone(token), F.lit("I-PHONE"))
        .when(is_price(token, marks), F.lit("I-PRICE"))
        .when(is_location(token, places), F.lit("I-LOC"))
        .otherwise(F.lit("O"))
    )
    return F.when(token.rlike(_any_of(list(words))), named).otherwise(F.lit("O"))


def _any_of(words: list[str]) -> str:
    """Regex of one sign that every token has which begins with a digit or holds one of the
    words: an ASCII digit, the first sign of a word, or any sign from the first other digit on."""
    if "" in words:
        return ""
    low = "".join(dict.fromkeys(w[0] for w in words if w[0] < _OTHER_DIGITS))
    return rf"[0-9{''.join(rf'\x{{{ord(s):X}}}' for s in low)}\x{{{ord(_OTHER_DIGITS):X}}}-\x{{10FFFF}}]"


def first_line_label(position: Column) -> Column:
    return F.when(position == 0, F.lit("B-PRODUCT")).otherwise(F.lit("I-PRODUCT"))


def _labeled(token: Column, label: Column) -> Column:
    return F.struct(token.alias("token"), label.alias("label"))


def label_first_line(c: Column | str) -> Column:
    """Tokens of the first line as ``array<struct<token,label>>``."""
    return F.transform(
        ws_tokens(first_line(c)), lambda t, i: _labeled(t, first_line_label(i))
    )


def label_message(
    c: Column | str,
    marks: list[str] | None = None,
    places: list[str] | None = None,
    collapse_first: bool = False,
) -> Column:
    """Ordered ``array<struct<token,label>>`` of a whole message; empty for blank text.

    Labels after the first line do not depend on the line, so the rest is tokenised in
    one piece. ``collapse_first`` turns the message into a single line beforehand.
    """
    c = normalize_ws(c) if collapse_first else _col(c)
    rest = F.transform(
        ws_tokens(rest_of_text(c)), lambda t: _labeled(t, rest_label(t, marks, places))
    )
    return F.concat(label_first_line(c), rest)


def label_name(c: Column | str, names: dict[str, str] | None = None) -> Column:
    """Model output name -> tag; unknown names give NULL."""
    names = rules.LABEL_NAMES if names is None else names
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[_col(c)]
