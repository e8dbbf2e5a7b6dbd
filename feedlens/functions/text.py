"""Text cleaning, normalisation and tokenising."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens import rules

# Unicode whitespace, spelled out because the regex class \s is ASCII only.
WS_CHARS = (
    r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The same characters, listed (for functions that take no regex).
WS_LIST = "".join(
    chr(n)
    for lo, hi in ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
                   (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
    for n in range(lo, hi + 1)
)
WS = f"[{WS_CHARS}]"
NOT_WS = f"[^{WS_CHARS}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once, however often ``body`` uses it. Needed where a lambda over an
    array looks into another one: the other would be built again for every item."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_ws(c: Column | str) -> Column:
    """Trim and collapse every run of Unicode whitespace to one space."""
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def canonical_username(c: Column | str) -> Column:
    """``@name`` and ``name`` denote the same channel."""
    return F.btrim(_col(c), F.lit("@"))


def remove_emoji(c: Column | str, ranges: list[tuple[int, int]] | None = None) -> Column:
    ranges = rules.EMOJI_RANGES if ranges is None else ranges
    chars = "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in ranges)
    return F.regexp_replace(c, f"[{chars}]+", "")


def _class_of(signs) -> str:
    return "[" + "".join(rf"\x{{{ord(s):X}}}" for s in dict.fromkeys(signs)) + "]"


def _translate(c: Column, mapping: dict[str, str]) -> Column:
    # Looking for one of the signs is far cheaper than translating each sign.
    if not mapping:
        return c
    return F.when(c.rlike(_class_of(mapping)), F.translate(c, "".join(mapping), "".join(mapping.values()))).otherwise(c)


def _replace_all(c: Column, pairs: list[tuple[str, str]]) -> Column:
    # Literal replacement works on the UTF-8 bytes, with no regex and no decoding.
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, c)


def replace_longest(c: Column | str, table: dict[str, str]) -> Column:
    """Every occurrence of a key -> its value, in one pass from the left, longest key first."""
    c = _col(c)
    table = {k: v for k, v in table.items() if k}
    if not table:
        return c
    first = _class_of(k[0] for k in table)
    keys = "|".join("".join(rf"\x{{{ord(s):X}}}" for s in k) for k in sorted(table, key=len, reverse=True))
    # Runs of signs that begin no key, keys, and signs that could have begun one.
    parts = F.regexp_extract_all(c, F.lit(f"(?s)[^{first[1:]}+|{keys}|."), F.lit(0))
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    replaced = F.array_join(F.transform(parts, lambda p: F.coalesce(lookup[p], p)), "")
    return F.when(c.rlike(keys), replaced).otherwise(c)


def norm_labialized(c: Column | str, pairs: list[tuple[str, str]] | None = None) -> Column:
    """Letter sequences that spell one labialised syllable -> the single letter."""
    pairs = rules.labialized_pairs() if pairs is None else pairs
    return _translate(replace_longest(c, dict(pairs)), rules.LABIAL_U_LETTERS)


def norm_short_forms(c: Column | str, table: dict[str, str] | None = None) -> Column:
    """Whole tokens found in the table -> their full words; whitespace is kept."""
    table = rules.SHORT_FORMS if table is None else table
    c = _col(c)
    if not table:
        return c
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    parts = F.regexp_extract_all(c, F.lit(f"{NOT_WS}+|{WS}+"), F.lit(0))
    expanded = F.array_join(F.transform(parts, lambda p: F.coalesce(lookup[p], p)), "")
    # The byte search is far cheaper than splitting, and few messages hold a short form.
    return F.when(contains_any(c, list(table)), expanded).otherwise(c)


def norm_punct(
    c: Column | str,
    sequences: list[tuple[str, str]] | None = None,
    letters: dict[str, str] | None = None,
) -> Column:
    sequences = rules.PUNCT_SEQUENCES if sequences is None else sequences
    letters = rules.PUNCT_LETTERS if letters is None else letters
    return _translate(_replace_all(_col(c), sequences), letters)


def norm_chars(c: Column | str, mapping: dict[str, str] | None = None) -> Column:
    """Homophone letters -> one canonical letter."""
    return _translate(_col(c), rules.homophone_map() if mapping is None else mapping)


def word_tokenize(c: Column | str, script: str = "ethiopic") -> Column:
    """Runs of letters of one script; digits, punctuation and other letters are dropped."""
    return F.regexp_extract_all(_col(c), F.lit(f"[{rules.SCRIPTS[script]}]+"), F.lit(0))


def preprocess_message(c: Column | str, script: str = "ethiopic") -> Column:
    """Emoji, labialised letters, short forms, punctuation, homophones, then word tokens
    joined by one space. The order matters."""
    text = text_or_empty(c)
    if script == "ethiopic":
        # Words of ASCII letters and digits occur in no rule and are dropped in the end: one
        # letter in their place separates as well, and leaves the steps a shorter text. The
        # repeated group is possessive: a greedy one takes stack for each word of a run.
        text = F.regexp_replace(text, "[A-Za-z0-9]++(?: [A-Za-z0-9]++)*+", "x")
    for step in (remove_emoji, norm_labialized, norm_short_forms, norm_punct, norm_chars):
        text = step(text)
    return F.array_join(word_tokenize(text, script), " ")


def ws_tokens(c: Column | str) -> Column:
    """Whitespace-separated tokens; NULL gives no tokens.

    One regex pass and a split at a plain space: extracting runs of the negated class is
    several times slower, and a split at a regex compiles it again for every row.
    """
    return F.array_remove(F.split(F.regexp_replace(text_or_empty(c), WS + "+", " "), " "), "")


def ws_gaps(c: Column | str) -> Column:
    """The whitespace before each of ``ws_tokens``, and after the last one: one item more than
    there are tokens, so that gaps and tokens in turn are the text."""
    return F.split(F.regexp_replace(text_or_empty(c), NOT_WS + "+", "x"), "x", -1)


def first_line(c: Column | str) -> Column:
    return F.get(F.split(_col(c), "\n", 2), F.lit(0))


def rest_of_text(c: Column | str) -> Column:
    """Everything after the first newline; empty without a newline."""
    c = _col(c)
    return F.when(c.isNotNull(), F.coalesce(F.get(F.split(c, "\n", 2), F.lit(1)), F.lit("")))


def text_lines(c: Column | str) -> Column:
    """Lines of a text, empty ones included."""
    return F.split(_col(c), "\n", -1)


def contains_any(c: Column | str, words: list[str]) -> Column:
    """True when the text contains one of the literal words (case-sensitive). For short lists;
    ``operators.gazetteer`` takes long ones as a table."""
    c = _col(c)
    words = list(dict.fromkeys(words))
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words]) if words else F.lit(False)
