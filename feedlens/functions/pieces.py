"""Sub-word pieces and label alignment inside one sentence, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens import rules
from feedlens.functions.text import _col, bind

SPECIAL_OPEN, SPECIAL_CLOSE = "<s>", "</s>"


def _piece(text: Column, word: Column) -> Column:
    return F.struct(text.alias("piece"), word.cast("int").alias("word"))


def word_pieces(tokens: Column | str, width: int = 4, special: bool = False) -> Column:
    """Fixed-width chunks of every word as ``array<struct<piece,word>>``.

    ``special`` adds an opening and a closing piece with a NULL word index. Any other
    array of this type can take the place of the result.
    """
    def chunks(w: Column, i: Column) -> Column:
        last = F.greatest(F.ceil(F.length(w) / F.lit(width)).cast("int") - 1, F.lit(0))
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda j: _piece(F.substring(w, j * width + 1, F.lit(width)), i),
        )

    pieces = F.flatten(F.transform(_col(tokens), chunks))
    if not special:
        return pieces
    no_word = F.lit(None).cast("int")
    return F.concat(
        F.array(_piece(F.lit(SPECIAL_OPEN), no_word)),
        pieces,
        F.array(_piece(F.lit(SPECIAL_CLOSE), no_word)),
    )


def _previous(items: Column) -> Column:
    """The array moved right by one: item i holds what was item i-1."""
    return F.slice(F.concat(F.array(F.lit(None)), items), F.lit(1), F.size(items))


def align_labels(pieces: Column | str, labels: Column | str, ignored: int = rules.IGNORED_LABEL) -> Column:
    """Label id per piece: the first piece of a word keeps the word's label, later pieces
    and special pieces get ``ignored``."""
    def align(words: Column, ids: Column) -> Column:
        return F.zip_with(
            words,
            _previous(words),
            lambda w, prev: F.when(w.isNull() | w.eqNullSafe(prev), F.lit(ignored))
            .otherwise(F.get(ids, w)),
        )

    words = F.transform(_col(pieces), lambda p: p["word"])
    return bind(_col(labels), lambda ids: bind(words, lambda w: align(w, ids)))


def truncate_pieces(pieces: Column | str, length: int) -> Column:
    """At most ``length`` pieces; a closing special piece stays the last one. What is cut is
    lost; :func:`piece_windows` keeps every piece."""
    pieces = _col(pieces)
    last = F.element_at(pieces, -1)
    cut = F.when(
        last["word"].isNull(),
        F.concat(F.slice(pieces, 1, length - 1), F.slice(pieces, -1, 1)),
    ).otherwise(F.slice(pieces, 1, length))
    return F.when(F.size(pieces) > length, cut).otherwise(pieces)


def truncate_labels(label_ids: Column | str, length: int) -> Column:
    return F.slice(_col(label_ids), 1, length)


def piece_windows(pieces: Column | str, length: int) -> Column:
    """The pieces in runs of at most ``length``, each piece in exactly one run."""
    return bind(_col(pieces), lambda p: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(p) - 1, F.lit(0)), F.lit(length)),
        lambda start: F.slice(p, start + 1, F.lit(length)),
    ))


def pad_labels(
    label_ids: Column | str, length: int, ignored: int = rules.IGNORED_LABEL
) -> Column:
    """Fill up to ``length`` with ignored labels."""
    label_ids = _col(label_ids)
    missing = F.greatest(F.lit(length) - F.size(label_ids), F.lit(0))
    return F.concat(label_ids, F.array_repeat(F.lit(ignored), missing))


def mask_pairs(predicted: Column | str, labels: Column | str, ignored: int = rules.IGNORED_LABEL) -> Column:
    """``array<struct<predicted,label>>`` without the ignored positions."""
    pairs = F.zip_with(
        _col(predicted), _col(labels),
        lambda p, t: F.struct(p.alias("predicted"), t.alias("label")),
    )
    return F.filter(pairs, lambda x: x["label"] != ignored)


def argmax_label(scores: Column | str, labels: list[str]) -> Column:
    """Label with the highest score; the first one wins ties."""
    scores = _col(scores)
    best = F.array_position(scores, F.array_max(scores)).cast("int")
    return F.get(F.array(*map(F.lit, labels)), best - 1)
