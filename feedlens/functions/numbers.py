"""Numbers in text and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.functions.text import WS_LIST, _col

# Rejects nan, inf, 1_000 and type suffixes such as 12d.
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def clean_price(c: Column | str) -> Column:
    """Text with commas and ``ETB`` -> number; NULL when it is not a number."""
    bare = F.replace(F.replace(_col(c), F.lit(","), F.lit("")), F.lit("ETB"), F.lit(""))
    bare = F.btrim(bare, F.lit(WS_LIST))
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def round_to(c: Column | str, digits: int = 2) -> Column:
    """Decimal half-up rounding; a value too large for the decimal has no fraction to round."""
    c = _col(c)
    exact = F.round(c.try_cast("decimal(30,10)"), digits).cast("double")
    return F.coalesce(exact, c.cast("double"))
