"""Message table -> vendor scorecard file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedlens.operators.scorecard import scorecard_input, vendor_scorecard
from feedlens.schemas import SCORECARD_HEADER
from feedlens.sources.tables import write_table


def scorecard_of(messages: DataFrame) -> DataFrame:
    """Scorecard of a message table; missing ``views`` and ``entities`` are filled in."""
    return vendor_scorecard(scorecard_input(messages))


def run_scorecard(messages: DataFrame, out: str, fmt: str = "csv") -> None:
    write_table(scorecard_of(messages), out, fmt, SCORECARD_HEADER)
