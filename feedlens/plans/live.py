"""Landing folder -> raw and clean message tables that keep growing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from feedlens.operators.cleaning import clean_messages
from feedlens.streaming.ingest import append_to, backfill_then_follow, ingest


def run_live(
    landing: DataFrame,
    media_folder: str,
    out: str,
    checkpoint: str,
    channels: list[str] | DataFrame | None = None,
    once: bool = False,
    backfill: DataFrame | None = None,
) -> list[StreamingQuery]:
    """Start the flows that append each new message of the listed channels to ``out/raw`` and
    its cleaned form to ``out/clean``. With ``backfill``, the stream of what an earlier
    collection landed, a message that both feeds have, in either spelling of its channel, lands
    once. A restart goes on where the checkpoint ends."""
    raw = ingest(landing, media_folder, channels)
    if backfill is not None:
        raw = backfill_then_follow(ingest(backfill, media_folder, channels), raw)
    return [
        append_to(raw, f"{out}/raw", f"{checkpoint}/raw", once=once),
        append_to(clean_messages(raw), f"{out}/clean", f"{checkpoint}/clean", once=once),
    ]
