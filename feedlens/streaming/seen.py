"""Which message ids a channel has had, kept as intervals."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Ids per state row.
BUCKET_IDS = 1 << 16
STATE = "starts array<bigint>, ends array<bigint>"


def add(starts: list[int], ends: list[int], number: int) -> bool:
    """Put ``number`` into sorted intervals (ends included), joining neighbours; false if it is
    there already."""
    at = bisect_right(starts, number) - 1
    if at >= 0 and number <= ends[at]:
        return False
    left = at >= 0 and ends[at] == number - 1
    right = at + 1 < len(starts) and starts[at + 1] == number + 1
    if left and right:
        ends[at] = ends.pop(at + 1)
        starts.pop(at + 1)
    elif left:
        ends[at] = number
    elif right:
        starts[at + 1] = number
    else:
        starts.insert(at + 1, number)
        ends.insert(at + 1, number)
    return True


class FirstRows(StatefulProcessor):
    """Hands on the first row of every id. The state of a group (a channel's bucket of ids) is
    its intervals: one for ids without gaps, however many rows there were."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        starts, ends = map(list, self.seen.get()) if self.seen.exists() else ([], [])
        before = len(starts), sum(ends) - sum(starts)
        for row in rows:
            # All rows without an id are one message, as for any grouping.
            if add(starts, ends, 0 if row["id"] is None else row["id"]):
                yield Row(**{c: row[c] for c in row.__fields__ if c != "_bucket"})
        if (len(starts), sum(ends) - sum(starts)) != before:
            self.seen.update((starts, ends))

    def close(self) -> None:
        pass
