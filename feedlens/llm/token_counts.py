"""Token counts by byte-pair merging with a heap over a linked list (operator 3).

The vocabulary file gives the merge ranks, the normaliser and the splitting rule. A text is
cut at ASCII white space; as no word of the vocabulary holds white space, the count of a
text is the sum over its cut parts, and a part is counted once per worker and remembered.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from feedlens.llm.byte_table import byte_characters
from feedlens.llm.common import Recent, arrow_map, kept_in_worker, longs, parts_of, uncollected, vocabulary
from feedlens.llm.word_rule import WordRule

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
#: Bytes of parts that a worker remembers at least, and half of what it does at most.
REMEMBERED = 96 << 20

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def merged_length(symbols: list[int], ranks: dict[tuple[int, int], int], merged: list[int]) -> int:
    """Number of symbols left after all merges.

    ``ranks`` maps a pair of neighbours to its rank, ``merged`` a rank to the new symbol. The
    heap holds (rank, place) as one number; ``pair`` has the rank of the pair that now starts
    in each place, so an entry that no longer holds is known by it. Equal ranks merge from
    the left. Each merge takes one symbol away: the result is the number of initial symbols
    minus the merges.
    """
    n = len(symbols)
    rank_of = ranks.get
    pair = [rank_of(p, -1) for p in zip(symbols, symbols[1:])]
    heap = [rank * n + i for i, rank in enumerate(pair) if rank >= 0]
    if not heap:
        return n
    heapq.heapify(heap)
    pair.append(-1)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        rank, i = divmod(heapq.heappop(heap), n)
        if pair[i] != rank:
            continue
        merges += 1
        symbol = symbols[i] = merged[rank]
        gone = after[i]
        pair[gone] = -1
        after[i] = k = after[gone]
        if k < n:
            before[k] = i
            pair[i] = new = rank_of((symbol, symbols[k]), -1)
            if new >= 0:
                heapq.heappush(heap, new * n + i)
        else:
            pair[i] = -1
        h = before[i]
        if h >= 0:
            pair[h] = new = rank_of((symbols[h], symbol), -1)
            if new >= 0:
                heapq.heappush(heap, new * n + h)
    return n - merges


class WordCounts(Recent):
    """Tokens of each word that the splitting rule gives, counted on first use."""

    def __init__(self, model: dict):
        super().__init__(REMEMBERED)
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        chars = byte_characters()
        #: Initial symbol of each byte inside a word, and at its end.
        self.inner, self.last = ([vocab[c + tail] for c in chars] for tail in ("", end))
        self.ranks, self.merged = {}, []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left], vocab[right]] = rank
            self.merged.append(vocab[left + right])

    def compute(self, word: str) -> int:
        raw = word.encode()
        symbols = [self.inner[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        return merged_length(symbols, self.ranks, self.merged)


class PartCounts(Recent):
    """Tokens of each part between ASCII white space (UTF-8), counted on first use."""

    def __init__(self, path: str):
        super().__init__(REMEMBERED)
        self.rule = WordRule(path)
        self.counts = WordCounts(self.rule.settings["model"])

    def compute(self, part: bytes) -> int:
        text, counts = part.decode(), self.counts
        if "<" not in text:
            return sum(map(counts.__getitem__, self.rule.words(text)))
        # Odd places of the split are special strings, one token each.
        cut = self.rule.special.split(text)
        return len(cut) // 2 + sum(counts[w] for plain in cut[::2] if plain for w in self.rule.words(plain))


def part_counts(path: str) -> PartCounts:
    return kept_in_worker(("token counts", path), lambda: PartCounts(path))


def count_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    path: str = vocabulary(VOCABULARY), limit: int = TOKEN_LIMIT,
) -> DataFrame:
    """One row per row of ``docs``: id, UTF-8 bytes, tokens, and whether they exceed ``limit``.

    Null and empty texts have no bytes and no tokens; repeated rows stay; an empty table
    gives none; only the two named columns are read, so others may have any name. Map only.
    """
    def start():
        counts = part_counts(path).__getitem__

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            n = np.zeros(batch.num_rows, np.int64)
            for parts in parts_of(batch.column(1)):
                with uncollected():
                    found = list(map(counts, parts.names))
                tokens = np.array(found, np.int64)[parts.code]
                n += np.diff(np.concatenate([[0], np.cumsum(tokens)])[np.concatenate([[0], parts.ends])])
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            return [batch.column(0).cast(pa.int64()), n_bytes, longs(n), pa.array(n > limit)]
        return step

    return arrow_map(docs.select(id_col, text_col), SCHEMA, start)
