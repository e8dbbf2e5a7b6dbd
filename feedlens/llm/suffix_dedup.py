"""Repeated passages across documents by suffix arrays (operator 7).

A byte goes if a 50-byte string that covers it also starts in a document with a smaller id.

Equal strings are brought together by anchors. Of the ``GRAM``-byte grams in a window of 50
bytes the one with the smallest hash is the window's anchor, so equal windows have equal
anchors at equal places. An anchor with all bytes that its windows may cover is a context.

1. Each task sends its anchors (gram hash, context hash, document, place, hashes of its sides) in
   blocks to parts by gram hash. A context that a text has at several places, as in
   a run of one byte, is sent once; what is found for it holds for all its places. Of the
   documents that a task holds with one context it sends the first and the last: those between
   are settled by the first. Grams that a sample shows in very many places are dealt by gram
   and context, so that no part gets all of them.
2. A part finds for each anchor whether a smaller document has the whole context (then all
   its windows go) or only the gram, beside other contexts. Windows of two contexts are equal
   only if the gram and ``HALF`` bytes on its left or on its right are, so an anchor that shares
   neither with another document is done; the others are edges.
3. What is found goes in blocks to buckets of documents, where whole contexts that touch
   become one span.
4. The contexts of edges go to shards by gram hash. A shard's suffix array, made by induced
   sorting, puts equal windows side by side; neighbours that agree in 50 bytes are a group.
5. Grams that start too many different contexts are resolved window by window instead, as
   rows that are combined before they move; the result is the same.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import arrow_map, bounded, free_name, kept_in_worker, longs, slices, utf8_bytes
from feedlens.llm.induced_sort import common_prefix_at_least, suffix_array
from feedlens.session import stored

LENGTH, GRAM = 50, 24
#: Bytes beside an anchor that its windows can cover on either side, and places in a window.
SIDE, PLACES = LENGTH - GRAM, LENGTH - GRAM + 1
#: Of two equal windows at one gram one side at least has so many bytes.
HALF = SIDE // 2
#: Windows that are looked at together; at most 2^24.
WINDOWS = 1 << 16
#: Anchors that a task holds before it sends them: a block for each part, so the more it holds
#: the fewer blocks there are.
HELD = 1 << 19
#: Bytes of blocks that a task hands on at a time.
SENT_BYTES = 2 << 20
#: Bytes of text per part and per bucket, and edges per shard: what one task gets does not grow.
PART_BYTES, BUCKET_BYTES, SHARD_EDGES = 8 << 20, 16 << 20, 1 << 14
#: One of so many documents is drawn to find grams that are dealt by context as well, and how
#: many anchors of the sample a gram must have: 75,000 of the whole are about an eighth of a part.
SAMPLE_SHARE, SAMPLE_HOT = 1000, 75
#: From so many contexts to compare on a gram is resolved window by window.
HOT_CONTEXTS = 4096
#: Copies of one id are told apart in the upper bits of a place; its lowest bit says that
#: the text has the context at more places than this, its first.
COPY_BITS = 40

_U = np.uint64
_ODD = 0x9E3779B97F4A7C15
#: A number for each byte, and for the nothing outside a text.
_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 257, dtype=np.uint64) * _U(2) + _U(1)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    both = np.array([[_ODD], [pow(_ODD, -1, 1 << 64)]], np.uint64).repeat(n, 1)
    both[:, 0] = 1
    return tuple(np.multiply.accumulate(both, axis=1))


class Sums:
    """Hashes of stretches of some numbers, all from one running sum of number x power."""

    def __init__(self, values: np.ndarray):
        self.up, down = _powers(WINDOWS + 4 * LENGTH)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * down[:len(values)], out=self.sums[1:])

    def each(self, size: int) -> np.ndarray:
        """Of the ``size`` numbers from each place on."""
        found = self.sums[size:] - self.sums[:-size]
        return mixed(found * self.up[size - 1:size - 1 + len(found)])

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        return mixed((self.sums[starts + size] - self.sums[starts]) * self.up[starts + size - 1])


def mixed(hashes: np.ndarray) -> np.ndarray:
    out = (hashes ^ (hashes >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return out ^ (out >> _U(32))


def anchors_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, place, gram hash, context hash, sides) of the anchors of all 50-byte windows of
    each text, in order. ``sides`` has 16 bits for the gram with ``HALF`` bytes before it and 16
    for the gram with ``HALF`` bytes behind it.

    The texts stand in one row with gaps, of which some windows are looked at together: short
    texts cost no steps of their own, and a long one needs little more than its anchors.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + SIDE) - sizes
    gap = b"\0" * SIDE
    row = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    inside, opens = np.zeros(len(row), bool), np.zeros(len(row), bool)
    for a, n in zip(begins.tolist(), sizes.tolist()):
        inside[a:a + n] = True
        opens[a:a + max(0, n - LENGTH + 1)] = True
    found = [[np.zeros(0, t)] for t in (np.int64, np.uint64, np.uint64, np.uint64)]
    last, end = -1, len(row) - SIDE - LENGTH + 1
    for at in range(SIDE, end, WINDOWS):
        n = min(WINDOWS, end - at)
        if not opens[at:at + n].any():
            continue
        # With the bytes beside the anchors; nothing stands outside a text.
        near = slice(at - SIDE, at + n + LENGTH - 1 + SIDE)
        values = _BYTES[row[near]]
        values[~inside[near]] = _BYTES[256]
        sums = Sums(values)
        hashes = sums.each(GRAM)[SIDE:SIDE + n + PLACES - 1]
        # The smallest hash of a window, and of equal ones the first, by place in the low bits.
        least = (hashes & _U(0xFFFFFFFFFF000000)) | np.arange(len(hashes), dtype=np.uint64)
        reach = 1
        while reach * 2 <= PLACES:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        least = np.minimum(least[:n], least[PLACES - reach:PLACES - reach + n])
        own = (least[opens[at:at + n]] & _U(0xFFFFFF)).astype(np.int64)
        own = own[np.r_[True, own[1:] != own[:-1]]]
        if own[0] + at == last:
            own = own[1:]
        if not len(own):
            continue
        before, behind = sums.at(own + SIDE - HALF, GRAM + HALF), sums.at(own + SIDE, GRAM + HALF)
        sides = before >> _U(48) << _U(16) | behind >> _U(48)
        for kept, new in zip(found, (own + at, hashes[own], sums.at(own, GRAM + 2 * SIDE), sides)):
            kept.append(new)
        last = int(own[-1]) + at
    places, grams, contexts, sides = (np.concatenate(c) for c in found)
    text = np.searchsorted(begins, places, side="right") - 1
    return text, places - begins[text], grams, contexts, sides


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, gram hashes, context hashes) of the anchors of all 50-byte windows of a text."""
    return anchors_of([text])[1:4]


# ---- Blocks of anchors ---------------------------------------------------------------

def pack_blocks(columns: list[np.ndarray], edges: np.ndarray, order: np.ndarray | None = None) -> list[bytes]:
    """A block of the rows (in ``order``) from each edge to the next: of the columns of 64-bit
    numbers as many bytes as what is above the smallest number needs."""
    columns = [np.ascontiguousarray(c).view(np.uint64) for c in columns]
    lows = [int(c.min()) for c in columns]
    widths = [(int(c.max()) - low).bit_length() + 7 >> 3 for c, low in zip(columns, lows)]
    rows = np.empty((edges[-1], sum(widths)), np.uint8)
    at = 0
    for c, low, width in zip(columns, lows, widths):
        above = (c if order is None else c[order]) - _U(low)
        rows[:, at:at + width] = above.view(np.uint8).reshape(-1, 8)[:, :width]
        at += width
    head = struct.pack(f"<B{len(columns)}B{len(columns)}Q", len(columns), *widths, *lows)
    return [struct.pack("<Q", b - a) + head + rows[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def pack_block(columns: list[np.ndarray]) -> bytes:
    return pack_blocks(columns, np.array([0, len(columns[0])]))[0]


def unpack_block(block: bytes, n_columns: int | None = None) -> list[np.ndarray]:
    """The first ``n_columns`` columns of a block, or all."""
    n, many = struct.unpack_from("<QB", block)
    widths = struct.unpack_from(f"<{many}B", block, 9)
    lows = struct.unpack_from(f"<{many}Q", block, 9 + many)
    rows = np.frombuffer(block, np.uint8, offset=9 + 9 * many).reshape(n, sum(widths))
    out, at = [], 0
    for low, width in list(zip(lows, widths))[:n_columns]:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = rows[:, at:at + width]
        out.append(wide.reshape(-1).view(np.uint64) + _U(low))
        at += width
    return out


def by_number(numbers: np.ndarray, most: int) -> np.ndarray:
    """Order of numbers from 0 to ``most``; equal ones stay as they are."""
    return np.argsort(numbers.astype(np.uint16 if most < 1 << 16 else np.int64), kind="stable")


def of_number(numbers: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin, and the end."""
    return np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True])


def first_places(texts: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first anchor of each different context of a text, and how often it is there."""
    order = np.argsort(contexts, kind="stable")
    texts, contexts = texts[order], contexts[order]
    starts = np.flatnonzero(np.r_[True, (contexts[1:] != contexts[:-1]) | (texts[1:] != texts[:-1])][:len(order)])
    return order[starts], np.diff(np.r_[starts, len(order)])


def in_order(grams: np.ndarray, contexts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by gram, and of equal grams by context and document; whether a gram is there again."""
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    again = np.r_[same, False] | np.r_[False, same]
    few = order[again]
    order[again] = few[np.lexsort((docs[few].view(np.int64), contexts[few], grams[few]))]
    return order, again


def hot_grams(docs: DataFrame) -> np.ndarray:
    """Hashes of the grams that are anchors very often, from a sample of ``docs``, in order.

    The result of the search is the same whichever they are.
    """
    draw = F.pmod(F.xxhash64("doc", "copy", F.lit(29)), F.lit(SAMPLE_SHARE))

    def start():
        kept_in_worker("suffix-anchors")

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            text, _, grams, contexts, _ = anchors_of(utf8_bytes(batch.column(0)))
            return [longs(grams[first_places(text, contexts)[0]].view(np.int64))]
        return step

    drawn = arrow_map(docs.where(draw == 0).select("text"), "gram bigint", start)
    often = drawn.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SAMPLE_HOT)
    return np.sort(np.array([r["gram"] for r in often.select("gram").collect()], np.int64).view(np.uint64))


def sent_blocks(docs: DataFrame, parts: int, hot: np.ndarray = np.zeros(0, np.uint64)) -> DataFrame:
    """(part, block) of the anchors of all texts of ``docs`` (id, copy, text).

    Part 2p holds all that is sent of its grams, 2p + 1 all that is sent of some contexts of
    ``hot`` grams. Blocks of negative parts hold (document, place) of settled anchors.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_in_worker("suffix-anchors")
        held: list[tuple] = []
        n_held = n_sent = 0
        task = TaskContext.get().partitionId()

        def send() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held)]
            held.clear()
            order, _ = in_order(*columns[:3])
            grams, contexts, docs = (c[order] for c in columns[:3])
            new = np.r_[True, (grams[1:] != grams[:-1]) | (contexts[1:] != contexts[:-1])]
            goes = (docs == docs[np.flatnonzero(new)][np.cumsum(new) - 1]) | np.r_[new[1:], True]
            keys, blocks = [], []
            if not goes.all():
                keys.append(-1 - (task << 32) - n_sent)
                blocks.append(pack_block([c[order[~goes]] for c in columns[2:4]]))
                order, grams, contexts = order[goes], grams[goes], contexts[goes]
            apart = np.isin(grams, hot)
            # Hashes of anchors are small ones, so their upper bits alone would not deal evenly.
            dealt = np.where(apart, grams ^ contexts, grams) * _U(_ODD)
            part = ((dealt >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64) * 2 + apart
            del grams, contexts, docs, new, goes, dealt
            columns[0] &= _U(GRAM_BITS)
            dealt = by_number(part, 2 * parts)
            part, order = part[dealt], order[dealt]
            edges = of_number(part)
            blocks += pack_blocks(columns, edges, order)
            keys += part[edges[:-1]].tolist()
            del columns, part, order, dealt
            size = np.cumsum([len(b) for b in blocks]) // SENT_BYTES
            for a, b in zip((ends := of_number(size).tolist())[:-1], ends[1:]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a:b], pa.int64()), pa.array(blocks[a:b], pa.binary())], names=["part", "block"])

        for batch in batches:
            for some in slices(batch):
                text, places, grams, contexts, sides = anchors_of(utf8_bytes(some.column(2)))
                if len(text):
                    first, n = first_places(text, contexts)
                    ids, copies = (some.column(i).to_numpy().astype(np.int64)[text[first]] for i in (0, 1))
                    coded = (copies << COPY_BITS) + (places[first] << 1) + (n > 1)
                    held.append((grams[first], contexts[first], ids.view(np.uint64), coded.view(np.uint64), sides[first]))
                    n_held += len(first)
                if n_held >= HELD:
                    yield from send()
                    n_held, n_sent = 0, n_sent + 1
        if held:
            yield from send()

    return bounded(docs).mapInArrow(run, "part bigint, block binary")


COVERED, EDGE, HOT = 0, 1, 2
#: Bits of a gram's hash that are sent; a part has some 600,000 anchors. Different grams that agree in them are
#: only compared in vain.
GRAM_BITS = (1 << 24) - 1


def _meets(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether another document has the key, too."""
    order = np.argsort(keys)
    starts = of_number(keys[order])
    out = np.zeros(len(keys), bool)
    if len(keys):
        own = docs[order]
        many = np.minimum.reduceat(own, starts[:-1]) < np.maximum.reduceat(own, starts[:-1])
        out[order] = np.repeat(many, np.diff(starts))
    return out


def met(table: pa.Table) -> pa.Table:
    """(doc, place, kind, gram) of the anchors of one part that matter."""
    kept_in_worker("suffix-parts")
    part = table.column("part")[0].as_py()
    if part < 0:
        docs, places = (np.concatenate(c).view(np.int64) for c in zip(
            *(unpack_block(b, 2) for b in table.column("block").to_pylist())))
        return pa.table({"doc": docs, "place": places, "kind": np.full(len(docs), COVERED, np.int32),
                         "gram": np.zeros(len(docs), np.int64)})
    columns = [unpack_block(b) for b in table.column("block").to_pylist()]
    columns = [np.concatenate(c) for c in zip(*columns)]
    order, again = in_order(*columns[:3])
    if not part % 2:  # a gram that is there once is done
        order = order[again]
    grams, contexts, docs, places, sides = (c[order] for c in columns)
    del columns, order, again
    docs, places = docs.view(np.int64), places.view(np.int64)
    new_gram = np.r_[True, grams[1:] != grams[:-1]][:len(grams)]
    new_context = new_gram | np.r_[True, contexts[1:] != contexts[:-1]][:len(grams)]
    covered = docs > docs[np.flatnonzero(new_context)][np.cumsum(new_context) - 1]
    keep, kind = np.ones(len(docs), bool), np.where(covered, COVERED, HOT)
    if not part % 2:  # else other contexts of its grams are in other parts
        rest = np.flatnonzero(~covered)
        of_gram = np.cumsum(new_gram)[rest] - 1
        keys, ids = of_gram << 16, docs[rest]
        sides = sides[rest].view(np.int64)
        open_ = _meets(keys | sides >> 16, ids) | _meets(keys | sides & 0xFFFF, ids)
        keep[rest] = open_
        n_open = np.bincount(of_gram, weights=open_, minlength=1)[of_gram]
        kind[rest] = np.where(n_open > HOT_CONTEXTS, HOT, EDGE)
    return pa.table({"doc": docs[keep], "place": places[keep], "kind": kind[keep].astype(np.int32),
                     "gram": grams[keep].view(np.int64)})


def in_buckets(marks: pa.Table, buckets: int) -> pa.Table:
    """(bucket, block) of the marks of one part: whole contexts (doc, place) and open ones (doc,
    place, kind, gram) apart, by document."""
    columns = [marks.column(i).to_numpy().astype(np.int64) for i in range(4)]
    keys, blocks = [np.zeros(0, np.int64)], []
    whole = columns[2] == COVERED
    for some, n in ((whole, 2), (~whole, 4)):
        if some.any():
            own = [c[some] for c in columns[:n]]
            bucket = ((own[0].view(np.uint64) * _U(_ODD) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
            order = by_number(bucket, buckets)
            bucket = bucket[order]
            edges = of_number(bucket)
            keys.append(bucket[edges[:-1]])
            blocks += pack_blocks(own, edges, order)
    return pa.table({"bucket": np.concatenate(keys), "block": pa.array(blocks, pa.binary())})


def _packed(docs: np.ndarray, copies: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(doc, copy, bytes of its rows) of rows that stand in the order of doc and copy."""
    starts = np.flatnonzero(np.r_[True, (docs[1:] != docs[:-1]) | (copies[1:] != copies[:-1])][:len(docs)])
    ends = np.r_[starts, len(docs)] * rows.shape[1] * 8
    data = pa.py_buffer(np.ascontiguousarray(rows, np.int64).tobytes())
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), data])
    return docs[starts], copies[starts], packed.cast(pa.binary())


def by_document(table: pa.Table) -> pa.Table:
    """(doc, copy, spans, edges) of the documents of a bucket: ``spans`` has the (start, end,
    again) of whole contexts, ``edges`` the (place, again, kind, gram) of open ones, as bytes."""
    kept_in_worker("suffix-documents")
    found: dict[int, list] = {2: [], 4: []}
    for block in table.column("block").to_pylist():
        columns = unpack_block(block)
        found[len(columns)].append(columns)
    out = []
    for n, blocks in found.items():
        if not blocks:
            continue
        columns = [np.concatenate(c).view(np.int64) for c in zip(*blocks)]
        order = np.lexsort((columns[1], columns[0]))
        docs, coded, *rest = (c[order] for c in columns)
        copies, place = coded >> COPY_BITS, (coded & (1 << COPY_BITS) - 1) >> 1
        again = np.where(coded & 1, place, -1)
        if n == 4:
            docs, copies, packed = _packed(docs, copies, np.stack([place, again, *rest], 1))
            out.append(pa.table([docs, copies.astype(np.int32), pa.nulls(len(docs), pa.binary()), packed], MARKS))
            continue
        # Contexts that touch become one span; those that stand at other places, too, stay.
        apart = again >= 0
        start, end = np.maximum(place - SIDE, 0), place + LENGTH
        a, b = np.flatnonzero(~apart), np.flatnonzero(apart)
        new = np.r_[True, (docs[a][1:] != docs[a][:-1]) | (copies[a][1:] != copies[a][:-1]) | (start[a][1:] > end[a][:-1])][:len(a)]
        first, last = a[new], a[np.r_[new[1:], True][:len(a)]]
        spans = np.concatenate([np.stack([start[first], end[last], again[first]], 1), np.stack([start[b], end[b], again[b]], 1)])
        of = np.r_[first, b]
        order = np.lexsort((copies[of], docs[of]))
        docs, copies, packed = _packed(docs[of][order], copies[of][order], spans[order])
        out.append(pa.table([docs, copies.astype(np.int32), packed, pa.nulls(len(docs), pa.binary())], MARKS))
    return pa.concat_tables(out)


MARKS = ["doc", "copy", "spans", "edges"]


# ---- Edges ----------------------------------------------------------------------------

def edge_contexts(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """(doc, copy, at, again, kind, gram, bytes): the bytes around edges, which start at ``at``."""
    def start():
        kept_in_worker("suffix-edges")

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            own = [np.frombuffer(x, np.int64).reshape(-1, 4) for x in batch.column(3).to_pylist()]
            place, again, kind, gram = np.concatenate([np.zeros((0, 4), np.int64), *own]).T
            many = [len(x) for x in own]
            around = [t[max(0, p - SIDE):p + LENGTH] for t, x in zip(utf8_bytes(batch.column(2)), own)
                      for p in x[:, 0].tolist()]
            doc, copy = (np.repeat(batch.column(i).to_numpy(), many) for i in (0, 1))
            return [longs(doc), pa.array(copy, pa.int32()), longs(np.maximum(place - SIDE, 0)), longs(again),
                    pa.array(kind, pa.int32()), longs(gram), pa.array(around, pa.binary())]
        return step

    rows = docs.join(edges, ["doc", "copy"]).select("doc", "copy", "text", "edges")
    return arrow_map(rows, "doc bigint, copy int, at bigint, again bigint, kind int, gram bigint, bytes binary", start)


def shard_repeats(table: pa.Table) -> pa.Table:
    """``SPANS`` of the windows of one shard's contexts that also start in a smaller
    document's context."""
    kept_in_worker("suffix-shards")
    texts = table.column("bytes").to_pylist()
    sizes = np.array([len(t) for t in texts])
    # Bytes count from 1 on; a zero ends each context.
    signs = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8).astype(np.int64) + 1
    ends = np.cumsum(sizes + 1) - 1
    signs[ends] = 0
    begins = ends - sizes
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    array = suffix_array(signs, 258, LENGTH)
    array = array[ends[owner[array]] - array >= LENGTH]  # starts of whole windows
    same = np.zeros(len(array), bool)
    same[1:] = common_prefix_at_least(signs, array[:-1], array[1:], LENGTH)
    docs = table.column("doc").to_numpy()
    groups = np.flatnonzero(~same)
    least = np.minimum.reduceat(docs[owner[array]], groups) if len(groups) else np.zeros(0, np.int64)
    gone = np.sort(array[docs[owner[array]] > least[np.cumsum(~same) - 1]])
    new = np.r_[True, (np.diff(gone) > 1) | (owner[gone[1:]] != owner[gone[:-1]])] if len(gone) else np.zeros(0, bool)
    first = gone[new]
    last = gone[np.r_[new[1:], True]] if len(gone) else gone
    of, at = owner[first], table.column("at").to_numpy()
    return pa.table({
        "doc": docs[of], "copy": table.column("copy").to_numpy()[of],
        "start": at[of] + first - begins[of], "end": at[of] + last - begins[of] + LENGTH,
        "again": table.column("again").to_numpy()[of]})


#: ``again`` is the anchor's place if the text has its context at other places too, else -1.
SPANS = "doc bigint, copy int, start bigint, end bigint, again bigint"


def hot_repeats(contexts: DataFrame) -> DataFrame:
    """The same for contexts of hot grams, by rows of windows."""
    windows = contexts.select("doc", "copy", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.octet_length("bytes") - LENGTH + 1),
        lambda i: F.substring("bytes", i, F.lit(LENGTH)))).alias("i", "window"), "at", "again")
    first = windows.groupBy("window").agg(F.min("doc").alias("first"))
    start = F.col("at") + F.col("i")
    return (windows.join(first, "window").where("first < doc")
            .select("doc", "copy", start.alias("start"), (start + LENGTH).alias("end"), "again"))


def _with_copies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, copy, text): texts of one id are numbered; equal rows have the same number."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    marked = rows.withColumn("mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    many = (rows.where(F.col("doc").isNotNull()).groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1").select("doc"))
    if many.isEmpty():
        return rows.select("doc", F.lit(0).alias("copy"), "text")
    copies = (marked.join(many, "doc", "left_semi").select("doc", "mark").distinct()
              .groupBy("doc").agg(F.array_sort(F.collect_list("mark")).alias("marks"))
              .select("doc", F.posexplode("marks").alias("copy", "mark")))
    return marked.join(copies, ["doc", "mark"], "left").select("doc", F.coalesce("copy", F.lit(0)).alias("copy"), "text")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, copy, spans, others): byte spans to remove from ``docs`` (doc, copy, text), as bytes
    of (start, end, again) and as an array. Spans may overlap, and hold for all places of their
    context (see ``everywhere``). Runs while it is called."""
    named = docs.where(F.col("doc").isNotNull() & (F.octet_length("text") >= LENGTH))
    size = named.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    parts, buckets, found = 1 + size // PART_BYTES, 1 + size // BUCKET_BYTES, met
    met_blocks = sent_blocks(named, parts, hot_grams(named)).groupBy("part").applyInArrow(
        lambda table: in_buckets(found(table), buckets), "bucket bigint, block binary")
    marks = stored(met_blocks.groupBy("bucket").applyInArrow(
        by_document, "doc bigint, copy int, spans binary, edges binary"), "suffix-marks")
    whole = marks.where("spans is not null").select("doc", "copy", "spans")
    contexts = stored(edge_contexts(named, marks.where("edges is not null").select("doc", "copy", "edges")), "suffix-edges")
    edges = contexts.where(F.col("kind") == EDGE)
    shards = 1 + edges.count() // SHARD_EDGES
    resolved = (edges.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
                .groupBy("shard").applyInArrow(shard_repeats, SPANS))
    hot = hot_repeats(contexts.where(F.col("kind") == HOT))
    others = resolved.unionByName(hot).groupBy("doc", "copy").agg(
        F.collect_list(F.struct("start", "end", "again")).alias("others"))
    return stored(whole.join(others, ["doc", "copy"], "full"), "suffix-spans")


def everywhere(spans: np.ndarray, text: bytes) -> np.ndarray:
    """Rows (start, end) of the spans (start, end, again) at all places of their contexts."""
    many = spans[:, 2] >= 0
    if not many.any():
        return spans[:, :2]
    places, _, contexts = anchors(text)
    order = np.argsort(contexts, kind="stable")
    ordered, out = contexts[order], [spans[~many, :2]]
    for place in np.unique(spans[many, 2]):
        own = contexts[np.searchsorted(places, place)]
        a, b = np.searchsorted(ordered, own), np.searchsorted(ordered, own, side="right")
        shifts = places[order[a:b]] - place
        near = np.array(merged(spans[spans[:, 2] == place, :2], len(text)))
        out.append((near[:, None, :] + shifts[None, :, None]).reshape(-1, 2))
    return np.concatenate(out)


def merged(spans, size: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover, within the text."""
    if not len(spans):
        return []
    pairs = np.asarray(spans, np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(np.minimum(pairs[:, 1], size))
    new = np.r_[True, pairs[1:, 0] > reach[:-1]]
    last = np.r_[new[1:], True]
    return list(zip(pairs[new, 0].tolist(), reach[last].tolist()))


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in runs:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def _runs(whole: pa.Array, others: pa.Array, texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """Runs of bytes to remove from each text; ``whole`` and ``others`` as of :func:`repeats`."""
    many = pc.fill_null(pc.list_value_length(others), 0).to_numpy()
    rows = np.stack([c.to_numpy(zero_copy_only=False) for c in others.flatten().flatten()], 1)
    out, at = [], 0
    for packed, n, text in zip(whole.to_pylist(), many.tolist(), texts):
        if packed is None and not n:
            out.append([])
            continue
        spans = np.frombuffer(packed or b"", np.int64).reshape(-1, 3)
        if n:
            spans = np.concatenate([spans, rows[at:at + n]])
        at += n
        out.append(merged(everywhere(spans, text), len(text)))
    return out


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``.

    Null texts count as empty; texts under 50 bytes lose nothing and remove nothing. Rows of
    one id do not remove from each other. A null id has no order: such a text loses nothing
    and removes nothing. An empty table gives no rows; other columns are ignored. Runs its
    searches while it is called.
    """
    def start():
        kept_in_worker("suffix-removal")

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = utf8_bytes(batch.column(1))
            runs = _runs(batch.column(2), batch.column(3), texts)
            digests = [hashlib.sha256(kept_bytes(t, r)).hexdigest() for t, r in zip(texts, runs)]
            return [batch.column(0).cast(pa.int64()), longs([len(t) for t in texts]),
                    longs([sum(b - a for a, b in r) for r in runs]), longs([len(r) for r in runs]),
                    pa.array(digests, pa.string())]
        return step

    own = _with_copies(docs, id_col, text_col)
    rows = own.join(repeats(own), ["doc", "copy"], "left").select("doc", "text", "spans", "others")
    return arrow_map(rows, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", start)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text_col``; all columns stay. Bytes of
    a character that is cut in two go with the passage. Null texts stay null."""
    own = _with_copies(docs, id_col, text_col)
    lost = own.join(repeats(own), ["doc", "copy"]).select(
        "doc", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"), "spans", "others").dropDuplicates(["doc", "mark"])
    id_name, mark_name, spans_name, others_name = (free_name(docs, n) for n in ("id_", "mark_", "spans_", "others_"))
    rows = docs.withColumn(id_name, F.col(id_col).cast("bigint")).withColumn(
        mark_name, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    rows = rows.join(lost.toDF(id_name, mark_name, spans_name, others_name), [id_name, mark_name], "left").select(
        *[f"`{c}`" for c in docs.columns], spans_name, others_name)
    place = docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def start():
        kept_in_worker("suffix-removal")

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = utf8_bytes(batch.column(place))
            null = batch.column(place).is_null().to_pylist()
            runs = _runs(*batch.columns[-2:], texts)
            clean = [None if n else kept_bytes(t, r).decode("utf-8", errors="ignore")
                     for t, r, n in zip(texts, runs, null)]
            columns = list(batch.columns[:-2])
            columns[place] = pa.array(clean, pa.string())
            return columns
        return step

    return arrow_map(rows, schema, start)


REMOVAL_SQL = r"""
with given as (select doc_id, encode(coalesce(text, '')) as bytes, row_number() over () as r from documents),
texts as (select r, doc_id, bytes, hex(bytes) as h, octet_length(bytes) as n from given),
blocks as (
  select r, doc_id, n, base, substr(h, 2 * base + 1, 298) as part
  from (select *, unnest(range(0, n - 49, 100)) as base from texts where n >= 50 and doc_id is not null)),
windows as materialized (
  select r, doc_id, base + o as i, substr(part, 2 * o + 1, 100) as w
  from (select *, unnest(range(0, least(100, n - 49 - base))) as o from blocks)),
firsts as (select w, min(doc_id) as first from windows group by w having min(doc_id) < max(doc_id)),
gone as (
  select r, i, case when i <= lag(i) over (partition by r order by i) + 50 then 0 else 1 end as opens
  from windows join firsts using (w) where first < doc_id),
numbered as (select r, i, sum(opens) over (partition by r order by i) as run from gone),
runs as (select r, run, min(i) as a, max(i) + 50 as b from numbered group by r, run),
pieces as (
  select r, a, b, substr(h, 2 * coalesce(lag(b) over (partition by r order by a), 0) + 1,
                         2 * (a - coalesce(lag(b) over (partition by r order by a), 0))) as piece
  from runs join texts using (r)),
heads as (
  select r, sum(b - a) as n_removed, count(*) as n_spans, string_agg(piece, '' order by a) as head, max(b) as last
  from pieces group by r)
select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from texts left join heads using (r)"""
