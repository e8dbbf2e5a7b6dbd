"""Vector bin packing of token sequences by the dot-product heuristic (operator 6).

A piece asks for three resources of a sequence at once: tokens, segments and loss-bearing
tokens. The open sequence takes the piece whose demand has the largest weighted dot product
with what is left of it. Documents may be cut: what no whole piece fills, a cut one does.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlens.llm.common import Memo, bounded, kept_in_worker, parts_of, slices, uncollected, vocabulary
from feedlens.llm.word_rule import WordRule

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MAX_TOKENS = 4096
MAX_SEGMENTS = 256
#: Bytes of words, and of parts between white space, that a worker remembers at least, and half
#: of what it does at most.
REMEMBERED_WORDS, REMEMBERED_PARTS = 96 << 20, 56 << 20
#: Rows whose parts are looked up together.
SLICE_ROWS = 4096
#: Tokens that a task holds before it packs, and what it leaves open for the next round.
BUFFER_TOKENS, LEFT_TOKENS = 1 << 20, 1 << 17

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, loss_tokens bigint")


class PartIds:
    """Ids of each part between ASCII white space (UTF-8 -> uint32 bytes), by the library.

    The library encodes each distinct word once; parts are put together from their words.
    """

    def __init__(self, path: str):
        self.rule = WordRule(path)
        model = self.rule.settings["model"]
        #: Each word ends with an id of this kind and has no other, so words can be encoded in
        #: one text and told apart.
        self.ends = np.zeros(self.rule.library.get_vocab_size(), bool)
        for token, i in model["vocab"].items():
            self.ends[i] = token.endswith(model["end_of_word_suffix"])
        self.words = Memo(self._word_ids, REMEMBERED_WORDS)
        self.parts = Memo(self._part_ids, REMEMBERED_PARTS)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.rule.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _word_ids(self, words: list[str]) -> list[bytes]:
        # A word of plain signs stays as it is if it is normalised again, so the library may
        # get many at once; of any other the model itself gets what it has to encode.
        plain = [w for w in words if not self.rule.is_far(w)]
        together = self.rule.library.encode_batch_fast([" ".join(plain)], add_special_tokens=False) if plain else ()
        ids = np.array(together[0].ids, np.uint32) if plain else np.zeros(0, np.uint32)
        last = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()]
        raw = ids.tobytes()
        found = dict(zip(plain, (raw[a:b] for a, b in zip(last, last[1:])))) if len(last) == len(plain) + 1 else {}
        tokenize = self.rule.library.model.tokenize
        return [found[w] if w in found else np.array([t.id for t in tokenize(self.rule.symbols(w))], np.uint32).tobytes()
                for w in words]

    def _part_ids(self, parts: list[bytes]) -> list[bytes]:
        texts = [p.decode() for p in parts]
        special = {t: self._encode(t).tobytes() for t in texts if "<" in t and self.rule.special.search(t)}
        words = [() if t in special else self.rule.words(t) for t in texts]
        found = iter(self.words.of([[w for some in words for w in some]])[0])
        return [special[t] if t in special else b"".join(islice(found, len(some))) for t, some in zip(texts, words)]

    def of(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part."""
        # Most are one word of ASCII letters, which its small letters stand for.
        simple = [p.isalpha() for p in parts]
        alone = iter(self.words.of([[p.decode().lower() for p, s in zip(parts, simple) if s]])[0])
        rest = iter(self.parts.of([[p for p, s in zip(parts, simple) if not s]])[0])
        return [next(alone if s else rest) for s in simple]


def part_ids(path: str) -> PartIds:
    return kept_in_worker(("part ids", path), lambda: PartIds(path))


def document_ids(texts: pa.Array, path: str, end_id: int | None) -> list[np.ndarray]:
    """Ids of each text as the library gives them for the whole text, then ``end_id``.

    No token of this vocabulary spans white space, so a text's ids are those of its parts.
    """
    known, end = part_ids(path), [] if end_id is None else [end_id]
    found = []
    for parts in parts_of(texts):
        with uncollected():
            results = known.of(parts.names)
        size = np.fromiter(map(len, results), np.int64, len(results)) // 4
        ids, first = np.frombuffer(b"".join(results), np.uint32), np.cumsum(size) - size
        taken = size[parts.code]
        upto = np.concatenate([[0], np.cumsum(taken)])
        ids = ids[np.repeat(first[parts.code] - upto[:-1], taken) + np.arange(upto[-1])]
        found.append(np.split(ids, upto[parts.ends])[:-1])
    if len(found) != 1:  # the stretches of one text, or of none
        found = [[np.concatenate([x for some in found for x in some])]] if found else [[]]
    return [np.append(x, np.array(end, np.uint32)) for x in found[0]]


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = MAX_TOKENS
    segments: int = MAX_SEGMENTS
    loss: int = MAX_TOKENS


class Packer:
    """Packs (key, start, length, loss) pieces; ``flush`` closes the rest.

    A piece without own loss flags bears loss on each token but its first, which has no
    token before it to be predicted from. Placed pieces come out as (key, start, length,
    loss, sequence, offset). Pieces of equal demand are alike to the heuristic, so it chooses
    among the different demands: of short pieces there are few, however many pieces there are.
    """

    def __init__(self, limits: Limits):
        self.limits, self.sequence, self.tokens = limits, 0, 0
        #: Demands (tokens, loss) of open pieces and the pieces of each, the next one last.
        self.number: dict[tuple[int, int], int] = {}
        self.pieces: list[list[tuple]] = []
        self.demand = np.zeros((2, 64))
        self.alive = np.zeros(64, bool)

    @property
    def open(self) -> list[tuple]:
        return [p for some in self.pieces for p in some]

    @staticmethod
    def loss(piece) -> int:
        _, start, length, flags = piece
        return length - 1 if flags is None else int(flags[start:start + length].sum())

    def add(self, key: int, length: int, loss_flags: np.ndarray | None = None) -> None:
        self._put((key, 0, length, loss_flags))

    def _put(self, piece: tuple) -> None:
        demand = piece[2], self.loss(piece)
        i = self.number.setdefault(demand, len(self.pieces))
        if i == len(self.pieces):
            self.pieces.append([])
            if i == len(self.alive):
                self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)], axis=1)
                self.alive = np.concatenate([self.alive, np.zeros_like(self.alive)])
            self.demand[:, i] = demand
        self.pieces[i].append(piece)
        self.alive[i] = True
        self.tokens += piece[2]

    def _take(self, i: int) -> tuple:
        piece = self.pieces[i].pop()
        self.alive[i] = bool(self.pieces[i])
        self.tokens -= piece[2]
        return piece

    def _forget(self) -> None:
        """Lets demands without open pieces go, and deals the others in a fixed order."""
        left = sorted((d, self.pieces[i][::-1]) for d, i in self.number.items() if self.pieces[i])
        self.number, self.pieces, self.tokens = {}, [], 0
        self.alive[:] = False
        for _, pieces in left:
            for piece in reversed(pieces):
                self._put(piece)

    def pack(self, until: int) -> Iterator[tuple]:
        """Fills whole sequences while more than ``until`` tokens are open."""
        self._forget()
        while self.tokens > max(until, self.limits.tokens - 1):
            yield from self._fill(self.limits.tokens)

    def flush(self) -> Iterator[tuple]:
        """Packs what fills whole sequences, then the rest into sequences whose lengths are
        falling powers of two, which need no padding."""
        yield from self.pack(0)
        while self.tokens:
            yield from self._fill(1 << (self.tokens.bit_length() - 1))

    def _fill(self, size: int) -> Iterator[tuple]:
        """One sequence of ``size`` tokens. If segments or loss run out before, it ends at the
        largest power of two it reached, and what stands behind is open again."""
        limit = self.limits
        tokens_left, segments_left, loss_left = size, limit.segments, limit.loss
        placed = []
        # Both sides of the dot product as shares of the limits; the share of a segment is the
        # same for all pieces.
        per_token, per_loss = 1 / limit.tokens ** 2, 1 / max(limit.loss, 1) ** 2
        while tokens_left > 0 and segments_left > 0:
            n = len(self.pieces)
            alive, tokens, loss = self.alive[:n], self.demand[0, :n], self.demand[1, :n]
            score = tokens * (tokens_left * per_token)
            score += loss * (loss_left * per_loss)
            score[~alive | (tokens > tokens_left) | (loss > loss_left)] = -1
            at = int(score.argmax()) if n else 0
            whole = n and score[at] >= 0
            if not whole or segments_left == 1:
                # Nothing fits whole: the largest open piece is cut. The last segment has to
                # fill the sequence, if any piece can.
                largest = int(np.where(alive, tokens, -1).argmax()) if n else 0
                if not n or not alive[largest]:
                    break
                if not whole or tokens[largest] > tokens_left:
                    at, whole = largest, False
            if whole:
                piece = self._take(at)
            else:
                take = self._cut(self.pieces[at][-1], tokens_left, loss_left)
                if not take:
                    break
                key, start, length, flags = self._take(at)
                piece = key, start, take, flags
                if take < length:
                    self._put((key, start + take, length - take, flags))
            placed.append(piece)
            tokens_left -= piece[2]
            segments_left -= 1
            loss_left -= self.loss(piece)
        reached = size - tokens_left
        if not reached:
            raise ValueError("a single token exceeds the limits of a sequence")
        end = size if reached == size else 1 << (reached.bit_length() - 1)
        offset = 0
        for key, start, length, flags in placed:
            take = min(length, end - offset)
            if take:
                yield key, start, take, self.loss((key, start, take, flags)), self.sequence, offset
            if take < length:
                self._put((key, start + take, length - take, flags))
            offset += take
        self.sequence += 1

    @staticmethod
    def _cut(piece: tuple, tokens_left: int, loss_left: int) -> int:
        """Tokens of ``piece`` that what is left of a sequence can take."""
        _, start, length, flags = piece
        take = min(tokens_left, length)
        if flags is None:
            return min(take, loss_left + 1)
        borne = np.cumsum(flags[start:start + take])
        return int(np.searchsorted(borne, loss_left, side="right"))


def loss_flags(text: str, spans: list[dict], path: str, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, flags) of a text: a token bears loss if its first sign lies in one of the spans
    (code points, end excluded), the end id if the text's last sign does."""
    found = part_ids(path).rule.library.encode(text, add_special_tokens=False)
    inside = np.zeros(len(text) + 1, bool)
    for span in spans:
        inside[span["start"]:min(span["end"], len(text))] = True
    flags = inside[[start for start, _ in found.offsets]] if found.ids else np.zeros(0, bool)
    ids = np.array(found.ids, np.uint32)
    if end_id is not None:
        ids, flags = np.append(ids, np.uint32(end_id)), np.append(flags, bool(text) and inside[len(text) - 1])
    return ids, flags.astype(np.int64)


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = vocabulary(VOCABULARY),
    end_id: int | None = END_ID, limits: Limits = Limits(), loss_col: str | None = None,
) -> DataFrame:
    """One row per placed piece of each row of ``docs``; see ``SCHEMA``.

    ``loss_col`` names spans of code points (``array<struct<start,end>>``) whose tokens bear
    loss, as chat formatting gives them; without it, or where it is null, all tokens of a piece
    but its first do. Each task packs the documents of its own split, in the order of the file,
    holding at most ``BUFFER_TOKENS`` tokens and one document; there is no shuffle, and a task
    that runs again packs alike. Sequence numbers carry the task's number in their upper bits.
    Null and empty texts are documents of the end id alone (of no piece without one);
    repeated rows are packed each; an empty table gives no rows; other columns are ignored.
    """
    types = StructType.fromDDL(SCHEMA)

    def ids_and_flags(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        spans = part.column(2).to_pylist() if loss_col else [None] * part.num_rows
        if all(s is None for s in spans):
            return zip(document_ids(part.column(1), path, end_id), spans)
        texts = [t or "" for t in part.column(1).to_pylist()]
        whole = document_ids(part.column(1), path, end_id)
        return [(ids, None) if s is None else loss_flags(t, s, path, end_id) for t, s, ids in zip(texts, spans, whole)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        packer = Packer(limits)
        held: dict[int, tuple[int | None, np.ndarray]] = {}
        number = 0

        def rows(placed):
            out = []
            for key, start, length, loss, sequence, offset in placed:
                doc_id, ids = held[key]
                crc = zlib.crc32(ids[start:start + length].data)
                out.append((doc_id, start, length, crc, len(ids), base + sequence, offset, loss))
            open_keys = {p[0] for p in packer.open}
            for key in [k for k in held if k not in open_keys]:
                del held[key]
            columns = list(zip(*out)) if out else [()] * len(types)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=types.fieldNames())

        for batch in batches:
            for part in slices(batch, SLICE_ROWS):
                for doc_id, (own, flags) in zip(part.column(0).to_pylist(), ids_and_flags(part)):
                    if len(own):
                        held[number] = doc_id, own
                        packer.add(number, len(own), flags)
                        number += 1
                if packer.tokens > BUFFER_TOKENS:
                    yield rows(packer.pack(LEFT_TOKENS))
        yield rows(packer.flush())

    columns = [F.col(id_col), F.col(text_col)]
    if loss_col:
        columns.append(F.col(loss_col).cast("array<struct<start:int,end:int>>"))
    return bounded(docs.select(*columns)).mapInArrow(run, types)
