"""Byte-level byte-pair encoding and decoding of whole texts (operator 10).

The tokenizers library encodes pieces over the byte-to-character mapping; the vocabulary is
a rank file. Decoding reverses the byte table, so that characters split over several ids
come back whole.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models, pre_tokenizers

from feedlens.llm.byte_table import byte_characters
from feedlens.llm.common import Memo, arrow_map, kept_in_worker, longs, vocabulary

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of parts that a worker remembers at least, and half of what it does at most.
REMEMBERED = 96 << 20

DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        to_char = byte_characters()
        names = {token: "".join(to_char[b] for b in token) for token in ranks}
        # A pair merges if its bytes together are a token; the token's rank orders the merges.
        merges = []
        for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
            cuts = [(token[:i], token[i:]) for i in range(1, len(token))]
            cuts = [c for c in cuts if c[0] in ranks and c[1] in ranks]
            cuts.sort(key=lambda c: (ranks[c[0]], ranks[c[1]]))
            merges += [(names[a], names[b]) for a, b in cuts]
        self.library = Tokenizer(models.BPE(vocab={names[t]: r for t, r in ranks.items()}, merges=merges))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces = regex.compile(PATTERN).findall
        from_char = {c: b for b, c in enumerate(to_char)}
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for name, rank in self.library.get_vocab().items():
            self.token_bytes[rank] = bytes(from_char[c] for c in name)
        # Only to check the library's answer: among different cuts of one token the rank file
        # prefers the leftmost place, the merge list its own order.
        self.check = tiktoken.Encoding("check", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known = Memo(self._piece_ids, REMEMBERED)

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        out = []
        for piece, found in zip(pieces, self.library.encode_batch_fast(pieces, add_special_tokens=False)):
            ids = found.ids
            if len(ids) > 1 and (exact := self.check._encode_single_piece(piece)) != ids:
                ids = exact
            out.append(array("I", ids).tobytes())
        return out

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each whole text, each match of the pattern separately."""
        found = self.known.of([self.pieces(t) for t in texts])
        return [np.frombuffer(b"".join(ids), np.uint32) for ids in found]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte place in the text where each id starts, and the end of the last."""
        sizes = np.fromiter((len(self.token_bytes[i]) for i in ids.tolist()), np.int64, len(ids))
        return np.concatenate([[0], np.cumsum(sizes)])

    def decode_bytes(self, ids) -> bytes:
        table = self.token_bytes
        return b"".join([table[i] for i in np.asarray(ids).tolist()])

    def decode(self, ids) -> str:
        """Text of any run of ids; the halves of a character that the run cuts become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


def byte_bpe(path: str) -> ByteBpe:
    return kept_in_worker(("byte pairs", path), lambda: ByteBpe(path))


def _texts(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = vocabulary(VOCABULARY),
) -> DataFrame:
    """(doc_id, ids, starts): the ids of each whole text and the code point in which each
    id's first byte lies.

    Null and empty texts have no ids; repeated rows stay; an empty table gives none; only
    the two named columns are read. Map only.
    """
    def start():
        bpe = byte_bpe(path)

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            ids, starts = [], []
            texts = _texts(batch.column(1))
            for text, own in zip(texts, bpe.encode_all(texts)):
                raw = np.frombuffer(text.encode(), np.uint8)
                # Character of each byte: continuation bytes belong to the one before.
                char = np.cumsum((raw & 0xC0) != 0x80) - 1
                ids.append(own.astype(np.int32))
                starts.append(char[bpe.offsets(own)[:-1]].astype(np.int32))
            return [batch.column(0).cast(pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                    pa.array(starts, pa.list_(pa.int32()))]
        return step

    return arrow_map(docs.select(id_col, text_col), "doc_id bigint, ids array<int>, starts array<int>", start)


def decode(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = vocabulary(VOCABULARY),
) -> DataFrame:
    """(doc_id, text) from arrays of ids. Null arrays give null; a character cut by the ends
    of the array becomes U+FFFD."""
    def start():
        bpe = byte_bpe(path)

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = [None if ids is None else bpe.decode(ids) for ids in batch.column(1).to_pylist()]
            return [batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())]
        return step

    return arrow_map(encoded.select(id_col, ids_col), "doc_id bigint, text string", start)


def encode_digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = vocabulary(VOCABULARY),
) -> DataFrame:
    """Per document the number of ids, their digest, and the digest of the bytes that decoding
    these ids gives. Edge cases as for :func:`encode`."""
    def start():
        bpe = byte_bpe(path)

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            n, ids_digest, text_digest = [], [], []
            for ids in bpe.encode_all(_texts(batch.column(1))):
                n.append(len(ids))
                ids_digest.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_digest.append(hashlib.sha256(bpe.decode_bytes(ids)).hexdigest())
            return [batch.column(0).cast(pa.int64()), longs(n), pa.array(ids_digest, pa.string()),
                    pa.array(text_digest, pa.string())]
        return step

    return arrow_map(docs.select(id_col, text_col), DIGESTS, start)
