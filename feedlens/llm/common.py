"""Helpers that the operators share: reading, typed Arrow maps over texts, temporary columns."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Bytes of an Arrow batch on its way to a worker: both sides hold some at once.
BATCH_BYTES = 8 << 20
#: Rows and bytes of text that a step works on at a time.
SLICE_ROWS, SLICE_BYTES = 512, 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the same on every machine."""
    return public_tokenizers.path(name)


def arrow_map(
    df: DataFrame,
    schema: str,
    start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
) -> DataFrame:
    """``mapInArrow`` by a function that turns a small batch into the columns of ``schema``.

    ``start`` runs once per task and returns that function, so that what it loads or
    remembers lives as long as the task. A batch is one of :func:`slices`.
    """
    types = StructType.fromDDL(schema)
    names = types.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(step(part), names=names)

    return bounded(df).mapInArrow(run, types)


def bounded(df: DataFrame) -> DataFrame:
    """``df`` for an Arrow operator: batches of the session are held to ``BATCH_BYTES``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return df


def slices(batch: pa.RecordBatch, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``rows`` (``SLICE_ROWS``) rows and about ``SLICE_BYTES`` of
    strings; a longer text is a part of its own."""
    rows = rows or SLICE_ROWS
    size = np.ones(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size) // SLICE_BYTES
    at = 0
    while at < batch.num_rows:
        end = min(at + rows, max(at + 1, int(np.searchsorted(group, group[at], side="right"))))
        yield batch.slice(at, end - at)
        at = end


def utf8_bytes(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8, null as empty."""
    return pc.fill_null(texts, "").cast(pa.binary()).to_pylist()


#: Bytes that an entry takes besides its part and its result, and the longest part that is
#: remembered.
ENTRY_BYTES, LONG_PART = 200, 256


class Recent(dict):
    """Results by part of a text, computed on first use and remembered for a while.

    Of the parts seen lately those of the last ``most`` to twice ``most`` bytes are kept, which
    bounds the memory: at ``most`` new bytes the generation before the last is forgotten. Long
    parts are not remembered. What was forgotten is computed again, so results do not depend
    on it.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.held, self.old = most, 0, {}

    def __missing__(self, part):
        value = self.old.get(part)
        if value is None:
            value = self.compute(part)
        if self.held >= self.most:
            self.rotate()
        self.keep(part, value)
        return value

    def keep(self, part, value) -> None:
        size = len(part) * (1 if isinstance(part, bytes) else 4)
        if size <= LONG_PART:
            self.held += ENTRY_BYTES + size + (len(value) if isinstance(value, bytes) else 0)
            self[part] = value

    def rotate(self) -> None:
        self.old, self.held = dict(self), 0
        self.clear()

    def compute(self, part):
        raise NotImplementedError(type(self).__name__)


@contextmanager
def uncollected() -> Iterator[None]:
    """No garbage collections inside: for work that makes no cycles, beside memories of a hundred
    thousand entries that each collection would walk through."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Memo(Recent):
    """Remembers what ``compute`` gives for a list of parts, one result each (bytes); it gets all
    unknown parts of some texts at once."""

    def __init__(self, compute: Callable[[list], list], most: int):
        super().__init__(most)
        self.compute = compute

    def of(self, texts: list[list]) -> list[list]:
        """The results of each text's parts."""
        if self.held >= self.most:
            self.rotate()
        get = self.get
        found = [list(map(get, parts)) for parts in texts]
        again = [i for i, results in enumerate(found) if None in results]
        lacking = {p for i in again for p, r in zip(texts[i], found[i]) if r is None}
        if lacking:
            old = self.old.get
            values = {p: r for p in lacking if (r := old(p)) is not None}
            new = [p for p in lacking if p not in values] if values else list(lacking)
            values.update(zip(new, self.compute(new)))
            for i in again:
                found[i] = [values[p] if r is None else r for p, r in zip(texts[i], found[i])]
            self.keep_all(values)
        return found

    def keep_all(self, values: dict) -> None:
        wide = 1 if isinstance(next(iter(values)), bytes) else 4
        if max(map(len, values)) * wide > LONG_PART:
            values = {p: r for p, r in values.items() if len(p) * wide <= LONG_PART}
        self.held += len(values) * ENTRY_BYTES + wide * sum(map(len, values)) + sum(map(len, values.values()))
        self.update(values)


_WHITE = re.compile(rb"[ \t-\r]")


@dataclass
class Parts:
    """Parts of some texts between ASCII white space (an empty one beside white space at an end of
    a text): the different ones, the number of each in text order, and how many parts stand
    before each text's end."""

    names: list[bytes]
    code: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Parts:
        split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        coded = split.flatten().cast(pa.large_binary()).dictionary_encode()
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)
        return cls(coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), ends)


def parts_of(texts: pa.Array) -> Iterator[Parts]:
    """Parts of a slice of texts; those of a long text (a slice of its own) in stretches."""
    if len(texts) == 1 and texts[0].is_valid and len(texts[0].as_buffer()) > 2 * SLICE_BYTES:
        whole, at = texts[0].as_buffer().to_pybytes(), 0
        while at < len(whole):
            cut = _WHITE.search(whole, at + SLICE_BYTES)
            end = cut.end() if cut else len(whole)
            yield Parts.of(pa.array([whole[at:end].decode()]))
            at = end
    else:
        yield Parts.of(texts)


_kept: dict = {}


def kept_in_worker(name, make: Callable[[], object] = lambda: None):
    """What ``make`` gives, kept by this worker process from task to task until an operator
    keeps something else: the memories of two operators never add up. An operator that keeps
    nothing calls it with its name alone, so that it begins with an empty worker."""
    if name not in _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # give freed memory back, where the C library can
            ctypes.CDLL(None).malloc_trim(0)
        _kept[name] = make()
    return _kept[name]


def longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
