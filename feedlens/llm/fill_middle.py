"""Fill-in-middle transformation by displacement scatter (operator 11).

A text is cut into prefix, middle and suffix, and written as prefix, suffix, middle (psm) or
suffix, prefix, middle (spm), each behind its sentinel. The texts of a batch are one array of
bytes: the cuts give a difference array, its running sum tells every byte how far it moves,
and one scatter writes all outputs. The way back reads the sentinels, builds the same kind of
array over the restored bytes, and gathers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import arrow_map, longs

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
WIDTH = 3
#: Of 100 texts so many are transformed, and of 100 transformed ones so many are spm.
TRANSFORMED, SPM = 90, 20
#: Bytes whose displacements are held at a time, and bytes per count of code points.
STRETCH, COUNTED = 1 << 20, 1 << 12

FORMS = ["plain", "psm", "spm"]
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null as empty), and where each text begins (one more at the end)."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0]:at[-1]], at - at[0]


def _strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
    return whole.cast(pa.large_string()).cast(pa.string())


def sentinels(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a sentinel begins inside a text, and the number of that text."""
    if len(data) < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    names = data[1:-1]
    found = (data[:-2] == PREFIX[0]) & (data[2:] == PREFIX[2])
    marks = np.flatnonzero(found & ((names == PREFIX[1]) | (names == SUFFIX[1]) | (names == MIDDLE[1])))
    own = np.searchsorted(at, marks, side="right") - 1
    inside = marks + WIDTH <= at[own + 1]
    return marks[inside], own[inside]


class CodePoints:
    """Turns numbers of code points into places of bytes, from counts per ``COUNTED`` bytes."""

    def __init__(self, data: np.ndarray):
        self.first = (data & 0xC0) != 0x80
        blocks = np.add.reduceat(self.first, np.arange(0, len(data), COUNTED), dtype=np.int64) if len(data) else []
        self.before = np.concatenate([[0], np.cumsum(blocks, dtype=np.int64)])

    def until(self, place: int) -> int:
        """Code points that begin before this byte."""
        block = place // COUNTED
        return int(self.before[block]) + int(np.count_nonzero(self.first[block * COUNTED:place]))

    def place(self, number: int) -> int:
        """The byte at which the code point of this number (from 0) begins, or the end."""
        if number >= self.before[-1]:
            return len(self.first)
        block = int(np.searchsorted(self.before, number, side="right")) - 1
        inside = np.flatnonzero(self.first[block * COUNTED:(block + 1) * COUNTED])
        return block * COUNTED + int(inside[number - int(self.before[block])])


def moved(size: int, starts: np.ndarray, shifts: np.ndarray):
    """(from, to, displacement of each byte between) of stretches of ``size`` bytes, of which
    the runs that begin at ``starts`` (rising) are displaced by ``shifts``."""
    change = np.diff(shifts, prepend=0)
    carried = 0
    for at in range(0, size, STRETCH):
        end = min(size, at + STRETCH)
        some = slice(*np.searchsorted(starts, [at, end]))
        steps = np.zeros(end - at, np.int64)
        np.add.at(steps, starts[some] - at, change[some])
        steps[0] += carried
        shift = np.cumsum(steps, out=steps)
        carried = int(shift[-1])
        yield at, end, shift


def plan(doc_ids: list, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(form, length and two cuts in code points, the cuts in bytes) of each text."""
    points = CodePoints(data)
    before = np.array([points.until(int(p)) for p in at])
    n = np.diff(before)
    marked = np.zeros(len(n), bool)
    marked[sentinels(data, at)[1]] = True
    form = np.zeros(len(n), np.int64)
    cuts, places = np.zeros((len(n), 2), np.int64), np.repeat(at[1:, None], 2, axis=1)
    for i in np.flatnonzero((n > 0) & ~marked):
        number = "" if doc_ids[i] is None else doc_ids[i]
        digest = hashlib.sha256(f"1:{number}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in range(0, 32, 8))
        if h3 % 100 < TRANSFORMED:
            form[i] = 2 if h4 % 100 < SPM else 1
            cuts[i] = sorted((h1 % (int(n[i]) + 1), h2 % (int(n[i]) + 1)))
            places[i] = [min(points.place(int(before[i] + c)), at[i + 1]) for c in cuts[i]]
    return form, np.column_stack([n, cuts]), places


def scatter(data: np.ndarray, at: np.ndarray, form: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The outputs' bytes, and where each begins."""
    changed = form > 0
    size = np.diff(at) + 3 * WIDTH * changed
    to = np.concatenate([[0], np.cumsum(size)])
    starts = np.column_stack([at[:-1], places])
    prefix, middle, suffix = places[:, 0] - at[:-1], places[:, 1] - places[:, 0], at[1:] - places[:, 1]
    spm = form == 2
    first = to[:-1] + WIDTH * changed
    second = first + np.where(spm, suffix, prefix) + WIDTH  # behind the second sentinel
    third = second + np.where(spm, prefix, suffix) + WIDTH
    target = np.column_stack([np.where(spm, second, first), third, np.where(spm, first, second)])
    target[~changed, 1:] = to[1:][~changed, None]
    out = np.empty(to[-1], np.uint8)
    for a, b, shift in moved(len(data), starts.ravel(), (target - starts).ravel()):
        out[np.arange(a, b) + shift] = data[a:b]
    for place, names in ((first, (PREFIX, SUFFIX)), (second, (SUFFIX, PREFIX)), (third, (MIDDLE, MIDDLE))):
        for kind, name in zip((1, 2), names):
            here = place[form == kind] - WIDTH
            for k in range(WIDTH):
                out[here + k] = name[k]
    return out, to


def gather(data: np.ndarray, at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that outputs of these forms were made of, and where each begins."""
    changed = form > 0
    marks, own = sentinels(data, at)
    marks = marks[changed[own]].reshape(-1, 3)
    begin = np.repeat(at[:-1, None], 3, axis=1)  # of what stands behind each sentinel, and its end
    end = np.repeat(at[1:, None], 3, axis=1)
    begin[changed] = marks + WIDTH
    end[changed, :2] = marks[:, 1:]
    begin[~changed, 1:] = end[~changed, 1:]
    spm = (form == 2)[:, None]
    order = np.where(spm, [[1, 2, 0]], [[0, 2, 1]])  # prefix, middle, suffix
    source = np.take_along_axis(begin, order, axis=1)
    size = np.take_along_axis(end - begin, order, axis=1)
    target = np.concatenate([[0], np.cumsum(size.ravel())])
    out = np.empty(target[-1], np.uint8)
    for a, b, shift in moved(len(out), target[:-1], source.ravel() - target[:-1]):
        out[a:b] = data[np.arange(a, b) + shift]
    return out, target[::3].copy()


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row for each row of ``docs``.

    ``n``, the prefix's and the middle's length are code points, the latter two null where the
    text stays ``plain``: when it is empty or null, when it holds a sentinel, or by the hash of
    its id. Equal ids cut alike; a null id is hashed as an empty one. Other columns are ignored;
    an empty table gives no rows. A task holds one slice of rows (or one longer text) and its
    output; displacements are held for a stretch at a time.
    """
    def start():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            data, at = _bytes_of(batch.column(1))
            form, counts, places = plan(batch.column(0).to_pylist(), data, at)
            plain = form == 0
            return [batch.column(0).cast(pa.int64()), longs(counts[:, 0]),
                    pa.array(np.array(FORMS, object)[form], pa.string()),
                    pa.array(counts[:, 1], pa.int64(), mask=plain),
                    pa.array(counts[:, 2] - counts[:, 1], pa.int64(), mask=plain),
                    _strings(*scatter(data, at, form, places))]
        return step

    return arrow_map(docs.select(id_col, text_col), SCHEMA, start)


def restore(transformed: DataFrame) -> DataFrame:
    """What :func:`transform` gives, with ``restored``: the text rebuilt from ``form`` and
    ``output`` alone."""
    def start():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            form = pc.index_in(batch.column(2), pa.array(FORMS)).to_numpy(zero_copy_only=False)
            return [*batch.columns, _strings(*gather(*_bytes_of(batch.column(5)), form))]
        return step

    return arrow_map(transformed, SCHEMA + ", restored string", start)


def digests(docs: DataFrame) -> DataFrame:
    """The transformation of each document with digests of output and restored text."""
    return restore(transform(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


FILL_MIDDLE_SQL = """
with hashed as (
  select doc_id, coalesce(text, '') as text,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
units as (
  select doc_id, text, length(text) as n, cast('0x' || substr(h, 1, 8) as bigint) as h1,
         cast('0x' || substr(h, 9, 8) as bigint) as h2, cast('0x' || substr(h, 17, 8) as bigint) as h3,
         cast('0x' || substr(h, 25, 8) as bigint) as h4 from hashed),
cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from units),
parts as (
  select *, substr(text, 1, a) as p, substr(text, a + 1, b - a) as m, substr(text, b + 1) as s from cuts)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from parts"""
