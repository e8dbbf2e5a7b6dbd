"""CoNLL text: one ``token<TAB>label`` line per token, a blank line after a sentence."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.functions.text import _col
from feedlens.operators.skew import broadcast_if_small
from feedlens.session import stored

# Blank lines with the line ends around them, and lines of two fields with one tab each.
_BLANK = re.compile(r"\n(?:[^\S\n]*+\n)+")
_PLAIN = re.compile(r"\S++\t\S++(?:\n\S++\t\S++)*+")
_BLOCK = ["file", "start", "place", "kind", "block"]
#: Characters that a task holds before it hands them on.
_HELD = 4 << 20


def conll_block(tokens: Column | str) -> Column:
    """Lines of one sentence (without the closing blank line)."""
    lines = F.transform(_col(tokens), lambda t: F.concat(t["token"], F.lit("\t"), t["label"]))
    return F.array_join(lines, "\n")


def write_conll(df: DataFrame, path: str, tokens: str = "tokens", mode: str = "errorifexists") -> None:
    """One row = one sentence; no sort and no shuffle."""
    df.select(conll_block(tokens).alias("value")).write.mode(mode).option("lineSep", "\n\n").text(path)


def _pairs(block: str) -> str:
    """The lines of two fields, a tab between these; most blocks hold nothing else."""
    if _PLAIN.fullmatch(block):
        return block
    return "\n".join("\t".join(f) for f in map(str.split, block.split("\n")) if len(f) == 2)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, str]]:
    """(file, start) and the text of its lines, one run of equal ones after the other."""
    encoded = [pc.run_end_encode(batch.column(i)) for i in (0, 1)]
    at = 0
    for end in sorted({e for c in encoded for e in c.run_ends.to_pylist()}):
        text = "\n".join(batch.column(2).slice(at, end - at).to_pylist())
        if "\r" in text:
            text = f"{text}\n".replace("\r\n", "\n").replace("\r", "\n").removesuffix("\n")
        yield tuple(batch.column(i)[at].as_py() for i in (0, 1)), text
        at = end


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, start), in order within their range -> runs of lines that are not blank, of
    which those of two fields are kept.

    ``place`` is the number of sentences before it in its range. ``kind`` is ``whole``, or
    ``more`` for the lines before a range's first blank one, which may go on a sentence of the
    range before, and ``open`` for those behind its last one; a range that ends with a blank
    line gives an empty ``closed``. Whole runs without a line of two fields are left out.
    """
    out: list[tuple] = []
    held: list[str] = []
    now, first, place, size = None, True, 0, 0

    def put(kind: str) -> None:
        nonlocal place
        block = _pairs("\n".join(held))
        if kind != "whole" or block:
            out.append((*now, place, kind, block))
            place += kind == "whole"
        held.clear()

    def leave() -> None:
        if now and first and now[1] > 0:
            put("more")
        elif now:
            put("open" if held else "closed")

    def flush() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = list(zip(*out)) if out else [()] * 5
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_BLOCK)

    for batch in batches:
        for own, text in _runs(batch):
            if now != own:
                leave()
                now, first, place = own, True, 0
            size += len(text)
            # Blank lines stand between the parts: all but the last one end with them.
            parts = _BLANK.split(f"\n{text}\n")
            for i, part in enumerate(parts):
                if i:
                    if first and now[1] > 0:
                        put("more")
                    elif held:
                        put("whole")
                    first = False
                if part := part.strip("\n"):
                    held.append(part)
            if size > _HELD:
                yield flush()
                size = 0
    leave()
    yield flush()


def read_conll(spark: SparkSession, path: str) -> DataFrame:
    """Sentences as ``sid, tokens array<struct<token,label>>``, numbered 0, 1, ... in the order
    of file names and of the places in a file, however the files are split between tasks.

    Lines that do not have exactly two fields are skipped and empty sentences vanish; lines end
    with ``\\n`` or ``\\r\\n``. Files are split at any line, and the parts of a sentence that
    crosses a split are put together. The sentences are stored once; a count per file range and
    the running sums of these counts turn their places into numbers.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    blocks = stored(lines.mapInArrow(_blocks, "file string, start bigint, place bigint, kind string, block string"), "conll-blocks")
    whole = blocks.where("kind = 'whole'").select("file", "start", "place", "block")
    # Two parts a range at most. What a range ends with takes what the next ones begin with.
    order = Window.partitionBy("file").orderBy("start", F.col("kind") != "more")
    ends = F.col("kind") != "more"
    edges = blocks.where("kind <> 'whole'").withColumn("number", F.sum(ends.cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("start", (F.col("kind") != "more").alias("end"), "place", "block")))
    joined = edges.groupBy("file", "number").agg(parts.alias("parts")).select(
        "file", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["place"].alias("place"),
        F.array_join(F.filter(F.transform("parts", lambda p: p["block"]), lambda x: x != ""), "\n").alias("block"))

    # Blocks hold lines of two fields only, and nothing but their tab is whitespace.
    tokens = F.transform(F.split("block", "\n"), lambda line: F.struct(
        F.substring_index(line, "\t", 1).alias("token"), F.substring_index(line, "\t", -1).alias("label")))
    kept = whole.unionByName(joined.where(F.col("block") != ""))
    ranges = kept.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"))
    ranges, _ = broadcast_if_small(stored(_numbered(ranges), "conll-ranges"))
    return kept.join(ranges, ["file", "start"]).select((F.col("before") + F.col("place")).alias("sid"), tokens.alias("tokens"))


def _numbered(ranges: DataFrame) -> DataFrame:
    """Adds ``before``, the sentences before each range: those of earlier files (a row per file
    meets in one task), and of earlier ranges of its own file."""
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    files = ranges.groupBy("file").agg(F.sum("n").alias("size"))
    above = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("size").over(above), F.lit(0)).alias("above"))
    return ranges.withColumn("inside", inside).join(files, "file").select(
        "file", "start", (F.col("inside") + F.col("above")).alias("before")
    )
