"""CSV files with newlines inside quoted fields, read by many tasks per file.

A file is cut into ranges of lines as any text is. Whether a range begins inside a quoted
field depends on all quotes before it: their number per range is counted first, and running
sums over the ranges of a file tell each one how it begins. A range then puts its lines
together to records; the pieces of a record that crosses ranges meet by its number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.text import bind
from feedlens.operators.skew import broadcast_if_small
from feedlens.session import stored

_RANGE = ["file", "start"]
#: Characters of records that a task holds before it hands them on.
_HELD = 4 << 20

PIECES = "file string, start bigint, kind string, place bigint, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _begins_inside(lines: DataFrame) -> DataFrame:
    """``file, start, inside``: one row per range, true where it begins inside quotes. A file
    whose quotes don't pair up is an error."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = stored(lines.groupBy(*_RANGE).agg(F.sum(quotes).alias("quotes")), "quotes")
    odd = counts.groupBy("file").agg(F.sum("quotes").alias("n")).where("n % 2 = 1").first()
    if odd:
        raise ValueError(f"the quotes of {odd['file']} do not pair up")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*_RANGE, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, start, inside, value), in order within their range -> records.

    ``place`` numbers what a range gives. ``kind`` is ``whole``, or, of a record that crosses
    ranges, ``first`` (what a range ends with) or ``more`` (what it begins with).
    """
    out: list[tuple] = []
    held: list[str] = []
    now, open_, kind, place, size = None, False, "whole", 0, 0

    def flush():
        rows = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5,
                                            (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()))],
            names=["file", "start", "kind", "place", "record"])
        out.clear()
        return rows

    def leave():
        # What is open at a range's end goes on in the next one.
        if held:
            out.append((*now, "more" if kind == "more" else "first", place, "\n".join(held)))
            held.clear()

    for batch in batches:
        for file, start, inside, line in zip(*(c.to_pylist() for c in batch.columns)):
            if now != (file, start):
                leave()
                now, open_, kind, place = (file, start), inside, "more" if inside else "whole", 0
            held.append(line)
            size += len(line)
            if line.count('"') % 2:
                open_ = not open_
            if not open_:
                out.append((*now, kind, place, "\n".join(held)))
                held.clear()
                kind, place = "whole", place + 1
            if size > _HELD:
                yield flush()
                size = 0
    leave()
    yield flush()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, header, record``: the records of the files as text, quotes and inner newlines as
    they are; ``header`` marks the first record of a file."""
    lines = _lines(spark, path)
    ranges, fits = broadcast_if_small(stored(_begins_inside(lines), "csv-ranges"))
    if fits:
        rows = lines.join(ranges, _RANGE)  # in the order of the scan
    else:
        rows = lines.withColumn("at", F.monotonically_increasing_id()).join(ranges, _RANGE)
        rows = rows.repartition(*_RANGE).sortWithinPartitions(*_RANGE, "at")
    pieces = stored(rows.select(*_RANGE, "inside", "value").mapInArrow(_pieces, PIECES), "csv-records")
    header = (F.col("start") == 0) & (F.col("place") == 0)
    whole = pieces.where("kind = 'whole'").select("file", header.alias("header"), "record")
    # Two pieces a range at most. A record that crosses ranges has one first piece, and takes
    # what follows it in the file.
    order = Window.partitionBy("file").orderBy("start", "place")
    number = F.sum((F.col("kind") == "first").cast("int")).over(order)
    crossing = pieces.where("kind <> 'whole'").withColumn("number", number)
    parts = F.sort_array(F.collect_list(F.struct("start", "place", "record")))
    joined = crossing.groupBy("file", "number").agg(parts.alias("parts")).select(
        "file", F.lit(False).alias("header"), F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined)


def _misquoted(record: Column) -> Column:
    """Whether quotes stand elsewhere than around fields and doubled inside them."""
    parts = F.split(F.replace(record, F.lit('""'), F.lit("")), '"')

    def stray(part: Column, i: Column, n: Column) -> Column:
        # Outside of quotes: what stands between two fields begins and ends with a comma.
        begins = (i == 0) | part.startswith(",")
        ends = (i == n - 1) | part.endswith(",") | ((i == 0) & (part == ""))
        last = (i == n - 1) & (part == "")
        return (i % 2 == 0) & (n > 1) & ~((begins | last) & ends)

    return bind(parts, lambda p: F.exists(F.transform(p, lambda x, i: stray(x, i, F.size(p))), lambda x: x))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of CSV files with a header line; every file is split between tasks.

    The files follow the usual rules: quotes around fields, doubled inside. A record that does
    not, a header that differs from the schema, and quotes that do not pair up are errors.
    Empty lines are skipped. Runs while it is called: the records are stored once.
    """
    records = read_records(spark, path)
    header = F.regexp_replace("record", '[\\x{FEFF}"\r]', "")
    expected = ",".join(schema.fieldNames())
    other = records.where(F.col("header") & (header != expected)).first()
    if other:
        raise ValueError(f"the header of {other['file']} is {other['record']!r}, not {expected!r}")
    record = F.regexp_replace("record", r"\r\z", "")
    rows = records.where("not header").select("file", record.alias("record")).where("record <> ''")
    checked = F.when(_misquoted(F.col("record")), F.raise_error(F.concat(
        F.lit("a stray quote in "), "file", F.lit(": "), F.substring("record", 1, 200)))).otherwise(F.col("record"))
    parsed = F.from_csv(checked, _ddl(schema), {"escape": '"', "multiLine": "true"})
    return rows.select(parsed.alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
