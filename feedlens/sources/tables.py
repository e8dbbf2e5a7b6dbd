"""Message files (CSV) and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens import rules
from feedlens.schemas import MESSAGE_HEADER, MESSAGES, OPTIONAL_HEADER
from feedlens.sources.quoted_csv import read_quoted_csv

# Quotes are doubled inside quoted fields, fields may hold newlines, spaces are data.
# A file whose header differs from the schema is refused instead of misread.
_CSV_READ = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False}
_CSV_WRITE = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "emptyValue": "",
}


def _csv_schema(optional: list[T.StructField]) -> T.StructType:
    headers = {v: k for k, v in MESSAGE_HEADER.items()}
    return T.StructType([T.StructField(headers[f.name], f.dataType) for f in MESSAGES.fields] + optional)


def read_messages(
    spark: SparkSession,
    path: str,
    views: bool = False,
    entities: bool = False,
    na_words: bool = False,
    split: bool = True,
) -> DataFrame:
    """Message files with the declared schema and snake-case column names.

    Empty fields become NULL; ``na_words`` also maps words such as ``NA`` to NULL.
    ``views`` and ``entities`` say that the files carry these optional columns.
    Files are split between tasks, quoted newlines or not (see ``read_quoted_csv``, which
    refuses quotes inside unquoted fields); with ``split`` off one task reads a whole file.
    """
    optional = []
    if views:
        optional.append(T.StructField("views", T.LongType()))
    if entities:
        optional.append(T.StructField("entities", T.StringType()))
    schema = _csv_schema(optional)
    df = read_quoted_csv(spark, path, schema) if split else spark.read.options(**_CSV_READ).schema(schema).csv(path)
    names = MESSAGE_HEADER | OPTIONAL_HEADER
    missing = ["", *rules.NA_WORDS] if na_words else [""]
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            c = F.when(~c.isin(missing), c)
        columns.append(c.alias(names[field.name]))
    return df.select(columns)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    header: dict[str, str] | None = None,
    max_rows_per_file: int = 200_000,
    mode: str = "errorifexists",
) -> None:
    """Write a result table; ``header`` renames columns, CSV gets a header row.

    The row limit keeps CSV files small enough to be read by one task each.
    """
    if header:
        df = df.select([F.col(c).alias(header.get(c, c)) for c in df.columns])
    writer = df.write.mode(mode).option("maxRecordsPerFile", max_rows_per_file)
    if fmt == "csv":
        writer.options(**_CSV_WRITE).csv(path)
    else:
        writer.format(fmt).save(path)


def write_messages(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Write a message table under the file's own column names."""
    header = {column: name for name, column in (MESSAGE_HEADER | OPTIONAL_HEADER).items()}
    write_table(df, path, fmt, header, mode=mode)
