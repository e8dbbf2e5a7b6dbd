"""Entry points for a user's own Python functions; everything else stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from feedlens.functions.text import _col


#: Texts that are Python objects at a time.
TEXTS_HELD = 256


def apply_text_fn(c: Column | str, fn: Callable[[str], object], returns: str = "string") -> Column:
    """A Python function of one text over a column, in Arrow batches; NULL stays NULL.

    Only a few texts of a batch are Python objects at a time: as objects they take up to four
    bytes a character, the results as much again."""
    kind, few = to_arrow_type(T._parse_datatype_string(returns) if isinstance(returns, str) else returns), TEXTS_HELD

    @F.arrow_udf(returns)
    def run(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], kind)]
        for at in range(0, len(texts), few):
            done = texts.slice(at, few).to_pandas().map(fn, na_action="ignore")
            parts.append(pa.Array.from_pandas(done, type=kind))
        return pa.concat_arrays(parts)

    return run(_col(c))


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A function from a batch of rows to a batch of rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(fn, batches)

    return df.mapInPandas(run, schema)


def apply_per_group(
    df: DataFrame,
    key: str,
    partial: Callable[[pd.DataFrame], dict],
    merge: Callable[[pd.DataFrame], dict],
    finish: Callable[[dict], dict],
    state_schema: str,
    result_schema: str,
    max_states: int = 10_000,
) -> DataFrame:
    """A Python aggregate per group that never needs a whole group in one place.

    ``partial`` turns some rows of one group into a small state, ``merge`` combines state
    rows of one group, ``finish`` turns the last state into the result row. Each task
    reduces its rows to one state per group before the shuffle, and states meet in two
    rounds (by group and salt, then by group), so a hot group costs no more than any other.
    A task hands its states on when it holds ``max_states`` of them; the rounds merge them.
    """
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key_type = df.schema[key].dataType.simpleString()
    names = T.StructType.fromDDL(state_schema).fieldNames()
    out_names = T.StructType.fromDDL(result_schema).fieldNames()

    def as_frame(states: dict) -> pd.DataFrame:
        return pd.DataFrame([{key: k, **s} for k, s in states.items()], columns=[key, *names])

    def reduce_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict = {}
        for batch in batches:
            for value, rows in batch.groupby(key, sort=False):
                state = partial(rows)
                if value in states:
                    state = merge(pd.DataFrame([states[value], state], columns=names))
                states[value] = state
            if len(states) >= max_states:
                yield as_frame(states)
                states = {}
        if states:
            yield as_frame(states)

    def merge_group(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{key: rows[key].iloc[0], **merge(rows[names])}], columns=[key, *names])

    def finish_group(rows: pd.DataFrame) -> pd.DataFrame:
        result = finish(merge(rows[names]))
        return pd.DataFrame([{key: rows[key].iloc[0], **result}], columns=[key, *out_names])

    state = f"{key} {key_type}, {state_schema}"
    result = f"{key} {key_type}, {result_schema}"
    states = df.where(F.col(key).isNotNull()).mapInPandas(reduce_task, state)
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    rounds = states.withColumn("_salt", salt).groupBy(key, "_salt").applyInPandas(merge_group, state)
    return rounds.groupBy(key).applyInPandas(finish_group, result)
