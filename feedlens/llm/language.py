"""Language identification by string kernels (operator 1).

Two texts are compared by the character n-grams that both hold: k(x, y) = |G(x) & G(y)| /
sqrt(|G(x)| |G(y)|), where G is the set of n-grams of one to ``MAX_N`` characters (blended
spectrum, presence only), hashed into ``BUCKETS``. Nystroem features over landmark texts
turn the kernel into a short vector, one-versus-rest ridge regression learns the languages
over them, and batches of documents are scored by matrix products.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedlens.llm.common import arrow_map, bounded, slices
from feedlens.operators.skew import broadcast_if_small
from feedlens.session import stored

MAX_N = 3
BUCKETS = 1 << 16
#: The model is fitted on a sample: so many documents of each language. So many of the sample
#: are landmarks, or so many of each language if that is more.
SAMPLE_PER_LANGUAGE, LANDMARKS, LANDMARKS_PER_LANGUAGE = 300, 256, 4
#: Sample rows compared with as many landmarks at a time.
BLOCK = 64
#: Each language costs 32 KB of landmarks and 256 KB of weights wherever the model is. A label
#: column of more values than this is an error, not a smaller model.
MOST_LANGUAGES = 2000
RIDGE = 0.1
UNDETERMINED = "und"
#: Documents scored by one product; bounds the size of the presence matrix.
BATCH = 32
#: Code points hashed at a time, so that long texts need little memory.
STRETCH = 1 << 16

PREDICTIONS = "doc_id bigint, lang_pred string, score double"


_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """The text in lower case with one space in place of each run of other signs than
    letters; empty if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return ""
    return f" {_OTHER.sub(' ', text.lower()).strip()} "


def gram_buckets(text: str) -> list[np.ndarray]:
    """Buckets of the n-grams of a text, with repeats, in stretches."""
    found = []
    for at in range(0, len(text), STRETCH):
        part = text[at:at + STRETCH + MAX_N - 1]
        codes = np.frombuffer(part.encode("utf-32-le"), "<u4").astype(np.uint64)
        mixed = np.zeros(len(codes), np.uint64)
        for n in range(1, MAX_N + 1):
            if len(codes) < n:
                break
            mixed = mixed[:len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:] + np.uint64(n)
            hashed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
            found.append((hashed >> np.uint64(64 - 16)).astype(np.int64))
    return found


def presence(texts: list[str | None]) -> np.ndarray:
    """One row per text: 1 for each bucket with an n-gram of the text."""
    rows = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(rows, texts):
        for buckets in gram_buckets(letters(text)):
            row[buckets] = 1
    return rows


@dataclass(frozen=True)
class LanguageModel:
    """``weights`` (buckets x languages) holds the landmark kernel and the ridge solution as
    one product: scores = presence @ weights / |G|^(1/2)."""

    languages: list[str]
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        rows = presence(texts)
        size = rows.sum(axis=1)
        outputs = (rows @ self.weights) / np.sqrt(np.maximum(size, 1))[:, None]
        best = outputs.argmax(axis=1)
        # Outputs aim at 1 for the own language and -1 for the others.
        score = np.clip((outputs.max(axis=1).astype(float) + 1) / 2, 0, 1)
        names = [self.languages[b] if n else UNDETERMINED for b, n in zip(best, size)]
        return names, np.where(size > 0, score, 0.0)


def unit(packed: np.ndarray) -> np.ndarray:
    """Rows of packed presence bits, scaled to length 1."""
    x = np.unpackbits(packed, axis=1).astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None]


def blocks(packed: np.ndarray) -> Iterator[np.ndarray]:
    return (unit(packed[at:at + BLOCK]) for at in range(0, len(packed), BLOCK))


def kernel_rows(packed: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel of each row with each landmark, all as packed bits."""
    columns = []
    for mark in blocks(marks):
        columns.append(np.concatenate([x @ mark.T for x in blocks(packed)]))
    return np.concatenate(columns, axis=1).astype(float)


def solved(languages: list[str], marks: np.ndarray, products: np.ndarray, sums: np.ndarray,
           ridge: float = RIDGE) -> LanguageModel:
    """Model of landmarks and of the sample's kernel rows k: the sum of the products k k' and,
    for each language, the sum of its k."""
    kernel = kernel_rows(marks, marks)
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # inverse square root of the landmark kernel
    gram = root.T @ products @ root + ridge * np.eye(root.shape[1])
    # Targets are 1 for the own language and -1 for the others.
    solution = root @ np.linalg.solve(gram, root.T @ (2 * sums - sums.sum(axis=0)).T)
    weights = np.zeros((BUCKETS, len(languages)), np.float32)
    for at, mark in zip(range(0, len(marks), BLOCK), blocks(marks)):
        weights += mark.T @ solution[at:at + BLOCK].astype(np.float32)
    return LanguageModel(languages, weights)


def sample(docs: DataFrame, id_col: str, lang_col: str, per_language: int) -> DataFrame:
    """At most ``per_language`` rows of each language with their ``rank`` in it, by a hash of the
    id and the text, so that neither order nor partitions of the input matter.

    Language counts thin the rows out before any of them moves: a window sees about twice
    what it keeps of each language. The row of the least hash always stays, so a language is
    never lost, also if all its rows are equal.
    """
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), "text_", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    marked = docs.withColumn("_draw", draw)
    counts = marked.groupBy(lang_col).agg(F.count(F.lit(1)).alias("_n"), F.min("_draw").alias("_least"))
    counts, _ = broadcast_if_small(stored(counts, "language-counts"))
    drawn = marked.join(counts, lang_col).where(
        (F.col("_draw") * F.col("_n") < 2.0 * per_language + 40) | (F.col("_draw") == F.col("_least")))
    first = Window.partitionBy(lang_col).orderBy("_draw", id_col)
    return (drawn.withColumn("rank", F.row_number().over(first))
            .where(F.col("rank") <= per_language).drop("_draw", "_n", "_least"))


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> LanguageModel:
    """Model from the rows with a text that has a letter and a language, of all languages.

    Sample texts become rows of bits on the executors, which also sum what the ridge needs.
    The driver gets the landmarks (8 KB each) and one sum at a time: with m landmarks m x m
    numbers of each task, and m of each of its languages.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("id_"), F.col(text_col).alias("text_"), F.col(lang_col).alias("lang_"))
    drawn = sample(rows, "id_", "lang_", per_language).select("id_", "lang_", "text_", "rank")

    def start():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            bits = [np.packbits(presence([t])[0] > 0).tobytes() for t in batch.column(2).to_pylist()]
            return [batch.column(0).cast(pa.int64()), batch.column(1), batch.column(3), pa.array(bits, pa.binary())]
        return step

    found = stored(arrow_map(drawn, "id_ bigint, lang_ string, rank int, bits binary", start), "language-sample")
    languages = sorted(r["lang_"] for r in found.select("lang_").distinct().collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{len(languages)} different labels are more than {MOST_LANGUAGES} languages")
    if not languages:
        return LanguageModel([UNDETERMINED], np.zeros((BUCKETS, 1), np.float32))
    each = max(LANDMARKS_PER_LANGUAGE, -(-LANDMARKS // len(languages)))
    chosen = sorted((r["lang_"], r["rank"], bytes(r["bits"])) for r in found.where(F.col("rank") <= each).collect())
    marks = np.frombuffer(b"".join(bits for *_, bits in chosen), np.uint8).reshape(-1, BUCKETS // 8)
    shared = labelled.sparkSession.sparkContext.broadcast(marks)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        products, own = np.zeros((len(marks), len(marks))), {}
        for batch in batches:
            for part in slices(batch):
                packed = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                near = kernel_rows(packed, marks)
                products += near.T @ near
                for lang, row in zip(part.column(0).to_pylist(), near):
                    own[lang] = own.get(lang, 0) + row
        if own:
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *own], pa.string()),
                 pa.array([products.tobytes(), *(np.asarray(x).tobytes() for x in own.values())], pa.binary())],
                names=["lang", "sums"])

    products, by_language = np.zeros((len(marks), len(marks))), np.zeros((len(languages), len(marks)))
    number = {lang: i for i, lang in enumerate(languages)}
    # In the order of the partitions, so that rounding is the same each time.
    for r in bounded(found.select("lang_", "bits")).mapInArrow(sums, "lang string, sums binary").toLocalIterator():
        some = np.frombuffer(r["sums"], float)
        if r["lang"] is None:
            products += some.reshape(products.shape)
        else:
            by_language[number[r["lang"]]] += some
    return solved(languages, marks, products, by_language)


def predict(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
    keep: list[str] = (),
) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs``, and the columns in ``keep``.

    ``und`` with score 0 if the text is null or has no letter; otherwise one of the learned
    languages (``und`` if none was learned); of equal outputs the first in alphabetical
    order. Repeated rows stay; an empty table gives none; other columns are ignored. The
    model travels to the executors as a broadcast of BUCKETS numbers for each language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            names, scores = [], []
            for at in range(0, batch.num_rows, BATCH):
                some, own = model.predict(batch.column(1).slice(at, BATCH).to_pylist())
                names += some
                scores.append(own)
            scores = np.concatenate(scores) if scores else np.zeros(0)
            return ([batch.column(0).cast(pa.int64()), pa.array(names, pa.string()), pa.array(scores)]
                    + [batch.column(2 + i) for i in range(len(keep))])
        return step

    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return arrow_map(docs.select(id_col, text_col, *keep), PREDICTIONS + kept, start)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the model never learns from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """Predictions for all documents by a model of those that are not held out."""
    rows = docs.select("doc_id", "text", "lang", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")))
    return predict(rows, model, keep=["held_out"]).select("doc_id", "held_out", "lang_pred", "score")
