"""Document quality by tokeniser fertility (operator 5).

A public vocabulary with byte fallback measures each text: characters per token, the share
of tokens that are single bytes, and the entropy of its tokens. What lies far outside the
usual range of its language (or script) and length class is rejected. The ranges are
quartile fences over all documents.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import Memo, arrow_map, free_name, kept_in_worker, utf8_bytes, vocabulary
from feedlens.operators.skew import broadcast_if_small
from feedlens.session import stored

VOCABULARY = "piece_bpe_32k.model"
#: Below so many words a text is too short to judge, above this share of repeated words junk.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
WINDOW = 8
#: Fences lie this many interquartile ranges outside the quartiles.
FENCE = 3.0
#: Least interquartile range that a fence counts with: characters per token, byte share, bits.
LEAST_RANGE = (0.05, 0.01, 0.1)
#: A language's length class, then its script's, needs so many documents for fences.
MIN_DOCUMENTS = 50
#: Decimal places to which measures are rounded for quartiles: a group has few different values
#: then, so that exact quartiles need little memory and do not depend on partitions.
PLACES = 3
#: Bytes of parts that a worker remembers at least, and half of what it does at most.
REMEMBERED = 96 << 20

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
#: First code points of blocks that tell scripts apart, and the script from there on.
BLOCKS = {
    0x0: "latin", 0x370: "greek", 0x400: "cyrillic", 0x530: "armenian", 0x590: "hebrew",
    0x600: "arabic", 0x900: "indic", 0xE00: "southeast", 0x1100: "hangul", 0x1200: "ethiopic",
    0x13A0: "other", 0x1E00: "latin", 0x1F00: "greek", 0x2000: "other", 0x3040: "kana",
    0x3400: "han", 0xA000: "other", 0xAC00: "hangul", 0xD7B0: "other", 0xF900: "han",
    0xFB00: "other", 0x20000: "han", 0x30000: "other",
}
_STARTS = np.array(list(BLOCKS))
_SCRIPTS = sorted(set(BLOCKS.values()))
_SCRIPT_OF = np.array([_SCRIPTS.index(s) for s in BLOCKS.values()])

METRICS = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
           "n_repeat_words bigint, script string, n_tokens bigint, chars_per_token double, "
           "byte_share double, entropy double")
MEASURES = ("chars_per_token", "byte_share", "entropy")


class Pieces:
    """Ids of each word (UTF-8) with the space before it, as 16-bit numbers."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.words = Memo(self._encode, REMEMBERED)

    def _encode(self, words: list[bytes]) -> list[bytes]:
        found = self.model.encode([w.decode() for w in words], num_threads=1)
        return [array("H", ids).tobytes() for ids in found]


def pieces(path: str) -> Pieces:
    return kept_in_worker(("pieces", path), lambda: Pieces(path))


def script_of(text: str) -> str:
    """Script of most letters and other signs above the ASCII punctuation."""
    if text.isascii():
        return "latin"
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    codes = codes[codes >= 0x41]
    if not len(codes):
        return "latin"
    block = np.searchsorted(_STARTS, codes, side="right") - 1
    return _SCRIPTS[int(np.bincount(_SCRIPT_OF[block], minlength=len(_SCRIPTS)).argmax())]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    # Equal windows have equal hashes, so a text without equal hashes is done.
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for j in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[j:n + j]
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():
        return 0
    # Numbers of ever longer windows, from those of two shorter ones side by side.
    number: dict[bytes, int] = {}
    ids, length = np.array([number.setdefault(w, len(number)) for w in words], np.int64), 1
    while length < window:
        step = min(length, window - length)
        left, right = ids[:len(ids) - step], ids[step:]
        ids = np.unique(left * (int(ids.max()) + 1) + right, return_inverse=True)[1]
        length += step
    twice = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edge = np.bincount(twice, minlength=len(words) + 1) - np.bincount(twice + window, minlength=len(words) + 1)
    return int((np.cumsum(edge) > 0).sum())


def entropy(ids: np.ndarray) -> float:
    """Bits per token of the distribution of ``ids``."""
    if not len(ids):
        return 0.0
    counts = np.bincount(ids)
    counts = counts[counts > 0]
    return float(np.log2(len(ids)) - (counts * np.log2(counts)).sum() / len(ids))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            path: str = vocabulary(VOCABULARY), keep: list[str] = ()) -> DataFrame:
    """The columns of ``METRICS`` for each row of ``docs``, and those named in ``keep`` under
    their names. Null texts count as empty; an empty text has zeros and the script latin."""
    def start():
        known = pieces(path)
        is_byte = known.is_byte

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            rows, texts = [], utf8_bytes(batch.column(1))
            split = [raw.split() for raw in texts]
            for raw, words, found in zip(texts, split, known.words.of(split)):
                text, ids = raw.decode(), np.frombuffer(b"".join(found), np.uint16)
                inside = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
                lines = [x for x in raw.split(b"\n") if x.strip()]
                n = len(ids)
                rows.append((
                    len(words), inside, len(raw) - len(raw.translate(None, SYMBOLS)),
                    len(lines) - len(set(lines)), repeated_words(words), script_of(text), n,
                    inside / n if n else 0.0, float(is_byte[ids].mean()) if n else 0.0, entropy(ids),
                ))
            columns = list(zip(*rows)) if rows else [()] * 10
            kinds = [pa.int64()] * 5 + [pa.string(), pa.int64()] + [pa.float64()] * 3
            return ([batch.column(0).cast(pa.int64())] + [pa.array(c, k) for c, k in zip(columns, kinds)]
                    + [batch.column(2 + i) for i in range(len(keep))])
        return step

    kept = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return arrow_map(docs.select(id_col, text_col, *keep), METRICS + kept, start)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def length_class() -> Column:
    """Texts whose token counts lie within a factor of four; entropy depends on the length."""
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1))) / 2).cast("int")


def fences(measured: DataFrame, *group: str) -> DataFrame:
    """(group, low and high of each measure) of groups with enough documents. Without the
    length class in the group the entropy, which depends on the length, has no limits."""
    quartiles = [
        F.percentile(F.round(m, PLACES), F.array(F.lit(0.25), F.lit(0.75))).alias(f"q_{m}") for m in MEASURES
    ]
    found = (measured.where(~F.col("base_failed") & F.col(group[0]).isNotNull())
             .groupBy(*group).agg(F.count(F.lit(1)).alias("n"), *quartiles)
             .where(F.col("n") >= MIN_DOCUMENTS))
    limits = []
    for m, least in zip(MEASURES, LEAST_RANGE):
        low, high = F.col(f"q_{m}")[0], F.col(f"q_{m}")[1]
        width = FENCE * F.greatest(high - low, F.lit(least))
        if m == "entropy" and "length_class" not in group:
            width = F.lit(float("inf"))
        limits.append(F.struct((low - width).alias("low"), (high + width).alias("high")).alias(m))
    return found.select(*group, F.struct(*limits).alias("by_" + "_".join(group)))


def judge(measured: DataFrame, lang_col: str | None = None) -> DataFrame:
    """``measured`` (a stored table) with ``base_failed`` and ``kept``.

    ``lang_col`` names the language; without one, or where it is null or rare, the script
    stands in. Where a length class has too few documents the fences over all lengths do;
    without any the base rules alone decide. A verdict depends on the documents of its own
    language and script only, whatever else is in the table. Fences are stored, and broadcast
    if their measured size is small.
    """
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    rows = measured.select(
        "*", base_failed().alias("base_failed"), length_class().alias("length_class"), lang.alias("language"))
    groups = [("language", "length_class"), ("script", "length_class"), ("language",), ("script",)]
    for group in groups:
        found, _ = broadcast_if_small(stored(fences(rows.select(*group, "base_failed", *MEASURES), *group), "fences"))
        rows = rows.join(found, list(group), "left")
    limits = F.coalesce(*["by_" + "_".join(group) for group in groups])
    outside = F.lit(False)
    for m in MEASURES:
        high = F.col(m) > limits[m]["high"]
        # Few byte tokens are no fault.
        outside = outside | (high if m == "byte_share" else high | (F.col(m) < limits[m]["low"]))
    kept = ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))
    return rows.select(*measured.columns, "base_failed", kept.alias("kept"))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str | None = "lang", path: str = vocabulary(VOCABULARY)) -> DataFrame:
    """One row per row of ``docs`` with the measures, ``base_failed`` and ``kept``.

    Texts are measured once into a stored table of numbers, over which the fences are taken.
    Null texts count as empty and fail the base rules (no words); equal rows get equal
    verdicts; an empty table gives no rows; columns besides the named are ignored.
    """
    own = docs.select(id_col, text_col, *([F.col(lang_col).alias("lang_")] if lang_col else []))
    measured = measure(own, id_col, text_col, path, ["lang_"] if lang_col else [])
    return judge(stored(measured, "fertility"), "lang_" if lang_col else None).drop("lang_")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str | None = "lang", path: str = vocabulary(VOCABULARY)) -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, with all their columns.

    Rows are matched to verdicts by id and a digest of text and language, so repeated ids
    get the verdict of their own text.
    """
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    digest = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), lang)
    own = docs.select(F.col(id_col).cast("bigint").alias("key_"), F.col(text_col).alias("text_"),
                      lang.alias("lang_"), digest.alias("digest_"))
    judged = judge(stored(measure(own, "key_", "text_", path, ["lang_", "digest_"]), "fertility"), "lang_")
    rejected = judged.where(~F.col("kept")).select("doc_id", "digest_").distinct()
    id_name, digest_name = free_name(docs, "id_"), free_name(docs, "digest_")
    rejected = rejected.toDF("r_id", "r_digest")
    marked = docs.withColumn(id_name, F.col(id_col).cast("bigint")).withColumn(digest_name, digest)
    same = marked[id_name].eqNullSafe(rejected["r_id"]) & (marked[digest_name] == rejected["r_digest"])
    return marked.join(rejected, same, "left_anti").select(*[f"`{c}`" for c in docs.columns])
