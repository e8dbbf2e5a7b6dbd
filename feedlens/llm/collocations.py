"""Collocations by prefix-free parsing (operator 13).

Pieces of text are cut into chunks where the hash of a window of words says so, so equal
passages are cut alike wherever they stand; neighbouring chunks share that window. Equal chunks
become one entry of a dictionary with its number of occurrences, and phrases are counted inside
the distinct chunks, weighted by it. A phrase that begins in a shared window belongs to the
chunk that the window begins, so every occurrence is counted once.

Words are counted first, then hashes of pairs of frequent words, then phrases that are runs of
frequent pairs. What is frequent travels as a bitmap of fixed size: it may let a rare phrase
through to be counted, and never stops a frequent one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from feedlens.llm.common import bounded, slices
from feedlens.operators.topn import top_n_per_group
from feedlens.session import stored

LONGEST, LEAST_COUNT, TOP, UNKNOWN = 5, 100, 2000, "und"
#: Words that neighbouring chunks share, and one of how many windows begins a chunk.
SHARED, EVERY = LONGEST - 1, 16
#: Bits of a bitmap of frequent phrases, a multiple of 32,768.
BITS = 1 << 26
#: A longer text is read in stretches that end at a piece's end.
STRETCH = 4 << 20

_BREAK = re.compile(rb"[.,;:!?\x0a-\x0d]")
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_SPACES = _BREAKS.copy()
_SPACES[[0x20, 0x09]] = True
#: Factors by which the checksums of a phrase's language and words are mixed into its bit.
_LANG, _FIRST, _SECOND = 999_983, 611_953, 1_000_003


@dataclass
class Words:
    """Words of some rows: ``text`` holds them with one blank behind each."""

    text: np.ndarray
    begin: np.ndarray  # of each word in the text
    end: np.ndarray
    code: np.ndarray  # of each word in names
    names: pa.Array
    row: np.ndarray
    piece: np.ndarray  # number of the word's piece

    @classmethod
    def of(cls, rows: pa.Array) -> Words:
        """Words of the rows (binary, no nulls), which end pieces as a line break does."""
        if not len(rows):
            rows = pa.array([b""], pa.large_binary())
        rows = pc.binary_join_element_wise(rows.cast(pa.large_binary()), *(pa.scalar(x, pa.large_binary()) for x in (b"", b"\n")))
        at = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset:rows.offset + len(rows) + 1]
        data = np.frombuffer(rows.buffers()[2], np.uint8)[at[0]:at[-1]].copy()
        at = at - at[0]
        upper = (data >= ord("A")) & (data <= ord("Z"))
        data[upper] += 32
        inside = ~_SPACES[data]
        behind = np.zeros(len(data), bool)
        behind[1:] = inside[:-1] & ~inside[1:]
        before = inside.copy()
        before[1:] &= ~inside[:-1]
        starts = np.flatnonzero(before)
        pieces = np.cumsum(_BREAKS[data], dtype=np.int64)[starts]
        text = data[inside | behind]
        text[~inside[inside | behind]] = 0x20
        end = np.flatnonzero(text == 0x20)
        begin = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
        offsets = np.concatenate([[0], end + 1]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(end), [None, pa.py_buffer(offsets), pa.py_buffer(text)]).dictionary_encode()
        return cls(text, begin, end, words.indices.to_numpy(), words.dictionary,
                   np.searchsorted(at, starts, side="right") - 1, pieces)

    def checksums(self) -> np.ndarray:
        """Of each distinct word."""
        return np.array([zlib.crc32(w[:-1]) for w in self.names.to_pylist()], np.int64)

    def phrases(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """Words ``first`` to ``last`` of each phrase, joined by one blank."""
        begin, size = self.begin[first], self.end[last] - self.begin[first]
        at = np.concatenate([[0], np.cumsum(size)])
        places = np.arange(at[-1]) + np.repeat(begin - at[:-1], size)
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(self.text[places])])


def chunk_starts(words: Words, every: int = EVERY) -> np.ndarray:
    """Whether a chunk begins at each word: a piece does, or a window of ``SHARED`` words of one
    piece whose hash is one of ``every``."""
    n = len(words.code)
    begins = np.ones(n, bool)
    begins[1:] = words.piece[1:] != words.piece[:-1]
    if n >= SHARED:
        sums = words.checksums().astype(np.uint64)[words.code]
        window = np.zeros(n - SHARED + 1, np.uint64)
        for k in range(SHARED):
            window = window * np.uint64(0x9E3779B97F4A7C15) + sums[k:n - SHARED + 1 + k]
        window ^= window >> np.uint64(29)
        window *= np.uint64(0xBF58476D1CE4E5B9)
        whole = words.piece[SHARED - 1:] == words.piece[:n - SHARED + 1]
        begins[:n - SHARED + 1] |= whole & ((window >> np.uint64(40)) % np.uint64(every) == 0)
    return begins


def chunks_of(langs: pa.Array, texts: pa.Array, every: int = EVERY) -> pa.Table:
    """(lang, shared, chunk, n) of the texts: ``shared`` words at a chunk's end begin the next."""
    words = Words.of(texts)
    first = np.flatnonzero(chunk_starts(words, every))
    following = np.append(first[1:], len(words.code)).astype(np.int64)
    goes_on = np.zeros(len(first), bool)
    goes_on[:-1] = words.piece[first[1:]] == words.piece[first[:-1]]
    shared = np.where(goes_on, SHARED, 0)
    table = pa.table({"lang": langs.take(pa.array(words.row[first])), "shared": shared.astype(np.int32),
                      "chunk": words.phrases(first, following - 1 + shared).cast(pa.large_string()).cast(pa.string()),
                      "n": np.ones(len(first), np.int64)})
    return table.group_by(["lang", "shared", "chunk"]).aggregate([("n", "sum")]).rename_columns(table.column_names)


def stretches(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(langs, texts) of the batch, small ones together, long ones cut at the ends of pieces."""
    for part in slices(batch):
        langs, texts = part.column(0), pc.fill_null(part.column(1), "").cast(pa.large_binary())
        if part.num_rows > 1 or len(whole := texts[0].as_py()) <= STRETCH:
            yield langs, texts
            continue
        at = 0
        while at < len(whole):
            cut = _BREAK.search(whole, at + STRETCH)
            end = cut.end() if cut else len(whole)
            yield langs, pa.array([whole[at:end]], pa.large_binary())
            at = end


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, small ones put together up to ``STRETCH`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= STRETCH:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _mapped(df: DataFrame, schema: str, tables: Callable[[pa.RecordBatch], Iterator[pa.Table]]) -> DataFrame:
    types = pa.schema([(f.name, {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[f.dataType.simpleString()])
                       for f in StructType.fromDDL(schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _joined(batches):
            for table in tables(batch):
                yield from table.cast(types).to_batches(max_chunksize=100_000)

    return bounded(df).mapInArrow(run, schema)


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", every: int = EVERY) -> DataFrame:
    """(lang, shared, chunk, n): the distinct chunks of all texts with their parse frequencies."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    found = _mapped(rows, "lang string, shared int, chunk string, n bigint",
                    lambda batch: (chunks_of(*some, every) for some in stretches(batch)))
    return found.groupBy("lang", "shared", "chunk").agg(F.sum("n").alias("n"))


@dataclass
class Entries:
    """Words of some dictionary entries; ``weight`` is 0 where a phrase belongs to the next chunk."""

    words: Words
    lang: np.ndarray  # of each word, as a number in langs
    langs: pa.Array
    weight: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Entries:
        words = Words.of(batch.column(2).cast(pa.large_binary()))
        coded = batch.column(0).dictionary_encode()
        shared, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 3))
        last = np.searchsorted(words.row, np.arange(batch.num_rows), side="right")
        own = np.arange(len(words.row)) < (last - shared)[words.row]
        return cls(words, coded.indices.to_numpy()[words.row].astype(np.int64), coded.dictionary, n[words.row] * own)

    def lang_sums(self) -> np.ndarray:
        sums = np.array([zlib.crc32(x.encode()) for x in self.langs.to_pylist()], np.int64)
        return sums[self.lang] * _LANG

    def inside(self, size: int) -> np.ndarray:
        """Whether the ``size`` words from each word on stand in one entry."""
        row = self.words.row
        whole = np.zeros(len(row), bool)
        whole[:max(0, len(row) - size + 1)] = row[size - 1:] == row[:max(0, len(row) - size + 1)]
        return whole

    def cells(self, sums: np.ndarray) -> np.ndarray:
        """32 bits for each word and the next one, from the checksums of the words."""
        mixed = (sums[:-1] * _FIRST + sums[1:] * _SECOND + self.lang_sums()[:-1]).astype(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(32)).astype(np.int64)

    def counted(self, code: np.ndarray, at: np.ndarray, size: int) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        """(lang, phrase, f) of the phrases of ``size`` words from each of ``at`` on, told apart
        by ``code``; and each phrase's number and first place."""
        _, first, number = np.unique(code, return_index=True, return_inverse=True)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, number, self.weight[at])
        place = at[first]
        some = np.flatnonzero(total)
        table = pa.table({"lang": self.langs.take(pa.array(self.lang[place[some]])),
                          "phrase": self.words.phrases(place[some], place[some] + size - 1)
                          .cast(pa.large_string()).cast(pa.string()), "f": total[some]})
        return table, number, place


PHRASES = "lang string, phrase string, f bigint"


def word_counts(entries: DataFrame) -> DataFrame:
    """(lang, phrase, f) of the words; the empty phrase has the number of all words."""
    def tables(batch: pa.RecordBatch) -> Iterator[pa.Table]:
        some = Entries.of(batch)
        code = some.lang * len(some.words.names) + some.words.code
        yield some.counted(code, np.arange(len(code)), 1)[0]
        totals = np.zeros(len(some.langs), np.int64)
        np.add.at(totals, some.lang, some.weight)
        yield pa.table({"lang": some.langs, "phrase": pa.array([""] * len(totals)), "f": totals})

    return _mapped(entries, PHRASES, tables)


def pair_cells(entries: DataFrame, frequent_words) -> DataFrame:
    """(cell, n) of the pairs of words that the bitmap (a broadcast) has: a hash of 32 bits
    stands for a pair, which is much less to shuffle."""
    def tables(batch: pa.RecordBatch) -> Iterator[pa.Table]:
        some = Entries.of(batch)
        sums = some.words.checksums()[some.words.code]
        frequent = _held(frequent_words.value, sums * _FIRST + some.lang_sums())
        pairs = some.inside(2)
        pairs[:-1] &= frequent[:-1] & frequent[1:]
        pairs &= some.weight > 0
        cells, number = np.unique(some.cells(sums)[pairs[:-1]], return_inverse=True)
        total = np.zeros(len(cells), np.int64)
        np.add.at(total, number, some.weight[:-1][pairs[:-1]])
        yield pa.table({"cell": cells, "n": total})

    return _mapped(entries, "cell bigint, n bigint", tables)


def phrase_counts(entries: DataFrame, frequent_cells, longest: int) -> DataFrame:
    """(lang, phrase, f) of the phrases of 2 words or more whose pairs the bitmap all has."""
    def tables(batch: pa.RecordBatch) -> Iterator[pa.Table]:
        some = Entries.of(batch)
        code = some.words.code.astype(np.int64)
        frequent = some.inside(2)
        frequent[:-1] &= _held(frequent_cells.value, some.cells(some.words.checksums()[code]))
        at = np.flatnonzero(frequent)
        names = len(some.words.names)
        # Each phrase is numbered by its words but the last, and the last.
        number = some.lang[at] * names + code[at]
        for size in range(2, longest + 1):
            goes_on = frequent[at + size - 2]
            at, number = at[goes_on], number[goes_on]
            if not len(at):
                return
            table, number, _ = some.counted(number * names + code[at + size - 1], at, size)
            yield table

    return _mapped(entries, PHRASES, tables)


def _held(bitmap: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    bit = mixed % (len(bitmap) * 8)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def bitmap_of(rows: DataFrame, number: Column) -> np.ndarray:
    """Bits of the numbers; ``BITS`` of them at most reach the driver."""
    bit = F.pmod(number, F.lit(BITS)) + 1
    parts = (rows.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect())
    out = np.zeros(BITS // 8, np.uint8)
    for row in parts:
        at = (row["bucket"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def frequent_phrases(
    docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, every: int = EVERY
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of the phrases of 1 to ``longest`` words with at least ``least``
    occurrences, and (lang, n) with the number of words."""
    spark = docs.sparkSession
    entries = stored(dictionary(docs, every=every), "chunks")

    def level(counts: DataFrame) -> DataFrame:
        total = counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        return stored(total.where((F.col("f") >= least) | (F.col("phrase") == "")), "phrases")

    words = level(word_counts(entries))
    totals = words.where("phrase = ''").select("lang", F.col("f").alias("n"))
    words = words.where("phrase <> ''")
    bits = spark.sparkContext.broadcast(bitmap_of(words, F.crc32("phrase") * _FIRST + F.crc32("lang") * _LANG))
    cells = pair_cells(entries, bits).groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    bits = spark.sparkContext.broadcast(bitmap_of(cells, F.col("cell")))
    longer = level(phrase_counts(entries, bits, longest))
    size = F.length("phrase") - F.length(F.translate("phrase", " ", "")) + 1
    return words.unionByName(longer).withColumn("size", size.cast("int")), totals


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(15,0)")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, top: int = TOP,
    longest: int = LONGEST, every: int = EVERY,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases.

    ``a`` is the number of occurrences, ``l`` and ``r`` those of the two parts at the cut of the
    lowest score (the earliest of equal ones), ``n`` the language's words, and ``score`` is
    floor(1000 a n / (l r)). Phrases that stand in a longer candidate of as many occurrences are
    left out. Null texts are empty, a null language is ``und``; rows repeat as often as they do;
    an empty table gives no rows; other columns are ignored. Counts below 10^15 are exact.
    Runs while it is called: the dictionary and the counts of each level are stored.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"chunks share the words that phrases of 2 to {LONGEST} words need")
    docs = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    phrases, totals = frequent_phrases(docs, least, longest, every)
    candidates = phrases.where("size > 1").withColumnRenamed("f", "a")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    parts = candidates.select("lang", "phrase", "a", cut, "size").select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"))
    both = (parts.join(phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
            .join(totals, "lang"))
    product = F.lit(1000).cast("decimal(4,0)") * (_exact("a") * _exact("n"))
    scored = both.withColumn("whole", product).withColumn("parts", _exact("l") * _exact("r")).withColumn(
        "score", F.expr("whole div parts"))
    # The counts of each cut side by side, so that the grouping holds nothing but numbers.
    cuts = range(1, longest)
    flat = scored.groupBy("lang", "phrase", "a", "n").agg(
        *[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}") for k in cuts for c in ("score", "l", "r")])
    best = F.array_min(F.filter(
        F.array(*[F.struct(F.col(f"score{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                           F.col(f"r{k}").alias("r")) for k in cuts]), lambda c: c["score"].isNotNull()))
    # A longer candidate has at most as many occurrences, and all candidates between have no
    # fewer than it: to look one word further is enough.
    within = candidates.where("size > 2").select("lang", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))).alias("phrase"), "a")
    longer = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = (flat.withColumn("cut", best).join(longer, ["lang", "phrase"], "left")
            .where(F.coalesce("longer", F.lit(0)) < F.col("a"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = top_n_per_group(stored(kept, "collocations"), ["lang"], order, ["phrase"], top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return first.select("lang", rank.alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = f"""
with lowered as (
  select coalesce(lang, '{UNKNOWN}') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
pieces as (
  select lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) as piece from lowered),
lists as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
phrases as (
  select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, m, count(*) as f
  from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i
        from lists, (select unnest(range(1, {LONGEST + 1})) as m) where len(w) >= m) group by all),
totals as (select lang, sum(f)::bigint as n from phrases where m = 1 group by lang),
frequent as (select * from phrases where f >= {LEAST_COUNT}),
candidates as (select lang, phrase, m, f as a, string_split(phrase, ' ') as w from frequent where m > 1),
cuts as (
  select lang, phrase, a, k, array_to_string(w[1:k], ' ') as first, array_to_string(w[k + 1:], ' ') as rest
  from (select *, unnest(range(1, m)) as k from candidates)),
scored as (
  select c.lang, c.phrase, a, k, x.f as l, y.f as r, n,
         ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join frequent x on x.lang = c.lang and x.phrase = c.first
  join frequent y on y.lang = c.lang and y.phrase = c.rest join totals t on t.lang = c.lang),
lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_phrases as (
  select distinct d.lang, array_to_string(d.w[i:i + s - 1], ' ') as phrase, d.a
  from (select *, unnest(range(1, m - s + 2)) as i from (select *, unnest(range(2, m)) as s from candidates)) d),
left_out as (
  select distinct c.lang, c.phrase from candidates c join inner_phrases i using (lang, phrase) where 100 * i.a >= 100 * c.a),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
         phrase, a, l, r, n, score
  from lowest anti join left_out using (lang, phrase))
select * from ranked where rank <= {TOP}"""
