"""Near-duplicate documents by DartMinHash over weighted word shingles (operator 9).

The elements of a text are its runs of five words, weighted by how often they occur; texts
of at most four words have one element. Two texts are linked if their weighted Jaccard
similarity is at least 0.8; documents joined by links form a class.

Signatures come from darts: hashed darts fall into the weight-by-rank area of each element,
those under the element's weight count, and each coordinate keeps its earliest dart. Banded
coordinates propose pairs, and every proposed pair is verified on its elements. A group of
documents that share a band is compared with its first member, and among the others only
where their classes still differ, so that a large group of copies costs one comparison each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import Recent, arrow_map, free_name, kept_in_worker
from feedlens.llm.components import components
from feedlens.session import stored

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Two texts of similarity 0.8 share none of the bands with probability (1 - 0.8^5)^25 = 5e-5.
BANDS, BAND_ROWS = 25, 5
COORDINATES = BANDS * BAND_ROWS
#: Darts expected over an area of one: enough to reach nearly every coordinate.
DARTS = int(COORDINATES * np.log(COORDINATES) + 2 * COORDINATES)

#: Bytes of parts that a worker remembers at least, and half of what it does at most.
REMEMBERED = 96 << 20
#: Signatures made at a time.
TOGETHER = 8
#: Members of a group that one unit of work compares with each other, and elements at a time.
FEW, MANY, COLUMNS = 1024, 1024, 4096

_U = np.uint64
_POISSON = np.cumsum([np.exp(-1) / np.prod(np.arange(1, k + 1), dtype=float) for k in range(16)])


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers from 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0 ** -53


class WordHashes(Recent):
    """Hash of each word (UTF-8)."""

    def compute(self, word: bytes) -> bytes:
        return xxhash.xxh3_64_digest(word)


def known_words() -> WordHashes:
    return kept_in_worker("word hashes", lambda: WordHashes(REMEMBERED))


def word_hashes(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of each text's lower-case words."""
    known = known_words().__getitem__
    return [np.frombuffer(b"".join(map(known, t.lower().encode().split())), "<u8")
            for t in pc.fill_null(texts, "").to_pylist()]


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of five words, with repeats; texts of one to four words have a
    single one of all words, texts without words none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    mixed = np.full(n, _U(min(len(words), SHINGLE_WORDS)))
    for j in range(min(len(words), SHINGLE_WORDS)):
        mixed = _mix(mixed + words[j:n + j] * _U(2 * j + 1))
    return mixed


def weighted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct elements and their weights."""
    return np.unique(hashes, return_counts=True)


def numbered(hashes: np.ndarray) -> np.ndarray:
    """The elements with repeats told apart by number, sorted: the weighted Jaccard similarity
    of two texts is the plain one of these sets."""
    ordered = np.sort(hashes)
    if not len(ordered):
        return ordered
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    number = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.r_[starts, len(ordered)]))
    return np.sort(_mix(ordered + number.astype(np.uint64) * _U(0x9E3779B97F4A7C15)))


def dart_signatures(
    texts: list[tuple[np.ndarray, np.ndarray]], scales: list[float],
) -> np.ndarray:
    """Earliest dart of each coordinate, one row for each text's (elements, weights).

    An element's weight over the text's scale times ``DARTS`` is the height of its area, cut
    into unit cells by height and unit rounds by rank. A cell holds a Poisson number of darts,
    each with a hashed height, rank and coordinate; those above the element's height do not
    count. Rounds go on until each coordinate has a dart; later rounds only have later ranks.
    """
    elements = np.concatenate([e for e, _ in texts])
    heights = np.concatenate([w * (DARTS / s) for (_, w), s in zip(texts, scales)])
    text = np.repeat(np.arange(len(texts)), [len(e) for e, _ in texts])
    cells = np.ceil(heights).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), cells)
    level = np.arange(len(owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    seeds = _mix(elements[owner] + _mix(level.astype(np.uint64) + _U(0xD1B54A32D192ED03)))
    room = heights[owner] - level  # 1 or more inside, the rest of the height in the last cell
    at = text[owner] * COORDINATES
    best = np.full(len(texts) * COORDINATES, _U(0xFFFFFFFFFFFFFFFF))
    step = 0
    while True:
        base = _mix(seeds + _U(step) * _U(0xA0761D6478BD642F))
        count = np.searchsorted(_POISSON, _unit(base))
        cell = np.repeat(np.arange(len(base)), count)
        nth = np.arange(len(cell)) - np.repeat(np.cumsum(count) - count, count)
        dart = _mix(base[cell] + (nth.astype(np.uint64) + _U(1)) * _U(0xE7037ED1A0B428DB))
        under = _unit(dart) < room[cell]
        # The number itself is the dart's rank within the round, its low half the coordinate.
        rank = _mix(dart[under] + _U(0x8EBC6AF09C88C6E3))
        place = at[cell[under]] + ((rank & _U(0xFFFFFFFF)) % _U(COORDINATES)).astype(np.int64)
        found = np.full(len(best), _U(0xFFFFFFFFFFFFFFFF))
        np.minimum.at(found, place, rank)
        missing = best == _U(0xFFFFFFFFFFFFFFFF)
        best[missing] = found[missing]
        lacks = (best == _U(0xFFFFFFFFFFFFFFFF)).reshape(len(texts), COORDINATES).any(axis=1)
        if not lacks.any():
            return best.reshape(len(texts), COORDINATES)
        go_on = lacks[at // COORDINATES]
        seeds, room, at = seeds[go_on], room[go_on], at[go_on]
        step += 1


def band_keys(texts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Hashes of the bands of each text's signatures, for (elements, weights) with elements.

    The areas are drawn to a scale, the power of two below the total weight. Linked texts
    differ in weight by the similarity at most; a text that is so close above its scale also
    gets a signature to the scale below, so linked texts share a scale.
    """
    signed, powers, owner = [], [], []
    for i, (elements, weights) in enumerate(texts):
        total = int(weights.sum())
        power = total.bit_length() - 1
        for p in [power] + ([power - 1] if total * SIMILARITY < 1 << power else []):
            signed.append((elements, weights))
            powers.append(p)
            owner.append(i)
    keys: list[list[np.ndarray]] = [[] for _ in texts]
    for start in range(0, len(signed), TOGETHER):
        scales = [2.0 ** p for p in powers[start:start + TOGETHER]]
        rows = dart_signatures(signed[start:start + TOGETHER], scales)
        for j, row in enumerate(rows.reshape(len(rows), BANDS, BAND_ROWS), start):
            mixed = np.arange(BANDS, dtype=np.uint64) + _U((powers[j] + 100) << 32)
            for r in range(BAND_ROWS):
                mixed = _mix(mixed + row[:, r] * _U(2 * r + 1))
            keys[owner[j]].append(mixed)
    return [np.concatenate(k).view(np.int64) for k in keys]


def alike(first: pa.ListArray, second: pa.ListArray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the sets of ``first`` and ``second`` with a Jaccard similarity of
    ``least``: overlaps by products of incidence matrices, some elements at a time."""
    flat = np.concatenate([first.flatten().to_numpy(), second.flatten().to_numpy()])
    sizes = [np.diff(x.offsets.to_numpy()) for x in (first, second)]
    owner = np.repeat(np.arange(len(first) + len(second)), np.concatenate(sizes))
    column = np.unique(flat, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(first), len(second)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(first) + len(second), COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        both += held[:len(first)] @ held[len(first):].T
    union = sizes[0][:, None] + sizes[1][None, :] - both.astype(float)
    return np.nonzero(both >= least * union - 1e-9)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, words, bands): id, digest of the word sequence (null without words), band keys."""
    def start():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = word_hashes(batch.column(1))
            words = [word_digest(t) for t in texts]
            found = iter(band_keys([weighted(shingles(t)) for t in texts if len(t)]))
            keys = [next(found) if len(t) else None for t in texts]
            return [batch.column(0).cast(pa.int64()), pa.array(words, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64()))]
        return step

    return arrow_map(docs.select(id_col, text_col), "id bigint, words binary, bands array<bigint>", start)


def word_digest(words: np.ndarray) -> bytes | None:
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest() if len(words) else None


def elements_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, words, elements): the numbered elements of each text that has words."""
    def start():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = word_hashes(batch.column(1))
            return [batch.column(0).cast(pa.int64()), pa.array([word_digest(t) for t in texts], pa.binary()),
                    pa.array([numbered(shingles(t)).view(np.int64) for t in texts], pa.list_(pa.int64()))]
        return step

    return arrow_map(docs.select(id_col, text_col), "node bigint, words binary, elements array<bigint>", start)


def verified(pairs: DataFrame, elements: DataFrame, least: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are similar, by the elements themselves."""
    one = elements.select(F.col("node").alias("a"), F.col("elements").alias("of_a"))
    two = elements.select(F.col("node").alias("b"), F.col("elements").alias("of_b"))
    rows = pairs.join(one, "a").join(two, "b")
    n_a, n_b = F.size("of_a"), F.size("of_b")
    sizes = F.least(n_a, n_b) >= least * F.greatest(n_a, n_b) - 1e-9
    both = F.size(F.array_intersect("of_a", "of_b"))
    return rows.where(sizes & (both >= least * (n_a + n_b - both) - 1e-9)).select("a", "b").distinct()


def open_groups(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, label) of the groups whose members are not all in one class."""
    named = groups.join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label"))
    split = (named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
             .where("x < y").select("key"))
    return named.join(split, "key", "left_semi")


def links_in_blocks(groups: DataFrame, elements: DataFrame, least: float) -> DataFrame:
    """Links between members of a group (columns key, node, label) whose labels differ.

    Of two such members one is outside the group's most frequent label. These are cut into
    blocks of ``FEW`` and all members into blocks of ``MANY``, and each pair of blocks is one
    unit of work that compares what is not yet joined, so no task holds a group and pairs are
    never rows. Enough links come out to join what belongs together.
    """
    sizes = groups.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("top"))
    cut = groups.join(sizes.select(
        "key", F.col("top.label").alias("main"), F.ceil(F.col("all") / MANY).cast("int").alias("many"),
        F.ceil((F.col("all") - F.col("top.n")) / FEW).cast("int").alias("few")), "key")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = cut.where("label <> main").select("key", own("few").alias("x"), each("many").alias("y"), "node", "label")
    two = cut.select("key", each("few").alias("x"), own("many").alias("y"), "node", "label")
    with_sets = elements.select("node", "elements")

    def compare(some: pa.Table, others: pa.Table) -> pa.Table:
        first, second = (t.column("elements").combine_chunks() for t in (some, others))
        rows, columns = alike(first, second, least)
        nodes, labels = ([t.column(c).to_pylist() for t in (some, others)] for c in ("node", "label"))
        parent = {x: x for x in labels[0] + labels[1]}

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found = []
        for i, j in zip(rows.tolist(), columns.tolist()):
            if (p := find(labels[0][i])) != (q := find(labels[1][j])):
                parent[p] = q
                found.append((nodes[0][i], nodes[1][j]))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    one, two = (side.join(with_sets, "node") for side in (one, two))
    two = two.select(*[F.col(c).alias(c) for c in two.columns])  # both come from the same tables
    return (one.groupBy("key", "x", "y").cogroup(two.groupBy("key", "x", "y"))
            .applyInArrow(compare, "a bigint, b bigint").distinct())


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY,
) -> DataFrame:
    """(doc_id, class_id, kept): one row per row of ``docs``. ``class_id`` is the smallest id
    of the class, and ``kept`` says that the row has it.

    Words are lower-cased and split at ASCII white space; texts of equal words are copies and
    are compared once. A null, empty or blank text is a class of its own. Rows of one id are
    one document: the classes of their texts are joined. A null id has no class and stays
    (``kept``). An empty table gives no rows; columns besides the named are ignored. Writes
    its intermediate tables while it is called.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id_"), F.col(text_col).alias("text_"))
    signed = stored(signatures(rows, "id_", "text_"), "dart-signatures")
    worded = signed.where(F.col("words").isNotNull() & F.col("id").isNotNull())
    first = worded.groupBy("words").agg(F.min("id").alias("node"))
    members = stored(worded.join(first, "words").select(
        "id", "node", F.when(F.col("id") == F.col("node"), F.col("bands")).alias("bands")), "dart-members")

    bands = members.where(F.col("bands").isNotNull()).select("node", F.explode("bands").alias("key")).distinct()
    shared = (bands.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"),
                                       F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("mark"))
              .where(F.col("pivot") < F.col("last")))
    # Bands with the same members propose the same pairs: one of them is enough.
    shared = shared.groupBy("pivot", "last", "n", "mark").agg(F.min("key").alias("key")).select("key", "pivot")
    groups = stored(bands.join(shared, "key"), "dart-groups")

    # Always by shuffle: the ids grow with the input.
    wanted = groups.select(F.col("node").alias("id_")).distinct().hint("merge")
    elements = stored(
        elements_of(rows.join(wanted, "id_", "left_semi"), "id_", "text_").where(F.col("words").isNotNull())
        .dropDuplicates(["node", "words"]), "dart-elements")
    pairs = groups.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    # Texts of one id belong together, whatever they hold.
    own = (members.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
           .where(F.col("a") < F.col("b")).select("a", "b"))
    links = stored(verified(pairs, elements, least).unionByName(own), "dart-links")
    labels = components(links, "a", "b")

    rest = stored(open_groups(groups, labels), "dart-open")
    late = stored(links_in_blocks(rest, elements, least), "dart-links")
    known = labels.select(F.col("label").alias("a"), F.col("node").alias("b"))
    labels = components(known.unionByName(late), "a", "b")

    found = (members.join(labels, "node", "left")
             .groupBy("id").agg(F.min(F.coalesce("label", "node")).alias("class_id")))
    return (signed.select("id").join(found, "id", "left")
            .select(F.col("id").alias("doc_id"), F.coalesce("class_id", "id").alias("class_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True))))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class, one per id, with all columns.
    Rows with a null id stay."""
    found = stored(classes(docs, id_col, text_col, least), "dart-classes")
    name = free_name(docs, "id_")
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    marked = docs.withColumn(name, F.col(id_col).cast("bigint"))
    left = marked.join(gone, name, "left_anti")
    twice = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1")
    if not twice.isEmpty():
        once = left.where(F.col(name).isNotNull()).dropDuplicates([name])
        left = once.unionByName(left.where(F.col(name).isNull()))
    return left.select(*[f"`{c}`" for c in docs.columns])


NEAR_DEDUP_SQL = r"""
with recursive texts as (
  select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') as w from documents),
worded as (select doc_id, w, min(doc_id) over (partition by w) as node from texts where len(w) > 0 and doc_id is not null),
elements as (
  select node, element, count(*) as n from (
    select node, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as element
    from worded where doc_id = node) group by all),
totals as (select node, sum(n) as total from elements group by node),
links as (
  select a.node as a, b.node as b from elements a join elements b on a.element = b.element and a.node < b.node
  join totals x on x.node = a.node join totals y on y.node = b.node
  group by a.node, b.node, x.total, y.total
  having 10 * sum(least(a.n, b.n)) >= 8 * (x.total + y.total - sum(least(a.n, b.n)))),
ways as (select a, b from links union all select b, a from links),
reach as (select distinct a, a as b from ways union select reach.a, ways.b from reach join ways on reach.b = ways.a),
least as (select a as node, min(b) as label from reach group by a),
named as (select doc_id, coalesce(label, node) as class_id from worded left join least using (node))
select doc_id, coalesce(class_id, doc_id) as class_id, coalesce(doc_id = class_id, true) as kept
from texts left join named using (doc_id)"""
