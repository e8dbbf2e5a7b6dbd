"""Quality rules, language, personal data, near-duplicates, repeated passages, against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from feedlens.llm import fertility, language, near_dedup, personal_data, suffix_dedup
from feedlens.llm.common import documents
from feedlens.llm.components import components
from feedlens.llm.induced_sort import suffix_array

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, n_words string, elements int, spans string"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "x", 1, "y") for i, t in texts], SCHEMA)


# ---- Quality ------------------------------------------------------------------------

def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def odd_texts():
    rnd = random.Random(3)
    words = ["a", "bc", "#*", "é", "\x1c", "\xa0", "d|e", "日本"]
    texts = [None, "", " \n\t", "a\n\n b\na\n", "x " * 40000]
    for _ in range(150):
        texts.append("".join(rnd.choice(words) + rnd.choice([" ", "\n", "  ", "\x0b", "\r\n"])
                             for _ in range(rnd.randint(0, 60))))
    return list(enumerate(texts))


def test_base_measures_equal_a_plain_count(spark):
    texts = odd_texts()
    rows = fertility.quality(table(spark, texts + texts[:3])).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        want = plain_quality(dict(texts)[r["doc_id"]])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_quality_query_and_measures(spark):
    from feedlens.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect()}
    model = fertility.pieces(fertility.vocabulary(fertility.VOCABULARY)).model
    for r in QUERIES["op5_quality"](spark, SF).collect():
        want = plain_quality(docs[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        ids = [i for w in re.findall(r"[^\x20\x09-\x0D]+", docs[r["doc_id"]]) for i in model.encode(w)]
        counts = np.array(list(collections.Counter(ids).values())) / max(1, len(ids))
        assert r["n_tokens"] == len(ids)
        assert r["entropy"] == pytest.approx(-(counts * np.log2(counts)).sum(), abs=1e-9)
        assert r["byte_share"] == pytest.approx(np.mean([model.is_byte(i) for i in ids]) if ids else 0)


def test_fences_reject_the_odd_document_and_keep_the_rest(spark):
    rnd = random.Random(1)
    words = "the of and to in is it on as at by we he or an be do if so up".split()
    texts = [(i, " ".join(rnd.choice(words) + rnd.choice(words) for _ in range(60))) for i in range(200)]
    texts.append((200, " ".join("".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(4)) for _ in range(60))))
    got = {r["doc_id"]: r["kept"] for r in fertility.quality(table(spark, texts)).collect()}
    assert not got[200] and sum(got[i] for i in range(200)) >= 198
    kept = fertility.kept_documents(table(spark, texts))
    assert kept.columns == table(spark, []).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, k in got.items() if k}


def test_scripts():
    assert fertility.script_of("hello wörld") == "latin"
    assert fertility.script_of("привет мир") == "cyrillic"
    assert fertility.script_of("日本語の") in ("han", "kana")
    assert fertility.script_of("ሰላም") == "ethiopic"
    assert fertility.script_of("") == "latin"


# ---- Language ------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    from feedlens.llm.queries import QUERIES

    docs = {r["doc_id"]: r for r in documents(spark, SF).collect()}
    rows = QUERIES["op1_language"](spark, SF).collect()
    assert len(rows) == len(docs)
    import zlib
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([docs[r["doc_id"]]["lang"] == r["lang_pred"] for r in held]) > 0.95


def test_language_of_odd_texts(spark):
    texts = [(i, t) for i, t in enumerate([None, "", "123 !?", "²Ⅷ", "the and of", "der und die", "É" * 70000])]
    labelled = spark.createDataFrame(
        [(1, "the and of is", "en"), (2, "der und die ist", "de"), (3, None, "fr"), (4, "x", None)],
        "doc_id bigint, text string, lang string")
    model = language.fit(labelled)
    assert model.languages == ["de", "en"]
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(table(spark, texts), model).collect()}
    assert [got[i] for i in range(6)] == ["und", "und", "und", "und", "en", "de"]
    assert got[6] in model.languages


def test_every_labelled_language_is_learned(spark):
    rnd = random.Random(4)
    words = {f"l{k:02}": ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]
             for k in range(80)}
    texts = lambda n: [(" ".join(rnd.choice(w) for _ in range(30)), lang) for lang, w in words.items() for _ in range(n)]
    labelled = spark.createDataFrame([(i, *r) for i, r in enumerate(texts(6))], "doc_id bigint, text string, lang string")
    model = language.fit(labelled)
    assert model.languages == sorted(words)
    new = texts(1)
    names, _ = model.predict([t for t, _ in new])
    assert np.mean([a == b for a, (_, b) in zip(names, new)]) > 0.95


def test_no_labels_and_no_rows(spark):
    none = table(spark, [])
    model = language.fit(none)
    assert language.predict(none, model).collect() == []
    assert language.predict(table(spark, [(1, "abc")]), model).first()["lang_pred"] == "und"


def test_stretches_find_the_same_grams():
    text = "".join(random.Random(2).choice("abcdef ") for _ in range(3000))
    whole = set(np.concatenate(language.gram_buckets(text)))
    old, language.STRETCH = language.STRETCH, 100
    try:
        assert set(np.concatenate(language.gram_buckets(text))) == whole
    finally:
        language.STRETCH = old


# ---- Personal data -------------------------------------------------------------------

PATTERNS = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2:
                doubled = [d * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(d - 9 if d > 9 else d for d in doubled) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rnd = random.Random(5)
    signs = ["a", "B", "@", "@", ".", ".", "-", "+", "1", "25", "255", "256", "0", " ", "(", ")", "_", "é", "\n",
             "4111 1111 1111 1111", "1.2.3.4", "x@y.z", "%", "4111111111111111", "+1 (212) 555-0187", "٣"]
    for _ in range(5000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 24)))
        assert personal_data.base_spans(text) == plain_spans(text), text


def test_personal_data_query(spark):
    from feedlens.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in documents(spark, SF).collect()}
    rows = QUERIES["op2_personal_data"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_spans(docs[r["doc_id"]])
        listed = ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for k, *_ in base) for i in range(4)]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def test_the_field_finds_what_the_patterns_miss_and_leaves_plain_text_alone():
    tagger = personal_data.default_tagger()
    texts = ['my token = "8f14e45fceea167a5a36dedd4bea2543" ok', "phone: (415) 555-0134 or write",
             "The talk of 3 March 2021 had 120 guests in 4 rooms.", "version 3.1.4 of 2020"]
    found = [[(personal_data.KINDS[k], t[a:b]) for k, a, b in every]
             for t, (_, every) in zip(texts, personal_data.find(texts, tagger))]
    assert found[0] == [("secret", "8f14e45fceea167a5a36dedd4bea2543")]
    assert found[1] == [("phone", "(415) 555-0134")]
    assert found[2] == found[3] == []


def test_disguised_addresses_without_a_digit_are_found_and_masked(spark):
    texts = ["reach me at pierre.dupont at exemple.example.fr please", "write to jane (at) example (dot) com for details",
             "We met at the station at noon and talked.", "The talk is at Example Hall. People at large stayed at sea."]
    found = [[(personal_data.KINDS[k], t[a:b]) for k, a, b in every]
             for t, (_, every) in zip(texts, personal_data.find(texts, personal_data.default_tagger()))]
    assert found == [[("email", "pierre.dupont at exemple.example.fr")], [("email", "jane (at) example (dot) com")], [], []]
    out = {r["doc_id"]: r["text"] for r in personal_data.mask(table(spark, list(enumerate(texts)))).collect()}
    assert out == {0: "reach me at <EMAIL> please", 1: "write to <EMAIL> for details", 2: texts[2], 3: texts[3]}


def test_viterbi_equals_the_best_of_all_paths():
    import itertools

    rng = np.random.default_rng(0)
    k = len(personal_data.LABELS)
    move = rng.normal(size=(k, k)) + personal_data.allowed()
    scores = rng.normal(size=(2, 3, k)) * 2
    for row, length in enumerate((3, 2)):
        best = max(itertools.product(range(k), repeat=length), key=lambda p: (
            personal_data.allowed()[0][p[0]] + sum(scores[row, t, x] for t, x in enumerate(p))
            + sum(move[x, y] for x, y in zip(p, p[1:]))))
        assert tuple(personal_data.viterbi(scores, np.array([3, 2]), move)[row]) == best


def test_masking(spark):
    texts = [(1, "mail a@b.co now"), (2, None), (3, ""), (4, "call +1 (212) 555-0187"), (4, "nothing")]
    df = table(spark, texts)
    out = personal_data.mask(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["text"] is not None) == [
        (1, "mail <EMAIL> now"), (3, ""), (4, "call <PHONE>"), (4, "nothing")]
    assert personal_data.personal_data(table(spark, [])).collect() == []
    assert personal_data.masked("abcdef", [(0, 1, 4), (2, 2, 5)]) == "a<EMAIL>f"


def test_long_odd_texts_end_soon():
    tagger = personal_data.default_tagger()
    personal_data.find(["1" * 50000 + " " + "a" * 50000 + " 1.1" * 5000, "x@" * 20000, "+1 " * 20000], tagger)


# ---- Near-duplicates -----------------------------------------------------------------

def plain_classes(texts, least=0.8):
    def elements(text):
        words = [w for w in re.split(r"[ \t\n\r\x0b\x0c]+", (text or "").lower()) if w]
        n = max(1, len(words) - 4) if words else 0
        return collections.Counter(tuple(words[i:i + 5]) for i in range(n))

    sets = [(i, elements(t)) for i, t in texts]
    parent = {i: i for i, _ in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = sum((a & b).values())
            if both and both >= least * sum((a | b).values()) - 1e-9:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i, _ in texts}


def near_texts():
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(3, 160))]
        for _ in range(rnd.randint(1, 6)):
            copy = list(words)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(" ".join(copy))
    rnd.shuffle(texts)
    return list(enumerate(texts + [None, "", " ", "one two", "ONE two", "one  two\n", "a b c d e " * 40, "a b c d e " * 39]))


def test_classes_equal_brute_force(spark):
    texts = near_texts()
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(table(spark, texts)).collect()}
    assert got == plain_classes(texts)


def test_near_dedup_query_equals_brute_force(spark):
    from feedlens.llm.queries import QUERIES

    texts = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    rows = QUERIES["op9_near_dedup"](spark, SF).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == plain_classes(texts)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in rows)


def test_blocks_join_what_a_star_misses(spark, monkeypatch):
    """A chain: neighbours are similar, the ends are not, and one group holds them all."""
    monkeypatch.setattr(near_dedup, "FEW", 2)
    monkeypatch.setattr(near_dedup, "MANY", 3)
    sets = [np.array(sorted(set(range(i, i + 100)))) for i in range(0, 60, 6)]
    groups = spark.createDataFrame([(1, i, i) for i in range(10)], "key bigint, node bigint, label bigint")
    elements = spark.createDataFrame([(i, None, s.tolist()) for i, s in enumerate(sets)],
                                     "node bigint, words binary, elements array<bigint>")
    links = near_dedup.links_in_blocks(groups, elements, 0.8)
    assert {r["label"] for r in components(links, "a", "b").collect()} == {0}


def test_one_of_each_keeps_columns_and_one_row_per_id(spark):
    texts = [(1, "a b c d e f"), (2, "A b c d e f"), (3, "x"), (3, "x"), (4, None), (None, "a b c d e f"), (5, "")]
    df = table(spark, texts)
    out = near_dedup.one_of_each(df)
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "3", "4", "5", "None"]
    assert near_dedup.classes(table(spark, [])).collect() == []


def test_texts_of_one_id_are_one_document(spark):
    texts = [(1, "a b c d e"), (2, "a b c d e"), (2, "q r s t u"), (3, "q r s t u")]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(table(spark, texts)).collect()}
    assert got == {1: 1, 2: 1, 3: 1}


def test_signatures_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(0)
    agreed, true = [], []
    for _ in range(40):
        a = rng.integers(0, 2**60, 300).astype(np.uint64)
        b = a.copy()
        b[:60] = rng.integers(0, 2**60, 60)
        x, y = near_dedup.dart_signatures([near_dedup.weighted(a), near_dedup.weighted(b)], [256.0, 256.0])
        agreed.append((x == y).mean())
        true.append(240 / 360)
    assert abs(np.mean(agreed) - np.mean(true)) < 0.03


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7), (None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# ---- Repeated passages ---------------------------------------------------------------

def plain_removal(rows):
    first = {}
    for doc, text in rows:
        for i in range(len(text) - 49) if doc is not None else ():
            first[text[i:i + 50]] = min(doc, first.get(text[i:i + 50], doc))
    out = []
    for doc, text in rows:
        gone = bytearray(len(text))
        for i in range(len(text) - 49) if doc is not None else ():
            if first[text[i:i + 50]] < doc:
                gone[i:i + 50] = b"\1" * 50
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((doc, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeated_texts():
    rnd = random.Random(2)
    base = "".join(rnd.choice("ab") for _ in range(400))
    texts = [(i, "".join(base[(a := rnd.randint(0, 300)):a + rnd.randint(20, 99)] for _ in range(rnd.randint(0, 5)))
              + rnd.choice(["", "a" * 120, "xyz\0\0", "é" * 70])) for i in range(120)]
    return texts + [(5, "a" * 200), (5, "b" * 60 + base[:80]), (9, None), (None, base), (3, ""), (700, base),
                    (701, base), (701, base)]


@pytest.mark.parametrize("hot", [4096, 1])
def test_removal_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_EDGES", 500)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 5000)
    texts = repeated_texts()
    if hot == 1:
        def met_hot(part):  # workers import the module anew, so the limit travels with the function
            from feedlens.llm import suffix_dedup as own

            old, own.HOT_CONTEXTS = own.HOT_CONTEXTS, 1
            try:
                return own.met(part)
            finally:
                own.HOT_CONTEXTS = old

        monkeypatch.setattr(suffix_dedup, "met", met_hot)
    got = sorted(map(tuple, suffix_dedup.removal_digests(table(spark, texts)).collect()), key=str)
    assert got == plain_removal([(i, (t or "").encode()) for i, t in texts])


def sent_rows(spark, texts):
    blocks = suffix_dedup.sent_blocks(spark.createDataFrame(
        [(i, 0, t) for i, t in texts], "doc bigint, copy int, text string"), 1).collect()
    return sum(len(suffix_dedup.unpack_block(bytes(r["block"]), 4)[0]) for r in blocks)


def test_runs_of_short_periods_send_each_context_once(spark):
    lines = ("-" * 79 + "\n") * 2000
    texts = [(3, "x" + "0" * 30000 + "y"), (1, "0" * 20000), (2, "ab" * 9000), (7, "ab" * 300 + "q"), (5, lines),
             (6, "begin " + lines[:9000] + " end"), (8, "0" * 60 + "abab" * 30 + "-" * 70)]
    assert sent_rows(spark, [t for t in texts if t[0] in (1, 2, 3, 5)]) < 600
    got = sorted(map(tuple, suffix_dedup.removal_digests(table(spark, texts)).collect()), key=str)
    assert got == plain_removal([(i, t.encode()) for i, t in texts])


def test_no_gram_of_very_many_documents_sits_in_one_part(spark, monkeypatch):
    rnd = random.Random(6)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    own = lambda n: "".join(rnd.choice("mnopqrst ") for _ in range(n))
    texts = [(i, own(60) + passage + own(60)) for i in range(300)]
    texts += [(300 + i, own(70) + passage[:40] + own(70)) for i in range(300)]
    docs = spark.createDataFrame([(i, 0, t) for i, t in texts], "doc bigint, copy int, text string").repartition(2)
    monkeypatch.setattr(suffix_dedup, "SAMPLE_SHARE", 1)
    monkeypatch.setattr(suffix_dedup, "SAMPLE_HOT", 100)
    hot = suffix_dedup.hot_grams(docs)
    assert 5 < len(hot) < 60
    most = {}
    for r in suffix_dedup.sent_blocks(docs, 8, hot).collect():
        if r["part"] >= 0:
            for gram in suffix_dedup.unpack_block(bytes(r["block"]), 4)[0]:
                most[r["part"], gram] = most.get((r["part"], gram), 0) + 1
    assert max(most.values()) < 150
    for size in (5000, 8 << 20):
        monkeypatch.setattr(suffix_dedup, "PART_BYTES", size)
        got = sorted(map(tuple, suffix_dedup.removal_digests(table(spark, texts)).collect()), key=str)
        assert got == plain_removal([(i, t.encode()) for i, t in texts])


def test_parts_are_even(spark):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(200_000))
    docs = spark.createDataFrame([(1, 0, text)], "doc bigint, copy int, text string")
    sizes = [len(suffix_dedup.unpack_block(bytes(r["block"]), 4)[0]) for r in suffix_dedup.sent_blocks(docs, 40).collect()]
    assert len(sizes) == 40 and max(sizes) < 1.5 * np.mean(sizes)


def found_marks(spark, texts):
    docs = spark.createDataFrame([(i, 0, t) for i, t in texts], "doc bigint, copy int, text string").coalesce(1)
    return suffix_dedup.met(suffix_dedup.sent_blocks(docs, 1).where("part >= 0").toArrow()).to_pylist()


def test_grams_that_meet_by_chance_are_no_edges(spark):
    rnd = random.Random(12)
    own = lambda n: "".join(rnd.choice("mnopqrst ") for _ in range(n))
    with_part = lambda part: [(i, own(60) + part + own(60)) for i in range(40)]
    passage = "abcdefgh ijkl 0123456789 xyzuv ABCDEFGH IJKL 9876543210 XYZUV"
    assert found_marks(spark, with_part(passage[:30])) == []  # holds whole grams, no equal windows
    edges = [m for m in found_marks(spark, with_part(passage[:52])) if m["kind"] == suffix_dedup.EDGE]
    assert {m["doc"] for m in edges} == set(range(40))


def test_passages_about_as_long_as_a_window(spark, monkeypatch):
    rnd = random.Random(13)
    own = lambda n: "".join(rnd.choice("mnopqrst ") for _ in range(n))
    passages = [own(70) for _ in range(12)]
    texts = [(i, "".join(own(rnd.choice([0, 3, 40])) + p[(a := rnd.randint(0, 20)):a + rnd.randint(46, 60)]
                         for p in rnd.sample(passages, 3)) + own(rnd.choice([0, 9]))) for i in range(150)]
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 5000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 5000)
    monkeypatch.setattr(suffix_dedup, "SHARD_EDGES", 100)
    got = sorted(map(tuple, suffix_dedup.removal_digests(table(spark, texts)).collect()), key=str)
    want = plain_removal([(i, t.encode()) for i, t in texts])
    assert got == want and 100 < sum(r[3] for r in want)


def test_a_task_sends_one_block_for_a_part(spark):
    rnd = random.Random(14)
    docs = spark.createDataFrame([(i, 0, rnd.randbytes(250_000).hex()) for i in range(10)],
                                 "doc bigint, copy int, text string").coalesce(1)
    assert suffix_dedup.sent_blocks(docs, 8).count() == 8


def test_whole_copies_are_one_row_of_spans(spark):
    text = random.Random(15).randbytes(20_000).hex()
    docs = spark.createDataFrame([(i, 0, text) for i in range(3)], "doc bigint, copy int, text string")
    assert sorted(r["doc"] for r in suffix_dedup.repeats(docs).collect()) == [1, 2]


def test_all_grams_hot_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SAMPLE_SHARE", 1)
    monkeypatch.setattr(suffix_dedup, "SAMPLE_HOT", 2)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 5000)
    texts = repeated_texts() + [(-4, "a" * 90), (-5, "b" * 70 + "a" * 60)]
    got = sorted(map(tuple, suffix_dedup.removal_digests(table(spark, texts)).collect()), key=str)
    assert got == plain_removal([(i, (t or "").encode()) for i, t in texts])


def test_suffix_query_equals_brute_force(spark):
    from feedlens.llm.queries import QUERIES

    texts = [(r["doc_id"], r["text"].encode()) for r in documents(spark, SF).collect()]
    got = sorted(map(tuple, QUERIES["op7_suffix_dedup"](spark, SF).collect()), key=str)
    assert got == plain_removal(texts)


def test_without_repeats(spark):
    passage = "é" * 30 + "0123456789" * 3
    df = table(spark, [(1, "first " + passage), (2, passage + " second"), (3, None), (4, "short")])
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        1: "first " + passage, 2: " second", 3: None, 4: "short"}
    assert suffix_dedup.removal_digests(table(spark, [])).collect() == []


def test_suffix_arrays():
    rnd = random.Random(1)
    for _ in range(600):
        k = rnd.choice([1, 2, 3, 5, 250])
        s = [rnd.randrange(k) for _ in range(rnd.randint(0, 60))]
        assert suffix_array(np.array(s, np.int64), k + 1).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_blocks_unpack_to_what_went_in():
    columns = [np.arange(5, dtype=np.uint64) * np.uint64(7**20), np.ones(5, np.uint64)]
    back = suffix_dedup.unpack_block(suffix_dedup.pack_block(columns), 2)
    assert all((a == b).all() for a, b in zip(columns, back))
