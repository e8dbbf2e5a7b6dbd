"""Personal data by fixed patterns and a linear-chain conditional random field (operator 2).

The patterns give the base spans. The field tags tokens by the shapes around them and adds
spans that the patterns miss. It is trained from the small labelled table and decoded by
Viterbi over padded numpy batches. Entities hold a digit, an at sign, or one written as
" at " or "(at)", so only the tokens near one of these are decoded.
"""

from __future__ import annotations

import functools
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from feedlens.llm.common import arrow_map, kept_in_worker, longs
from feedlens.llm.pii_examples import EXAMPLES

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

RESULT = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
          "base_sha256 string, spans string, n_spans bigint")

# ---- Base patterns ---------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A later start inside a run of digits can match no better than the start of the run.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of name@domain, from one at sign to the next: a name holds none, so
    it is the run of its characters before the sign, as far as the last match leaves it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free))
        else:
            free = max(free, at + 1)
        at = text.find("@", at + 1)
    return found


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _small(number: str) -> bool:
    plain = number.lstrip("0")
    return len(plain) <= 3 and int(plain or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start, in code points."""
    found = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = _NO_DIGITS.sub("", m[0]) if len(m[0]) < 64 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGITS.sub("", m[0])) <= 15]
    return found


# ---- Tokens and shapes ------------------------------------------------------------

_DIGIT = re.compile(r"[0-9]")
_ANCHOR = re.compile(r"[0-9@]|\(at\)| at ")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|[\d_]")
#: Tokens on each side of one with a digit or (written) at sign that are decoded with it.
REACH = 8
#: Buckets for pairs of neighbouring shapes.
PAIRS = 1 << 12
_LETTER_SIZES, _DIGIT_SIZES = (1, 2, 3, 5, 9), (1, 2, 3, 4, 5, 7, 13)
_HEX = frozenset("abcdefABCDEF")


@functools.lru_cache(100_000)
def shape(token: str) -> str:
    """Class of a token: kind of letters or digits with a length class, or the sign itself."""
    if token.isdecimal():
        return f"9{sum(len(token) >= n for n in _DIGIT_SIZES)}"
    if token[0].isalpha():
        case = "x" if token.islower() else "X" if token.isupper() else "Xx" if token.istitle() else "xX"
        return f"{case}{sum(len(token) >= n for n in _LETTER_SIZES)}{'h' if _HEX.issuperset(token) else ''}"
    return token


@dataclass(frozen=True)
class Tokens:
    """Tokens of one stretch of a line: texts, places, and whether each touches the last."""

    words: list[str]
    spans: list[tuple[int, int]]
    glued: list[bool]


def tokens_of(text: str, start: int, end: int) -> Tokens:
    found = [m.span() for m in _TOKEN.finditer(text, start, end)]
    glued = [False] + [a[1] == b[0] for a, b in zip(found, found[1:])]
    return Tokens([text[a:b] for a, b in found], found, glued[:len(found)])


# ---- The field --------------------------------------------------------------------

LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
TEMPLATES = 5


@dataclass(frozen=True)
class Tagger:
    """``shapes`` numbers the shapes seen in training, ``cues`` the words that stand before
    entities; ``emit`` scores features by label, ``move`` pairs of labels."""

    shapes: dict[str, int]
    cues: frozenset[str]
    emit: np.ndarray
    move: np.ndarray

    def features(self, tokens: Tokens) -> np.ndarray:
        """Rows of ``emit`` for each token: shapes from two before to two after with whether
        they touch, pairs of neighbours, and a cue word among the four before."""
        n, size = len(tokens.words), len(self.shapes) + 1
        own = np.array([self.shapes.get(shape(w), size - 1) for w in tokens.words], np.int64)
        touch = np.array(tokens.glued, np.int64)
        pad = np.full(2, size - 1)
        wide, glue = np.concatenate([pad, own, pad]), np.concatenate([[0, 0], touch, [0, 0]])
        rows = [(k * size + wide[k:k + n]) * 2 + glue[k:k + n] for k in range(TEMPLATES)]
        base = TEMPLATES * size * 2
        for k in (1, 2):
            mixed = (wide[k:k + n] * 2 + glue[k + 1:k + 1 + n]) * 1009 + wide[k + 1:k + 1 + n] * 7919 + k
            rows.append(base + mixed % PAIRS)
        cue = np.array([w.lower() in self.cues for w in tokens.words], np.int64)
        near = sum(np.concatenate([np.zeros(k, np.int64), cue])[:n] for k in range(1, 5)) > 0
        rows.append(base + PAIRS + near)
        return np.stack(rows, axis=1)

    def n_features(self) -> int:
        return TEMPLATES * (len(self.shapes) + 1) * 2 + PAIRS + 2

    def decode(self, batch: list[Tokens]) -> list[np.ndarray]:
        """Best labels of each sequence: Viterbi over batches of similar lengths."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(batch)
        order = sorted(range(len(batch)), key=lambda i: len(batch[i].words))
        for at in range(0, len(order), 256):
            some = [i for i in order[at:at + 256] if batch[i].words]
            if not some:
                continue
            lengths = np.array([len(batch[i].words) for i in some])
            scores = np.zeros((len(some), lengths.max(), len(LABELS)))
            for row, i in enumerate(some):
                scores[row, :lengths[row]] = self.emit[self.features(batch[i])].sum(axis=1)
            for row, path in enumerate(viterbi(scores, lengths, self.move)):
                out[some[row]] = path
        return out


def allowed() -> np.ndarray:
    """Log weights that forbid an inside label after any but its own kind."""
    move = np.zeros((len(LABELS), len(LABELS)))
    for j, to in enumerate(LABELS):
        if to[0] == "I":
            for i, before in enumerate(LABELS):
                if before[2:] != to[2:]:
                    move[i, j] = -1e4
    return move


def viterbi(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> list[np.ndarray]:
    """Best paths of padded sequences (batch x time x labels)."""
    n, steps, k = scores.shape
    best = scores[:, 0] + allowed()[0]  # as after an outside token
    back = np.zeros((n, steps, k), np.int16)
    last = np.where((lengths == 1)[:, None], best, 0.0)
    for t in range(1, steps):
        through = best[:, :, None] + move
        back[:, t] = through.argmax(axis=1)
        best = through.max(axis=1) + scores[:, t]
        last = np.where((lengths == t + 1)[:, None], best, last)
    paths = []
    for row in range(n):
        label, path = int(last[row].argmax()), []
        for t in range(lengths[row] - 1, -1, -1):
            path.append(label)
            label = int(back[row, t, label])
        paths.append(np.array(path[::-1]))
    return paths


def labelled(examples: str = EXAMPLES) -> list[tuple[Tokens, np.ndarray]]:
    """Token sequences and label numbers of the labelled table."""
    out = []
    for line in examples.strip().split("\n"):
        text, marks = "", []
        for piece in re.split(r"(\{[a-z]+:[^}]*\})", line):
            if piece.startswith("{"):
                kind, value = piece[1:-1].split(":", 1)
                marks.append((kind, len(text), len(text) + len(value)))
                text += value
            else:
                text += piece
        tokens = tokens_of(text, 0, len(text))
        tags = np.zeros(len(tokens.words), int)
        for kind, a, b in marks:
            inside = [i for i, (x, y) in enumerate(tokens.spans) if a <= x and y <= b]
            tags[inside] = LABELS.index(f"I-{kind}")
            tags[inside[0]] = LABELS.index(f"B-{kind}")
        out.append((tokens, tags))
    return out


def train(rows: list[tuple[Tokens, np.ndarray]], rounds: int = 120, penalty: float = 0.02,
          rate: float = 0.1) -> Tagger:
    """Maximum likelihood with an L2 penalty, by Adam on forward-backward gradients."""
    names = sorted({shape(w) for tokens, _ in rows for w in tokens.words})
    before: dict[str, int] = {}
    for tokens, tags in rows:
        for i in np.flatnonzero(tags):
            if LABELS[tags[i]][0] == "B":
                for w in {w.lower() for w in tokens.words[max(0, i - 4):i] if w[0].isalpha()}:
                    before[w] = before.get(w, 0) + 1
    cues = frozenset(w for w, n in before.items() if n >= 2)
    model = Tagger({s: i for i, s in enumerate(names)}, cues, np.zeros(0), np.zeros(0))
    n, steps, k = len(rows), max(len(t.words) for t, _ in rows), len(LABELS)
    lengths = np.array([len(t.words) for t, _ in rows])
    none = model.n_features()  # a row of zeros for the padding
    width = model.features(rows[0][0]).shape[1]
    feats, gold = np.full((n, steps, width), none), np.zeros((n, steps), int)
    for i, (tokens, tags) in enumerate(rows):
        feats[i, :lengths[i]] = model.features(tokens)
        gold[i, :lengths[i]] = tags
    real = np.arange(steps)[None, :] < lengths[:, None]
    fixed, each = allowed(), np.arange(n)
    weights = [np.zeros((none + 1, k)), np.zeros((k, k))]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def log_sum(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, rounds + 1):
        emit, move = weights[0], weights[1] + fixed
        scores = emit[feats].sum(axis=2)
        ahead, behind = np.zeros((n, steps, k)), np.zeros((n, steps, k))
        ahead[:, 0] = scores[:, 0] + fixed[0]
        for t in range(1, steps):
            new = log_sum(ahead[:, t - 1, :, None] + move, 1) + scores[:, t]
            ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = log_sum(move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None], new, 0.0)
        total = log_sum(ahead[:, -1], 1)
        share = np.exp(ahead + behind - total[:, None, None]) * real[:, :, None]
        share[each[:, None], np.arange(steps)[None, :], gold] -= real
        grad_emit, grad_move = np.zeros_like(weights[0]), np.zeros_like(weights[1])
        np.add.at(grad_emit, feats, share[:, :, None, :])
        for t in range(1, steps):
            on = real[:, t]
            pair = np.exp(ahead[on, t - 1, :, None] + move + (scores[on, t] + behind[on, t])[:, None, :]
                          - total[on, None, None])
            grad_move += pair.sum(axis=0)
            np.add.at(grad_move, (gold[on, t - 1], gold[on, t]), -1.0)
        grads = [grad_emit + penalty * weights[0], grad_move + penalty * weights[1]]
        grads[0][none] = 0
        for i, grad in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.99 * second[i] + 0.01 * grad ** 2
            weights[i] = weights[i] - rate * (first[i] / (1 - 0.9 ** step)) / (
                np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    return Tagger(model.shapes, cues, weights[0][:none], weights[1] + fixed)


def default_tagger() -> Tagger:
    """Trained once in each worker process, always alike: 58 lines, about a second."""
    return kept_in_worker("tagger", lambda: train(labelled()))


# ---- Spans of whole texts ----------------------------------------------------------

def stretches(text: str) -> list[Tokens]:
    """Token stretches around digits, at signs and written at signs, line by line."""
    out = []
    for line in re.finditer(r"[^\n]+", text):
        if not _ANCHOR.search(line[0]):
            continue
        tokens = tokens_of(text, *line.span())
        held = np.array([w[0] in "0123456789@" or w == "at" and text[a - 1:b + 1] in (" at ", "(at)")
                         for w, (a, b) in zip(tokens.words, tokens.spans)], bool)
        if not held.any():
            continue
        near = np.convolve(held, np.ones(2 * REACH + 1), "same") > 0
        edge = np.diff(np.concatenate([[0], near.astype(int), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            out.append(Tokens(tokens.words[a:b], tokens.spans[a:b], tokens.glued[a:b]))
    return out


#: Least digits of a span that the field adds, and least characters.
_LEAST_DIGITS = {"email": 0, "ip": 4, "card": 13, "phone": 7, "secret": 1}
_LEAST_CHARS = {"email": 6, "ip": 7, "card": 13, "phone": 7, "secret": 16}


def added_spans(text: str, tokens: Tokens, labels: np.ndarray) -> list[tuple[int, int, int]]:
    """Entities of one decoded stretch that hold what their kind needs."""
    out, i = [], 0
    while i < len(labels):
        if LABELS[labels[i]][0] != "B":
            i += 1
            continue
        j = i + 1
        while j < len(labels) and LABELS[labels[j]][0] == "I":
            j += 1
        kind, start, end = LABELS[labels[i]][2:], tokens.spans[i][0], tokens.spans[j - 1][1]
        value = text[start:end]
        if (len(value) >= _LEAST_CHARS[kind] and len(_NO_DIGITS.sub("", value)) >= _LEAST_DIGITS[kind]
                and (kind != "email" or "@" in value or " at " in value or "(at)" in value)
                and (kind != "ip" or value.count(".") == 3 or value.count(":") > 1)):
            out.append((KINDS.index(kind), start, end))
        i = j
    return out


def find(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; an added span overlaps no base span."""
    base = [base_spans(t) for t in texts]
    parts = [(i, s) for i, t in enumerate(texts) for s in stretches(t)]
    every = [list(b) for b in base]
    for (i, tokens), labels in zip(parts, tagger.decode([s for _, s in parts])):
        for kind, start, end in added_spans(texts[i], tokens, labels):
            if all(end <= a or b <= start for _, a, b in base[i]):
                every[i].append((kind, start, end))
    return list(zip(base, [sorted(e) for e in every]))


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts and digest of the base spans, and all spans.

    Null texts count as empty and have no spans; repeated rows stay; an empty table gives no
    rows; only the two named columns are read. Map only.
    """
    def start():
        tagger = default_tagger()

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            found = find(pc.fill_null(batch.column(1), "").to_pylist(), tagger)
            counts = [longs([sum(k == kind for k, _, _ in base) for base, _ in found]) for kind in range(4)]
            digests = [hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found]
            return [batch.column(0).cast(pa.int64()), *counts, pa.array(digests, pa.string()),
                    pa.array([listed(every) for _, every in found], pa.string()),
                    longs([len(every) for _, every in found])]
        return step

    return arrow_map(docs.select(id_col, text_col), RESULT, start)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with ``<KIND>`` in place of each span; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data of ``text_col`` masked; null texts stay null, texts
    without any stay as they are, and so do all other columns."""
    place = docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def start():
        tagger = default_tagger()

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column(place).to_pylist()
            found = find([t or "" for t in texts], tagger)
            clean = [t if not every else masked(t, every) for t, (_, every) in zip(texts, found)]
            columns = list(batch.columns)
            columns[place] = pa.array(clean, pa.string())
            return columns
        return step

    return arrow_map(docs, schema, start)
