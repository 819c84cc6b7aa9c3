"""Personal data: fixed patterns, and a linear-chain conditional random field that adds to them.

The field tags words by their shape and that of their neighbours. Words without a digit or
an at sign can only bear the tag "outside" (its tag dictionary), so a text falls into
short runs of other words that are decoded apart and exactly, by Viterbi in numpy over
batches of runs of one length. It is trained on a small table: runs that the patterns
label in a bounded sample of documents, and a few labelled by hand that the patterns miss.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.llm.base import ASCII_SPACE, extended, schema_of, text_column

# Kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match can only begin where a run of digits does
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Documents that the labelled table is drawn from, on average, and the runs it holds at most.
TRAIN_DOCS, TRAIN_RUNS = 4_000, 2_000
#: Words of a run, and characters of its words, beyond which it is not taken into the labelled table.
RUN_WORDS, RUN_CHARS = 32, 2_000
#: Times that each of the hand-labelled runs counts.
HAND_WEIGHT = 8
# Runs labelled by hand, in forms that the patterns do not know, and numbers that are none of the kinds.
HAND = (
    ("phone", "555-123-4567"), ("phone", "(555) 123-4567"), ("phone", "555 123 4567"), ("phone", "555.123.4567"), ("phone", "1-555-123-4567"),
    ("phone", "0171 5551234"), ("phone", "030 1234567"), ("phone", "0171/5551234"), ("phone", "01 42 68 53 00"), ("phone", "0049 171 5551234"),
    ("phone", "(030) 123 4567"), ("phone", "1 (743) 555-3824"), ("card", "4465.7583.8288.9437"), ("card", "4465/7583/8288/9437"),
    ("card", "4465_7583_8288_9437"), (None, "2024-03-05"), (None, "05/03/2024"), (None, "5.3.2024"), (None, "05-03-2024"), (None, "10:30"),
    (None, "2024-03-05 10:30:00"), (None, "2024-03-05T10:30:00Z"), (None, "1.2.3"), (None, "v2.10.1"), (None, "12,500"), (None, "3.14159"),
    (None, "300"), (None, "1999"), (None, "1999-2004"), (None, "978-3-16-148410-0"), (None, "12%"), (None, "$1,200.50"), (None, "1200000"),
    (None, "12345678"), (None, "100 200 300"), (None, "10 000 000"), (None, "1234567890"), (None, "20240305"), (None, "3:4"), (None, "10-12"),
    (None, "1/2"), (None, "A4"), (None, "4th"), (None, "1,234,567.89"), (None, "10.1000/182"), (None, "12345-6789"), (None, "7 8 9 10 11 12"),
)
EPOCHS, RATE, DECAY = 120, 0.2, 1e-3
SPAN = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every address, from its at sign outwards, which keeps the work linear in the text."""
    done, at = 0, text.find("@")
    while at != -1:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns, by start and then kind; code points, end exclusive."""
    found = [(a, b, 0) for a, b in emails(text)]
    found += [(*m.span(), 1) for m in IP.finditer(text) if _octets(m[0])]
    found += [(*m.span(), 2) for m in CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [(*m.span(), 3) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))]


# --- words and their features ---------------------------------------------------------------

_HIT = re.compile(r"[0-9@]")
_REST = re.compile(r"[^\x20\x09-\x0D]*+")
_TRIM = "\"'`,;:!?*$%&#|<>[]{}=~^_/\\."
_DIGITS = re.compile("[0-9]+")
_LETTERS = re.compile(r"[^\W\d_]+")


def runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring words that hold a digit or an at sign, trimmed of punctuation;
    two words are neighbours if only white space is between them."""
    at, last, now = 0, -1, []
    while True:
        m = _HIT.search(text, at)
        if not m:
            break
        start = 1 + max(text.rfind(c, at, m.start()) for c in ASCII_SPACE)
        start = start if start > 0 else at
        end = _REST.match(text, m.start()).end()
        if now and text[last:start].strip(ASCII_SPACE):
            yield now
            now = []
        a, b = start, end
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        now.append((a, b))
        at = last = end
    if now:
        yield now


def shape(word: str) -> str:
    """Digits as their number, letters as x, the rest as it is."""
    return _LETTERS.sub("x", _DIGITS.sub(lambda m: f"{{{min(len(m[0]), 20)}}}", word))


def features(words: list[str]) -> list[list[str]]:
    """Names of the features of each word of a run."""
    shapes = [shape(w) for w in words]
    coarse = [re.sub(r"\{\d+\}", "9", s) for s in shapes]
    out = []
    for i, w in enumerate(words):
        d = _digits(w)
        own = [f"s={shapes[i]}", f"c={coarse[i]}", f"n={min(len(d), 20)}", f"first={coarse[i][:1]}", f"dots={min(w.count('.'), 4)}"]
        own.append(f"prev={coarse[i - 1] if i else '^'}")
        own.append(f"next={coarse[i + 1] if i + 1 < len(words) else '$'}")
        if "@" in w:
            own.append("at" if DOMAIN.search(w, w.rfind("@") + 1) else "at-only")
        if 12 <= len(d) <= 19:
            own.append("luhn" if luhn(d) else "not-luhn")
        if w.count(".") == 3 and coarse[i] == "9.9.9.9":
            own.append("octets" if _octets(w) else "not-octets")
        out.append(own)
    return out


# --- the field ------------------------------------------------------------------------------

TAGS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
_FORBIDDEN = np.zeros((len(TAGS) + 1, len(TAGS)), bool)  # last row: from the start of a run
for _i, _tag in enumerate(TAGS):
    if _tag[0] == "I":
        _FORBIDDEN[:, _i] = [_t[2:] != _tag[2:] for _t in TAGS] + [True]
_LOW = -1e6


class Field:
    """Weights of (feature, tag) and of (tag, next tag); the last row of the moves starts a run."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.index, self.emit, self.move = index, emit, move

    def scores(self, run_features: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(run_features), len(TAGS)))
        for i, names in enumerate(run_features):
            known = [self.index[n] for n in names if n in self.index]
            if known:
                out[i] = self.emit[known].sum(axis=0)
        return out

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """Best tags of a batch of runs of one length: (runs, length, tags) -> (runs, length)."""
        move = np.where(_FORBIDDEN, _LOW, self.move)
        n, length, _ = scores.shape
        best = scores[:, 0] + move[-1]
        back = np.zeros((n, length, len(TAGS)), np.int8)
        for t in range(1, length):
            through = best[:, :, None] + move[None, :-1]
            back[:, t] = through.argmax(axis=1)
            best = through.max(axis=1) + scores[:, t]
        tags = np.zeros((n, length), np.int64)
        tags[:, -1] = best.argmax(axis=1)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
        return tags


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(labelled: list[tuple[list[list[str]], list[int]]]) -> Field:
    """Maximise the conditional log-likelihood of (features, tags) runs, by AdaGrad on the
    exact gradient from forward-backward over batches of runs of one length."""
    names = sorted({n for feats, _ in labelled for word in feats for n in word})
    index = {n: i for i, n in enumerate(names)}
    k = len(TAGS)
    emit, move = np.zeros((len(names), k)), np.zeros((k + 1, k))
    g_emit, g_move = np.full_like(emit, 1e-6), np.full_like(move, 1e-6)
    groups: dict[int, list] = {}
    for feats, tags in labelled:
        groups.setdefault(len(tags), []).append((feats, tags))
    batches = []
    for length, rows in sorted(groups.items()):
        at, which = [], []
        for r, (feats, _) in enumerate(rows):
            for t, word in enumerate(feats):
                at += [r * length + t] * len(word)
                which += [index[n] for n in word]
        batches.append((length, np.array(at), np.array(which), np.array([tags for _, tags in rows])))
    for _ in range(EPOCHS if names else 0):
        d_emit, d_move = -DECAY * emit, -DECAY * move
        for length, at, which, tags in batches:
            n = len(tags)
            scores = np.zeros((n * length, k))
            np.add.at(scores, at, emit[which])
            scores = scores.reshape(n, length, k)
            m = np.where(_FORBIDDEN, _LOW, move)
            ahead = [scores[:, 0] + m[-1]]
            for t in range(1, length):
                ahead.append(_sum_exp(ahead[-1][:, :, None] + m[None, :-1], 1) + scores[:, t])
            behind = [np.zeros((n, k))]
            for t in range(length - 1, 0, -1):
                behind.insert(0, _sum_exp(m[None, :-1] + (scores[:, t] + behind[0])[:, None, :], 2))
            z = _sum_exp(ahead[-1], 1)
            want = np.zeros((n, length, k))
            want[np.arange(n)[:, None], np.arange(length)[None], tags] = 1
            p = np.exp(np.stack(ahead, 1) + np.stack(behind, 1) - z[:, None, None])
            np.add.at(d_emit, which, (want - p).reshape(-1, k)[at])
            d_move[-1] += (want[:, 0] - p[:, 0]).sum(axis=0)
            for t in range(1, length):
                pair = ahead[t - 1][:, :, None] + m[None, :-1] + (scores[:, t] + behind[t])[:, None, :] - z[:, None, None]
                d_move[:-1] -= np.exp(pair).sum(axis=0)
                np.add.at(d_move, (tags[:, t - 1], tags[:, t]), 1)
        g_emit += d_emit**2
        g_move += d_move**2
        emit += RATE * d_emit / np.sqrt(g_emit)
        move += RATE * d_move / np.sqrt(g_move)
    return Field(index, emit, move)


def label(run: list[tuple[int, int]], spans: list[tuple[int, int, str]]) -> list[int]:
    """Tags of the words of a run by the pattern spans that cover them; a later kind wins."""
    tags, before = [], None
    for a, b in run:
        own = next((s for s in reversed(spans) if s[0] < b and a < s[1]), None)
        tags.append(TAGS.index(f"{'I' if own == before else 'B'}-{own[2]}") if own else 0)
        before = own
    return tags


def _labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for i, text in zip(pdf["id"], pdf["text"], strict=True):
            spans = base_spans(text)
            for n, run in enumerate(runs(text)):
                words = [text[a:b] for a, b in run]
                if len(words) <= RUN_WORDS and sum(map(len, words)) <= RUN_CHARS:
                    rows.append((i, n, words, label(run, spans)))
        yield pd.DataFrame(rows, columns=["id", "n", "words", "tags"])


def train(df: DataFrame, key: str = "doc_id", text: str = "text", docs: int = TRAIN_DOCS, most: int = TRAIN_RUNS) -> Field:
    """Fit on runs from about ``docs`` documents, chosen by a hash of their key. Of the runs,
    those with a label come first; ``most`` reach the driver, each of at most ``RUN_WORDS``
    words and ``RUN_CHARS`` characters. The runs of :data:`HAND` join them. Without any that a
    pattern labels the field adds nothing. Null texts are left out."""
    rows = df.filter(F.col(text).isNotNull()).select(F.coalesce(F.xxhash64(F.col(key)), F.lit(0)).alias("id"), F.col(text).cast("string").alias("text"))
    n = df.count()
    unit = F.pmod("id", F.lit(1 << 20))
    sample = rows.filter(unit < int(min(1.0, docs / max(n, 1)) * (1 << 20)))
    table = sample.mapInPandas(_labelled, "id long, n long, words array<string>, tags array<long>")
    first = F.when(F.array_max("tags") > 0, 0).otherwise(1)
    chosen = table.orderBy(first, F.xxhash64("id", "n"), "id", "n").limit(most).collect()  # a bounded, labelled table
    rows = [(features(r["words"]), r["tags"]) for r in chosen if r["tags"]]
    return fit(rows + by_hand() * HAND_WEIGHT if any(max(t) > 0 for _, t in rows) else rows)


def by_hand() -> list[tuple[list[list[str]], list[int]]]:
    """The hand-labelled runs, as :func:`fit` takes them."""
    out = []
    for kind, text in HAND:
        words = [text[a:b] for run in runs(text) for a, b in run]
        tags = [TAGS.index(f"{'I' if k else 'B'}-{kind}") if kind else 0 for k in range(len(words))]
        out.append((features(words), tags))
    return out


def _plausible(kind: str, s: str) -> bool:
    d = _digits(s)
    if kind == "email":
        at = s.rfind("@")
        return at > 0 and DOMAIN.search(s, at + 1) is not None
    if kind == "ip":
        return bool(IP.fullmatch(s)) and _octets(s)
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d)
    return 7 <= len(d) <= 15


class _Cover:
    """Answers whether any of the spans, sorted by start, meets [a, b)."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self.starts = [s[0] for s in spans]
        self.reach = list(accumulate((s[1] for s in spans), max))

    def meets(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)
        return k > 0 and self.reach[k - 1] > a


def added_spans(field: Field, texts: list[str], base: list[list[tuple[int, int, str]]]) -> list[list[tuple[int, int, str]]]:
    """What the field finds beyond the patterns: no overlap with a pattern's span, and the
    least that makes its kind. Runs of one length are decoded together."""
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    if not field.index:
        return out
    groups: dict[int, list] = {}
    cover = [_Cover(b) for b in base]
    for i, text in enumerate(texts):
        for run in runs(text) if text else ():
            # Words in a pattern's span are settled; what is left of a run on either side is decoded.
            for taken, part in groupby(run, lambda w: cover[i].meets(*w)):  # noqa: B023
                if not taken:
                    part = list(part)
                    groups.setdefault(len(part), []).append((i, part))
    for length, found in groups.items():
        size = max(1, 20_000 // length)
        for k in range(0, len(found), size):
            part = found[k : k + size]
            scores = np.stack([field.scores(features([texts[i][a:b] for a, b in run])) for i, run in part])
            for (i, run), tags in zip(part, field.viterbi(scores), strict=True):
                out[i] += _spans(texts[i], run, tags, cover[i])
    return [sorted(x) for x in out]


def _spans(text: str, run: list[tuple[int, int]], tags: np.ndarray, cover: _Cover) -> Iterator[tuple[int, int, str]]:
    t = 0
    while t < len(run):
        if not tags[t]:
            t += 1
            continue
        kind, stop = TAGS[tags[t]][2:], t + 1
        while stop < len(run) and TAGS[tags[stop]] == f"I-{kind}":
            stop += 1
        a, b = run[t][0], run[stop - 1][1]
        t = stop
        if _plausible(kind, text[a:b]) and not cover.meets(a, b):
            yield a, b, kind


def _all_spans(field: Field, texts: Iterable[str]) -> Iterator[list[dict]]:
    """Per text its spans, the patterns' and the field's, by start and kind."""
    order = {k: i for i, k in enumerate(KINDS)}
    for part in _bounded(texts):
        base = [base_spans(t) if _HIT.search(t) else [] for t in part]
        for a, b in zip(added_spans(field, part, base), base, strict=True):
            both = sorted([(*s, True) for s in b] + [(*s, False) for s in a], key=lambda s: (s[0], order[s[2]]))
            yield [{"kind": k, "start": x, "end": y, "base": f} for x, y, k, f in both]


def find(df: DataFrame, field: Field, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``spans``: (kind, start, end, base) by start and kind, in code
    points, end exclusive. ``base`` marks a pattern's span. Null and empty texts have none."""
    shared = df.sparkSession.sparkContext.broadcast((field.index, field.emit, field.move))
    read, thin = text_column(df, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*shared.value)
        for batch in batches:
            spans = list(_all_spans(own, (t.as_py() or "" for t in batch.column(read))))
            yield extended(batch, keep, spans=pa.array(spans, _SPAN))

    return thin.mapInArrow(run, schema_of(thin, keep, f"spans {SPAN}"))


def redacted(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """All columns, with every span of :func:`find` in ``text`` masked by its kind."""
    shared = df.sparkSession.sparkContext.broadcast((field.index, field.emit, field.move))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*shared.value)
        for batch in batches:
            column = batch.column(text)
            spans = _all_spans(own, (t.as_py() or "" for t in column))
            masked = [redact(t.as_py(), s) for t, s in zip(column, spans, strict=True)]
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(masked, column.type))

    return df.mapInArrow(run, df.schema)


def _bounded(texts: Iterable[str], limit: int = 1 << 22) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def redact(text: str | None, spans: list) -> str | None:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets."""
    if not spans:
        return text
    out, at, k = [], 0, 0
    while k < len(spans):
        a, b, kind = spans[k]["start"], spans[k]["end"], spans[k]["kind"]
        k += 1
        while k < len(spans) and spans[k]["start"] < b:
            b = max(b, spans[k]["end"])
            k += 1
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join([*out, text[at:]])
