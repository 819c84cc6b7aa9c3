"""Byte-level BPE ids of many texts at once.

A text is cut into pieces (letters, digits, other characters, white space) in numpy, equal
pieces of a chunk are found by hash, and the tokenizer encodes each different piece once.
The ids equal those of the tokenizer on the whole text, because it never merges across
pieces, as long as no two different pieces of a task share a 64-bit hash. Added tokens such as <|endoftext|> are found in a text with ``added`` only, as the
tokenizer does by default; without it they are text like any other (``encode_special_tokens``).
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np

from drover.llm.base import PieceHash

#: Characters handled at a time, and different pieces remembered between chunks.
CHUNK = 1 << 21
REMEMBER = 1_000_000

# The classes of characters that the tokenizer's pattern tells apart.
_SPACE, _LETTER, _NUMBER, _OTHER, _BREAK = range(5)
_SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that the pattern keeps together with their apostrophe.
_ONE, _TWO = "stmd", ("re", "ve", "ll")
_SEPARATOR = 0x110000


def _classes() -> np.ndarray:
    table = np.full(_SEPARATOR + 1, _OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            table[c] = _LETTER if kind == "L" else _NUMBER
    table[_SPACES] = _SPACE
    table[_SEPARATOR] = _BREAK
    return table


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, free = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(free)
            free += 1
    return [table[b] for b in range(256)]


def piece_starts(codes: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Positions where a piece begins. The last code must be a separator."""
    start = np.empty(len(codes), bool)
    start[0] = True
    np.not_equal(cls[1:], cls[:-1], out=start[1:])
    start |= cls == _BREAK
    # The last white space before other text stands alone, or joins it if it is a blank.
    last = np.flatnonzero((cls[:-1] == _SPACE) & (cls[1:] != _SPACE) & (cls[1:] != _BREAK))
    start[last] = True
    start[last[codes[last] == 32] + 1] = False
    for p in np.flatnonzero((codes == 39) & start).tolist():
        if chr(codes[p + 1] & 0xFFFF) in _ONE and codes[p + 1] < 128:
            start[p + 1], start[p + 2] = False, True
        elif p + 2 < len(codes) and codes[p + 1] < 128 and codes[p + 2] < 128 and chr(codes[p + 1]) + chr(codes[p + 2]) in _TWO:
            start[p + 1], start[p + 3] = False, True
    return np.flatnonzero(start)


class Encoder:
    """Ids of texts by a ``tokenizers`` file with a byte-level BPE model."""

    def __init__(self, path: str, added: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        # The file's vocabulary as ranks: in a byte-level BPE vocabulary ids follow the merges.
        spelled = {c: b for b, c in enumerate(_byte_letters())}
        special = {t.content: i for i, t in Tokenizer.from_file(path).get_added_tokens_decoder().items()}
        self.added = special if added else {}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
        ranks = {bytes(spelled[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.piece = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.classes = _classes()
        self.hash = PieceHash(_SEPARATOR + 1)
        self.known = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, texts: Iterable[str]) -> None:
        """Remember the ids of new pieces; ``hashes`` ascend and none is known."""
        new = [self.piece(t.encode("utf-8", "replace")) if t else [] for t in texts]
        size = np.fromiter(map(len, new), np.int64, len(new))
        begin = len(self.flat) + np.cumsum(size) - size
        flat = np.fromiter(itertools.chain.from_iterable(new), np.uint32, int(size.sum()))
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.begin = np.insert(self.begin, at, begin)
        self.size = np.insert(self.size, at, size)
        self.flat = np.concatenate((self.flat, flat))

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, hashes)
        at[at == len(self.known)] = 0
        return at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text). Together at most about a chunk of characters."""
        joined = "\0".join(texts) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        codes[ends] = _SEPARATOR
        starts = piece_starts(codes, self.classes[codes])
        stops = np.append(starts[1:], len(codes))
        hashes = self.hash(codes, starts, stops)
        breaks = np.searchsorted(starts, ends)  # each separator is a piece of its own
        own, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBER:
            self.known, self.begin, self.size, self.flat = self.known[:0], self.begin[:0], self.size[:0], self.flat[:0]
        at = self._find(own)
        missing = np.flatnonzero(self.known[at] != own) if len(self.known) else np.arange(len(own))
        if len(missing):
            sep = hashes[breaks[0]]
            texts_of = ("" if own[i] == sep else joined[starts[first[i]] : stops[first[i]]] for i in missing.tolist())
            self._learn(own[missing], texts_of)
            at = self._find(own)
        at = at[inverse]
        size, begin = self.size[at], self.begin[at]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.arange(total[-1]) - np.repeat(total[:-1] - begin, size)]
        bounds = total[breaks]
        return ids, np.diff(bounds, prepend=0)


def chunks(texts: Iterable[str], limit: int = CHUNK) -> Iterator[tuple[list[str], list[bool]]]:
    """Lists of about ``limit`` characters, with a flag where a text goes on in the next item.

    A longer text is cut before a blank between two characters that are no white space,
    where a piece begins in any case.
    """
    held: list[str] = []
    more: list[bool] = []
    size = 0
    for text in texts:
        while len(text) > limit:
            cut = _cut(text, limit)
            if cut is None:
                break
            held.append(text[:cut])
            more.append(True)
            yield held, more
            held, more, size = [], [], 0
            text = text[cut:]
        held.append(text)
        more.append(False)
        size += len(text) + 1
        if size >= limit:
            yield held, more
            held, more, size = [], [], 0
    if held:
        yield held, more


def _cut(text: str, limit: int) -> int | None:
    at = text.find(" ", limit // 2)
    while at != -1:
        if at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace():
            return at
        at = text.find(" ", at + 1)
    return None


def encoded(encoder: Encoder, texts: Iterable[str]) -> Iterator[np.ndarray]:
    """The ids of each text in turn."""
    if not encoder.added:
        yield from _plain(encoder, texts)
        return
    between: deque[list[int]] = deque()  # ids of the added tokens in each text that is under way

    def segments() -> Iterator[str]:
        for text in texts:
            parts = encoder.split.split(text)
            between.append([encoder.added[x] for x in parts[1::2]])
            yield from parts[::2]

    each = _plain(encoder, segments())
    for first in each:
        out = [first]
        for i in between.popleft():
            out += [np.array([i], np.uint32), next(each)]
        yield first if len(out) == 1 else np.concatenate(out)


def _plain(encoder: Encoder, texts: Iterable[str]) -> Iterator[np.ndarray]:
    """The ids of each text in turn, added tokens being ordinary text."""
    part: list[np.ndarray] = []
    for held, more in chunks(texts):
        ids, sizes = encoder.encode(held)
        stop = np.cumsum(sizes)
        for a, b, goes_on in zip(stop - sizes, stop, more, strict=True):
            part.append(ids[a:b])
            if not goes_on:
                yield part[0] if len(part) == 1 else np.concatenate(part)
                part = []
