"""Spelling variants of a vocabulary: FM-index search schemes with one error.

Words are counted per task before they are shuffled. Two words that differ by one inserted,
deleted or replaced code point agree in the front or in the back half of either one. So each
word goes to the groups of its front halves and its back halves, and every group builds an
FM-index over its words between delimiters. A search matches the known half exactly, from the
delimiter at its end, and extends across the other half with one error; what is left at the
second delimiter is an interval of one suffix rank, the word found. Searches from the front
run over reversed words, so the two directions of the bidirectional index are built for the
groups that need them. Either way a search starts at a delimiter and grows to one side only, and
needs one interval at a time.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.session import materialize

# Letters are A-Z, a-z and U+00C0 to U+00FF; one run in DIVISOR loses a code point.
DIVISOR = 199
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form has at least so many times the occurrences of its variant.
RATIO = 5

#: Distinct runs, and code points of them, that a task holds before it passes their counts on.
HELD_WORDS, HELD_CHARS = 1 << 18, 1 << 25
#: Characters of a text taken at a time; a piece ends with its last run.
PIECE = 1 << 20
#: Code points of the words of a group, delimiters included. A half with more is dealt to
#: several groups, each part of its words against each part of its searches.
BLOCK = 1 << 17
#: Code points of the searches that run at a time.
SEARCHED = 1 << 14

_SHORT = 64  # bytes of a run whose crc is found for all documents of a batch at once
_LOW = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_CRC = np.array([zlib.crc32(bytes([c])) for c in range(256)], np.uint32)
# One zero byte taken into a crc without the conditioning of its first and last step.
_SHIFT = _CRC ^ _CRC[0]


class _Runs(dict):
    """Run (Latin-1 bytes) -> number, in order of appearance, with crc32 and length in UTF-8."""

    def __init__(self):
        super().__init__()
        self.crc, self.size, self.chars = [], [], 0

    def __missing__(self, run: bytes) -> int:
        utf8 = run.decode("latin-1").encode()
        self.crc.append(zlib.crc32(utf8))
        self.size.append(len(utf8))
        self.chars += len(run)
        self[run] = number = len(self.size) - 1
        return number


def _pieces(low: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(low):
        end = low.find(b" ", at + PIECE) if at + PIECE < len(low) else -1
        end = len(low) if end < 0 else end
        yield low[at:end].split()
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each result of at least MIN_LENGTH code points, per task."""
    runs, counts, changed = _Runs(), np.zeros(0, np.int64), Counter()

    def passed_on() -> pa.RecordBatch:
        long_enough = [(w, n) for w, n in zip(runs, counts.tolist(), strict=True) if n and len(w) >= MIN_LENGTH]
        long_enough += [(w, n) for w, n in changed.items() if len(w) >= MIN_LENGTH]
        words = [w.decode("latin-1") for w, _ in long_enough]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([n for _, n in long_enough], pa.int64())], names=["word", "n"])

    def add(found: list[int], doc: list[int], prefixes: list[bytes]) -> None:
        """Count a few texts' runs, given as numbers with the place of their prefix."""
        nonlocal counts
        ids, doc = np.array(found, np.int64), np.array(doc, np.int64)
        crc, size = np.array(runs.crc, np.uint32), np.array(runs.size, np.int64)
        # crc(prefix + run) is crc(prefix), taken on by as many zero bytes as the run has, xor crc(run).
        shifted = np.empty((_SHORT + 1, len(prefixes)), np.uint32)
        shifted[0] = [zlib.crc32(p) for p in prefixes]
        for n in range(_SHORT):
            shifted[n + 1] = (shifted[n] >> np.uint32(8)) ^ _SHIFT[shifted[n] & np.uint32(255)]
        long_runs = size[ids] > _SHORT
        h = shifted[np.minimum(size[ids], _SHORT), doc] ^ crc[ids]
        hit = (h % np.uint32(DIVISOR) == 0) | long_runs
        more = np.bincount(ids[~hit], minlength=len(runs))
        more[: len(counts)] += counts
        counts = more
        if hit.any():
            words = list(runs)
            for i in np.flatnonzero(hit).tolist():
                run, value = words[ids[i]], int(h[i])
                if long_runs[i]:
                    value = zlib.crc32(prefixes[doc[i]] + run.decode("latin-1").encode())
                    if value % DIVISOR:
                        counts[ids[i]] += 1
                        continue
                k = value % len(run)
                changed[run[:k] + run[k + 1 :]] += 1

    for batch in batches:
        prefixes, found, doc = [], [], []
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py()
            if not text:
                continue
            prefixes.append(f"{key.as_py() or ''}:".encode())
            for words in _pieces(text.encode("latin-1", "replace").translate(_LOW)):
                found.extend(map(runs.__getitem__, words))
                doc.extend([len(prefixes) - 1] * len(words))
                if len(found) > 1 << 18 or runs.chars > HELD_CHARS:
                    add(found, doc, prefixes)
                    found, doc = [], []
                    if len(runs) > HELD_WORDS or runs.chars > HELD_CHARS:
                        yield passed_on()
                        runs, counts, changed = _Runs(), np.zeros(0, np.int64), Counter()
        if found:
            add(found, doc, prefixes)
    yield passed_on()


def vocabulary(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of letters of whole texts, one in DIVISOR of them with a code point
    deleted as the crc of key and run says, of MIN_LENGTH code points and ``least`` occurrences.
    A null text has none, a null key counts as ''. Tasks add up before the shuffle."""
    thin = df.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    return thin.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


class Index:
    """FM-index of words between delimiters. Code 0 ends the text, 1 is the delimiter."""

    def __init__(self, words: list[str]):
        self.words = words
        sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes + 1)))  # the delimiter before each word
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.alphabet, codes = np.unique(points, return_inverse=True)
        self.sigma = len(self.alphabet) + 2
        text = np.ones(int(self.starts[-1]) + 2, np.int64)
        text[-1] = 0
        inside = np.ones(len(text), bool)
        inside[self.starts] = inside[-1] = False
        text[inside] = codes + 2
        self.n = len(text)
        self.suffixes = self._sorted(text)
        bwt = text[self.suffixes - 1]
        self.bwt = bwt
        # Sorted by symbol, then place: the place of (c, i) in it is where rows before i lead by c.
        self.order = np.sort(bwt * (self.n + 1) + np.arange(self.n))

    def _sorted(self, text: np.ndarray) -> np.ndarray:
        """Suffix array by doubling, from keys that already hold several symbols."""
        bits = max(1, int(self.sigma - 1).bit_length())
        width = max(1, 62 // bits)
        padded = np.concatenate((text, np.zeros(width, np.int64)))
        key = np.zeros(self.n, np.int64)
        for i in range(width):
            key = (key << bits) | padded[i : i + self.n]
        while True:
            suffixes = np.argsort(key, kind="stable")
            ordered = key[suffixes]
            rank = np.empty(self.n, np.int64)
            rank[suffixes] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            if rank[suffixes[-1]] == self.n - 1:
                return suffixes
            after = np.zeros(self.n, np.int64)
            after[: max(0, self.n - width)] = rank[width:] + 1
            key = rank * (self.n + 1) + after
            width *= 2

    def codes(self, word: str) -> np.ndarray:
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, points), max(0, len(self.alphabet) - 1))
        return np.where(self.alphabet[at] == points, at + 2, self.sigma) if len(self.alphabet) else np.full(len(points), self.sigma)

    def extend(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that have c before those of the given intervals."""
        return np.searchsorted(self.order, c * (self.n + 1) + lo), np.searchsorted(self.order, c * (self.n + 1) + hi)

    def extend_all(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """(state, symbol, lo, hi) of every extension by a letter. Short intervals are read off
        row by row, long ones tried with each letter."""
        width, letters = hi - lo, np.arange(2, self.sigma)
        short = np.flatnonzero(width <= len(letters))
        total = int(width[short].sum())
        rows = np.repeat(lo[short] - np.concatenate(([0], np.cumsum(width[short])[:-1])), width[short]) + np.arange(total)
        near = np.unique(np.repeat(short, width[short]) * self.sigma + self.bwt[rows])
        far = np.flatnonzero(width > len(letters))
        state = np.concatenate((near // self.sigma, np.repeat(far, len(letters))))
        c = np.concatenate((near % self.sigma, np.tile(letters, len(far))))
        a, b = self.extend(lo[state], hi[state], c)
        real = (c > 1) & (b > a)
        return state[real], c[real], a[real], b[real]

    def near(self, asked: list[str], known: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(search, word) for every word that has the last ``known`` code points of the
        search and differs from it by exactly one code point before them."""
        codes = [self.codes(w) for w in asked]
        sizes = np.array([len(c) for c in codes], np.int64)
        base = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        flat = np.concatenate([*codes, np.zeros(1, np.int64)])  # one more, so that nothing is out of range
        left = sizes - np.array(known, np.int64)
        q, j = np.arange(len(asked)), sizes.copy()
        lo, hi = np.full(len(q), np.searchsorted(self.order, self.n + 1)), np.full(len(q), np.searchsorted(self.order, 2 * (self.n + 1)))
        while (more := j > left[q]).any():  # the known half, from the delimiter on
            j = np.where(more, j - 1, j)
            a, b = self.extend(lo, hi, flat[base[q] + j])
            lo, hi = np.where(more, a, lo), np.where(more, b, hi)
            kept = hi > lo
            q, j, lo, hi = q[kept], j[kept], lo[kept], hi[kept]
        found = []
        while len(q):  # no error yet; at every place one is made, and the rest matched exactly
            pool = []
            state, c, a, b = self.extend_all(lo, hi)
            owner, place = q[state], j[state]
            wanted = np.where(place > 0, flat[base[owner] + np.maximum(place, 1) - 1], -1)
            other = (c != wanted) & (place > 0)
            pool.append((owner[other], a[other], b[other], place[other] - 1))  # replaced
            pool.append((owner, a, b, place))  # inserted
            pool.append((q[j > 0], lo[j > 0], hi[j > 0], j[j > 0] - 1))  # deleted
            found.append(self._rest(flat, base, *(np.concatenate(x) for x in zip(*pool, strict=True))))
            same = c == wanted
            q, j, lo, hi = owner[same], place[same] - 1, a[same], b[same]
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pairs[:, 0], pairs[:, 1]

    def _rest(self, flat, base, q, lo, hi, j) -> np.ndarray:
        ended = []
        while len(q):
            done = j == 0
            a, b = self.extend(lo, hi, np.where(done, 1, flat[base[q] + np.maximum(j, 1) - 1]))
            full = b > a
            at = self.suffixes[a[done & full]]
            ended.append(np.stack((q[done & full], np.searchsorted(self.starts, at)), axis=1))
            go = full & ~done
            q, lo, hi, j = q[go], a[go], b[go], j[go] - 1
        return np.concatenate(ended) if ended else np.zeros((0, 2), np.int64)


def _searched(table: pa.Table) -> pa.Table:
    """Per search of a group: near words in it, and the commonest of them."""
    front = table.column("side")[0].as_py() == 0
    word, n = table.column("word").to_pylist(), table.column("n").to_pylist()
    count = {w: x for w, x, entry in zip(word, n, table.column("entry").to_pylist(), strict=True) if entry}
    words = sorted(count)  # so the least number among equals is the least word
    asked = sorted({w for w, a in zip(word, table.column("asks").to_pylist(), strict=True) if a}, key=len)
    turn = (lambda w: w[::-1]) if front else (lambda w: w)
    index = Index([turn(w) for w in words])
    counts = np.array([count[w] for w in words], np.int64)
    who, where = [], []
    at = 0
    while at < len(asked):  # as many searches at a time as SEARCHED code points allow
        end = at + max(1, SEARCHED // (len(asked[at]) + 1))
        some = asked[at:end]
        q, w = index.near([turn(x) for x in some], [len(x) // 2 if front else len(x) - len(x) // 2 for x in some])
        if not front:  # those with the front half, too, are found from the front
            new = np.fromiter((not words[b].startswith(some[a][: len(some[a]) // 2]) for a, b in zip(q.tolist(), w.tolist(), strict=True)), bool, len(q))
            q, w = q[new], w[new]
        who.append(q + at)
        where.append(w)
        at = end
    q, w = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, where))
    order = np.lexsort((w, -counts[w], q))
    q, w = q[order], w[order]
    first, near = np.unique(q, return_index=True, return_counts=True)[1:]
    return pa.table({
        "word": pa.array([asked[i] for i in q[first].tolist()], pa.string()), "n_near": pa.array(near, pa.int64()),
        "best_n": pa.array(counts[w[first]], pa.int64()), "best": pa.array([words[i] for i in w[first].tolist()], pa.string()),
    })


def _halves(word: Column) -> Column:
    """Per direction, every half under which a word may be found, and whether it asks there, too."""
    m = F.char_length(word)
    front = lambda size: F.floor(size / 2).cast("int")
    back = lambda size: (size - F.floor(size / 2)).cast("int")
    lengths = lambda half: F.array_distinct(F.array(half(m - 1), half(m), half(m + 1)))
    one = lambda side, half, cut: F.transform(
        lengths(half), lambda k: F.struct(F.lit(side).alias("side"), cut(k).alias("half"), (k == half(m)).alias("asks"))
    )
    return F.concat(
        one(0, front, lambda k: F.substring(word, F.lit(1), k)),
        one(1, back, lambda k: F.when(k > 0, F.substring(word, -k, k)).otherwise(F.lit(""))),
    )


def near_words(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best) of words with a word at one code point's distance; ``best`` is
    (-n, word) of the commonest, the least of equals.

    A group holds the words of many halves, or a part of one half of more than ``block``
    code points. Those halves are at most the vocabulary's code points / block in number, which
    bounds what is broadcast.
    """
    rows = vocab.select("word", "n", F.explode(_halves(F.col("word"))).alias("h")).select("word", "n", "h.*")
    weight = F.sum(F.char_length("word") + 1)
    total = rows.agg(weight).first()[0] or 0
    large = materialize(
        rows.groupBy("side", "half").agg(weight.alias("weight")).filter(F.col("weight") > block)
        .select("side", "half", F.ceil(F.col("weight") / block).cast("int").alias("parts")), "large_halves",
    )
    groups = 1 + total // block
    tasks = groups + (large.agg(F.sum(F.col("parts") * F.col("parts"))).first()[0] or 0)
    rows = rows.join(F.broadcast(large), ["side", "half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    to = lambda i, j, entry, asks: F.struct(i.alias("i"), j.alias("j"), entry.alias("entry"), asks.alias("asks"))
    dealt = F.concat(
        F.transform(every, lambda t: to(F.col("own"), t, F.lit(True), F.col("asks") & (t == F.col("own")))),
        F.transform(
            F.filter(every, lambda t: F.col("asks") & (t != F.col("own"))), lambda t: to(t, F.col("own"), F.lit(False), F.lit(True))
        ),
    )
    whole = F.col("parts") == 1
    keys = [
        F.col("side"), F.when(whole, F.pmod(F.xxhash64("half"), F.lit(groups))).otherwise(F.lit(-1)).alias("shard"),
        F.when(whole, F.lit("")).otherwise(F.col("half")).alias("hot"),
    ]
    placed = rows.select(*keys, "word", "n", F.explode(dealt).alias("d")).select("side", "shard", "hot", "word", "n", "d.*")
    names = ["side", "shard", "hot", "i", "j"]
    found = placed.repartition(int(min(2 * tasks, 1 << 16)), *names).groupBy(*names).applyInArrow(
        _searched, "word string, n_near long, best_n long, best string"
    )
    best = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(best).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form) links without cycles, every hop twice as long as the last."""
    now = materialize(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        hop = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = materialize(now.join(hop, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if further.filter("moved").isEmpty():
            return further.select("word", "root")
        now = further.select("word", "root")


def variants(vocab: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of a (word, n) vocabulary.

    The form is the commonest near word, the least of equals, if it has ``ratio`` times the
    occurrences; the root is where the forms lead. An empty vocabulary has no rows."""
    vocab = materialize(vocab.select("word", "n"), "vocabulary")
    found = near_words(vocab, block).select("word", F.lit(None).cast("long").alias("n"), "n_near", "best")
    both = vocab.unionByName(found, allowMissingColumns=True).groupBy("word").agg(
        F.max("n").alias("n"), F.coalesce(F.sum("n_near"), F.lit(0)).alias("n_near"), F.min("best").alias("best")
    )
    is_form = -F.col("best.n") >= ratio * F.col("n")
    told = materialize(both.select(
        "word", "n", "n_near", F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n")
    ), "variants")
    ends = roots(told.filter(F.col("form").isNotNull()))
    return told.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
