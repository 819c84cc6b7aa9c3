"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit
per failed rule, so that any policy, a set of rules under a version name, is applied later
by a bitwise AND, and the effect of each rule is found by aggregating over the masks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.llm.base import ASCII_SPACE, extended, schema_of, text_column

# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_letters", "n_top_word", "n_stutter",
)


def repeat_words(words: list, width: int = WINDOW) -> int:
    """Words inside a window of ``width`` words that occurs twice or more, the first included."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.fromiter((i for i, w in enumerate(windows) if seen[w] > 1), np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + width, -1)
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of :data:`MEASURES`."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # splits bytes at ASCII white space only
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    codes = np.frombuffer(raw, np.uint8)
    upper = int(((codes >= 65) & (codes <= 90)).sum())
    lower = int(((codes >= 97) & (codes <= 122)).sum())
    return (
        len(words),
        len(text) - sum(text.count(c) for c in ASCII_SPACE),
        sum(text.count(c) for c in SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
        upper,
        upper + lower,
        max(Counter(words).values(), default=0),
        sum(map(eq, words, words[1:])),
    )


def _c(name: str) -> Column:
    return F.col(name)




def rules() -> dict[int, tuple[str, Column]]:
    """Bit number -> (name, condition of failure). A number is never used again for another rule."""
    long_enough = _c("n_words") >= 10
    return {
        0: ("few_words", _c("n_words") < 10),
        1: ("repeated_windows", 100 * _c("n_repeat_words") > 20 * _c("n_words")),
        2: ("symbols", 10 * _c("n_symbols") > _c("n_words")),
        3: ("repeated_lines", (2 * _c("n_dup_lines") > _c("n_lines")) & (_c("n_lines") >= 4)),
        4: ("shouting", (10 * _c("n_upper") > 4 * _c("n_letters")) & (_c("n_letters") > 0) & long_enough),
        5: ("one_word", (10 * _c("n_top_word") > 3 * _c("n_words")) & long_enough),
        6: ("stutter", (10 * _c("n_stutter") > 3 * _c("n_words")) & long_enough),
        7: ("word_length", (_c("word_chars") < 2 * _c("n_words")) | (_c("word_chars") > 20 * _c("n_words"))),
    }


#: Policy version -> bits whose failure rejects a document.
POLICIES = {"base": 0b11, "v1": 0b111111, "v2": 0b11111111}


def ledger(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, all measurements and ``failed``, a long with bit N set where rule N
    failed. A null text is measured as empty, which fails rule 0. One pass, no shuffle."""
    read, thin = text_column(df, keep, text)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column(read)]
            columns = zip(*rows, strict=True) if rows else [()] * len(MEASURES)
            yield extended(batch, keep, **{m: pa.array(c, pa.int64()) for m, c in zip(MEASURES, columns, strict=True)})

    book = thin.mapInArrow(measured, schema_of(thin, keep, ", ".join(f"{m} long" for m in MEASURES)))
    bits = [F.when(F.coalesce(cond, F.lit(False)), F.lit(1 << n)).otherwise(F.lit(0)) for n, (_, cond) in rules().items()]
    mask = bits[0].cast("long")
    for b in bits[1:]:
        mask = mask.bitwiseOR(b.cast("long"))
    return book.withColumn("failed", mask)


def verdict(policy: str) -> Column:
    """True where no rule of the policy failed."""
    return _c("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail nothing else, and that the
    policy keeps with the rule taken out. Documents are first counted by mask, at most
    one row per mask and task, so the rules fan out over masks and not over documents."""
    bits = [n for n in rules() if POLICIES[policy] >> n & 1]
    masks = book.groupBy("failed").agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("bit"), F.lit(rules()[n][0]).alias("rule")) for n in bits]))
    hit = masks.select("failed", "n", each.alias("r")).select("failed", "n", "r.*")
    own = F.expr("shiftleft(1L, bit)")
    within = _c("failed").bitwiseAND(F.lit(POLICIES[policy]))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, _c("n"))), F.lit(0))
    return hit.groupBy("bit", "rule").agg(
        total(within.bitwiseAND(own) != 0).alias("n_failed"),
        total(within == own).alias("n_only"),
        total(within.bitwiseAND(F.bitwise_not(own)) == 0).alias("n_kept_without"),
        F.bit_or(within).alias("seen_bits"),
    )
