import random
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from drover.llm import mixing, packing, sharding
from drover.llm.base import words_in
from drover.llm.queries import QUERIES
from drover.llm.tokens import Encoder, encoded

PATH = public_tokenizers.path("byte_bpe_50k.json")


# ---- resharding ----------------------------------------------------------------------


def brute_cost(supply, demand, cost):
    """The cheapest flow by trying unit by unit with every order of targets (small cases)."""
    from functools import cache

    @cache
    def best(i, left, room):
        if i == len(supply):
            return 0
        if not left:
            return best(i + 1, supply[i + 1] if i + 1 < len(supply) else 0, room)
        return min(
            cost(i, j) + best(i, left - 1, (*room[:j], room[j] - 1, *room[j + 1 :])) for j in range(len(room)) if room[j]
        )

    return best(0, supply[0], tuple(demand))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=3), st.integers(1, 3), st.randoms())
def test_flow_is_cheapest(supply, m, rnd):
    total = sum(supply)
    cuts = sorted(rnd.randint(0, total) for _ in range(m - 1))
    demand = [b - a for a, b in zip([0, *cuts], [*cuts, total], strict=True)]
    table = {(i, j): rnd.randint(0, 5) for i in range(len(supply)) for j in range(m)}
    flow = sharding.min_cost_flow(supply, demand, lambda i, j: table[i, j])
    assert [sum(v for (a, _), v in flow.items() if a == i) for i in range(len(supply))] == supply
    assert [sum(v for (_, b), v in flow.items() if b == j) for j in range(m)] == demand
    assert sum(table[k] * v for k, v in flow.items()) == brute_cost(tuple(supply), demand, lambda i, j: table[i, j])


def test_flow_keeps_what_can_stay():
    flow = sharding.min_cost_flow([100, 20, 0], [40, 40, 40], lambda i, j: int(i != j))
    assert flow[0, 0] == 40 and flow[1, 1] == 20 and sum(v for (i, j), v in flow.items() if i != j) == 60


def test_reshard(spark, docs, tmp_path):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randint(0, 90), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    rows += [(900, None), (901, ""), (902, "é" * 3000), (None, "n"), (5, rows[5][1]), (5, rows[5][1])]
    df = docs(rows)
    old = F.pmod(F.crc32("source"), F.lit(4))
    out, made = sharding.reshard(df, old, F.octet_length("text") + 8, ["doc_id"], 4, 6, blocks=64)
    got = out.select("doc_id", "size", "old_shard", "shard", "slot").collect()
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None and r.doc_id != 5) == sorted(
        (r[0], 0 if r[1] is None else len(r[1].encode()) + 8) for r in rows if r[0] is not None and r[0] != 5)
    by = {j: [r for r in got if r.shard == j] for j in range(6)}
    for j, own in by.items():
        assert sorted(r.slot for r in own) == list(range(len(own))) and sum(r["size"] for r in own) == made.sizes[j]
    mean = sum(made.sizes) / 6
    assert max(made.sizes) - min(made.sizes) < 0.05 * mean + 6000
    # Only what the flow says leaves its shard, up to the block that a border falls into.
    assert sum(r["size"] for r in got if r.shard != r.old_shard) <= made.moved * 1.1 + 6000
    manifest = {r.shard: r.folder for r in sharding.rewrite(out, made, str(tmp_path / "new")).collect()}
    for j, folder in manifest.items():
        if folder:
            assert spark.read.parquet(folder).count() == len(by[j])
        else:
            assert all(r.old_shard == j for r in by[j])


def test_contents_come_from_the_files_of_changed_shards(spark, docs, tmp_path):
    rows = [(i, f"{i} " + "x" * 20, "en", "a") for i in range(400)]
    out, made = sharding.reshard(docs(rows), F.when(F.col("doc_id") < 100, 0).when(F.col("doc_id") < 300, 1).otherwise(2),
                                 F.lit(1), ["doc_id"], 3, 3, capacity=[100, 300, 0], blocks=64)
    assert made.affected == {1, 2}
    manifest = sharding.rewrite(out, made, str(tmp_path / "new"))
    got = sharding.contents(out, made, manifest)
    assert sorted((r.doc_id, r.text, r.shard) for r in got.collect()) == [(r[0], r[1], int(r[0] >= 100)) for r in rows]
    assert sorted(r.slot for r in got.filter("shard = 1").collect()) == list(range(300))
    assert {f.rsplit("/", 2)[-2] for f in got.inputFiles()} == {"shard=1"}


def test_resharding_query_reads_the_rewritten_texts(spark, docs, tmp_path):
    rows = [(i, f"{i} é " + "x" * (i % 50), "en", f"s{i % 5}") for i in range(300)] + [(300, None), (None, "n"), (5, "again")]
    docs(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op1_reshard_min_cost_flow"](spark, str(tmp_path))
    got = out.collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows), key=str)
    for j in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == j) == list(range(sum(r.shard == j for r in got)))
    files = [f for f in out.inputFiles() if "/shard=" in f]
    assert files and "documents.parquet" not in " ".join(files)
    written = spark.read.parquet(*files).select("doc_id", "text", "lang", "source", "n_chars", "slot")
    assert sorted(((r.doc_id, r.text) for r in written.collect()), key=str) == sorted(((r[0], r[1]) for r in rows), key=str)


def test_reshard_again_moves_nothing(docs):
    df = docs([(i, "x" * 20) for i in range(240)])
    out, made = sharding.reshard(df, F.pmod("doc_id", F.lit(4)), F.length("text"), ["doc_id"], 4, 4)
    assert made.moved == 0 and not made.affected
    empty, made = sharding.reshard(docs([]), F.lit(0), F.length("text"), ["doc_id"], 2, 3)
    assert empty.count() == 0 and made.sizes == [0, 0, 0]


# ---- mixing --------------------------------------------------------------------------


def brute_mix(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    sizes = {}
    for _, n, s in rows:
        sizes[s] = sizes.get(s, 0) + n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped, level = sum(sizes.values()), set(), 0.0
    while len(capped) < len(order):
        level = (share * total - sum(most * sizes[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if most * sizes[s] <= weight[s] * level}
        if over <= capped:
            break
        capped |= over
    return {s: min(most * sizes[s], weight[s] * level) for s in order}, sizes


@pytest.mark.parametrize("slices", [1, 3, 2048])
def test_mix(docs, monkeypatch, slices):
    monkeypatch.setattr(mixing, "RANGE_ROWS", slices)
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 40), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    df = docs([(i, None if n == 0 else " ".join(["w"] * n), "en", s) for i, n, s in rows] + [(300, " \n", "en", "zero"), (300, " \n", "en", "zero")])
    out = mixing.mix(df, words_in(F.col("text")), mixing.random_key("doc_id"))
    got = out.select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    targets, sizes = brute_mix([*rows, (300, 0, "zero")])
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source]) and 0 <= r.taken <= 2 * r["size"]
    for s, target in targets.items():
        assert sum(r.taken for r in got if r.source == s) == int(target + 0.5)
    again = mixing.mix(df.repartition(7), words_in(F.col("text")), mixing.random_key("doc_id")).select("doc_id", "taken")
    assert sorted(map(tuple, again.collect())) == sorted((r.doc_id, r.taken) for r in got)
    assert mixing.mix(docs([]), words_in(F.col("text")), mixing.random_key("doc_id")).count() == 0


# ---- packing -------------------------------------------------------------------------

ODD = [
    "", "'s it's don't 'tis ''s we're they'll I'd x'y'z  a  b\n\nc \n d\t e  ", "   ", "\n", " ' s", " 's", "a's'", "a'st b're!", "日本語 テスト123 ½²",
    "a b c", "<|endoftext|> x", "é́ naïve Ⅷ", "'", "a'", "'r", "'re", "!'s", "!!'s ?'ll", "\x00 a\x00b", "a  's", "😀😀 x's😀", "\r\n x\r\n\r\ny",
]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_tokenizers(tokenizer):
    want = [tokenizer.encode(x, add_special_tokens=False).ids for x in ODD]
    assert [list(x) for x in encoded(Encoder(PATH), ODD)] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab' \n\t.,1é 日sretml'\"", max_size=40), max_size=5))
def test_ids_of_any_text(texts):
    global _encoder, _tokenizer
    _tokenizer = globals().get("_tokenizer") or Tokenizer.from_file(PATH)
    _encoder = globals().get("_encoder") or Encoder(PATH)
    assert [list(x) for x in encoded(_encoder, texts)] == [_tokenizer.encode(x, add_special_tokens=False).ids for x in texts]


def test_long_texts_are_cut_where_a_piece_begins(tokenizer, monkeypatch):
    from drover.llm import tokens

    monkeypatch.setattr(tokens, "CHUNK", 64)
    monkeypatch.setattr(tokens.chunks, "__defaults__", (64,))
    text = "word it's  and\n\n more 123 " * 30 + "y" * 200
    assert list(next(encoded(Encoder(PATH), [text]))) == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_have_their_own_ids(docs):
    own = Tokenizer.from_file(PATH)
    texts = [*ODD, "<|endoftext|>", "a <|endoftext|><|endoftext|> 's\n", "<|endoftext", "it'<|endoftext|>s", "x <|endoftext|>"]
    want = [own.encode(x, add_special_tokens=False).ids for x in texts]
    assert [list(x) for x in encoded(Encoder(PATH, added=True), texts)] == want
    got = packing.pack(docs([(0, "<|endoftext|> x"), (1, "y")]), PATH).collect()
    tokens = {r.doc_id: r.doc_tokens for r in got}
    assert tokens[0] - tokens[1] == 1  # two ids against one


def test_pack_round_trip(docs, tokenizer):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["alpha", "béta", "c", "12", "\n"]) for _ in range(rng.choice([0, 3, 40, 700, 3000])))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, "no key"), (7, rows[7][1])]
    out = packing.pack(docs(rows).repartition(3), PATH).collect()
    assert set(out[0].asDict()) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    sequences, pieces = {}, {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
        pieces.setdefault(r.doc_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))] and sum(r.length for r in own) <= 2048
    assert sum(sum(r.length for r in own) < 2048 for own in sequences.values()) == 1  # one group of partitions
    for i, text in rows:
        if i == 7:
            continue
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(pieces[i], key=lambda r: r.start)
        assert own[0].start == 0 and own[0].doc_tokens == len(ids)
        for r, after in zip(own, [*[x.start for x in own[1:]], len(ids)], strict=True):
            part = ids[r.start : r.start + r.length]
            assert r.start + r.length == after and zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == r.ids_crc32
    assert sum(r.length for r in pieces[7]) == 2 * pieces[7][0].doc_tokens  # equal rows are packed each on their own
    assert packing.pack(docs([]), PATH).count() == 0


def test_full_windows_are_emitted_and_few_stay_open():
    import numpy as np

    w = packing.Windows(length=10, most=3)
    full = [p for k, n in enumerate([7, 8, 9, 4, 25, 1, 3]) for p in w.add(k, np.arange(n))]
    assert all(sum(len(x[2]) for x in p) == 10 for p in full) and len(w.open) <= 3
    more, rest = w.close()
    assert sum(len(x[2]) for p in [*full, *more, rest] for x in p) == 57


def thue_morse(n, a, b):
    word = a
    while len(word) < n:
        word += word.translate(str.maketrans(a + b, b + a))
    return word


def test_pieces_with_equal_sums_keep_their_ids(tokenizer):
    """Modulo a power of two these words and their complements have one hash for any base."""
    texts = [thue_morse(n, a, b) for n in (1024, 2048, 4096) for a, b in ("ab", "ba")]
    for got, text in zip(encoded(Encoder(PATH), texts), texts, strict=True):
        assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_leftovers_keep_large_keys_beside_a_null(spark, docs):
    keys = [9007199254740993, None, 9007199254740995, 2**62 + 1, -(2**62) - 1, 3]
    df = docs([(k, f"text number {i} of a few words") for i, k in enumerate(keys)]).repartition(len(keys))
    out = packing.pack(df, PATH).collect()
    assert sorted((r.doc_id for r in out), key=str) == sorted(keys, key=str)
    assert len({r.sequence_id for r in out}) == 1 and len({r.offset for r in out}) == len(keys)


def test_equal_rows_are_spread_over_the_shards(spark, docs, tmp_path):
    docs([(1, "the same text, twice the same") for _ in range(200)] + [(None, None)] * 60 + [(2, "x" * 3000)] * 5).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op1_reshard_min_cost_flow"](spark, str(tmp_path)).collect()
    sizes = [sum(r.size for r in rows if r.shard == k) for k in range(24)]
    whole = sum(sizes)
    assert len(rows) == 265 and max(sizes) - min(sizes) <= 3008 and max(s for s in sizes) <= whole / 24 + 3008
    small = [s for k, s in enumerate(sizes) if not any(r.shard == k and r.size > 3000 for r in rows)]
    assert max(small) - min(small) <= 2 * 37
    for k in range(24):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
