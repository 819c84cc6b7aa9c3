import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from drover.llm import neardup, repeats, shingles, topk
from drover.llm.components import components

VOCABULARY = [f"w{i}é" if i % 9 == 0 else f"word{i}" for i in range(400)]


def corpus(seed=4, groups=12, copies=9, length=60):
    """Exact and near copies of base texts, chains of edits, short texts and blanks."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [rng.choice(VOCABULARY) for _ in range(rng.randint(4, length))]
        rows.append(" ".join(base))
        now = list(base)
        for _ in range(rng.randint(0, copies)):
            edited = list(rng.choice([base, now]))
            if rng.random() < 0.7 and len(edited) > 1:
                edited[rng.randrange(len(edited))] = rng.choice(VOCABULARY)
            now = edited
            rows.append((" " if rng.random() < 0.5 else "\n").join(edited).upper() if rng.random() < 0.3 else " ".join(edited))
    rows += ["one", "one two", "ONE TWO", "", " \n ", None, None, "x " * 3000, "x " * 3001]
    rng.shuffle(rows)
    return list(enumerate(rows))


def words(text):
    return ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")).encode().split()


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("width", "percent", "chunk"), [(3, 85, 4096), (5, 80, 4096), (3, 85, 4)])
def test_near_duplicates_against_brute_force(docs, monkeypatch, width, percent, chunk):
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    monkeypatch.setattr(neardup, "STAR", 3)
    rows = corpus()
    got = neardup.near_duplicates(docs(rows), width=width, percent=percent).collect()
    want = brute_components(rows, width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def bridged(tag):
    """A text, 50 longer copies and 5 shorter ones: the shorter ones are linked with the text only,
    and the copies are the centre of nearly every bucket that holds it."""
    base = [f"{tag}a{k}" for k in range(201)]
    longer = [" ".join([*base, f"{tag}x", f"{tag}y", f"{tag}z", f"{tag}own{i}"]) for i in range(50)]
    return [" ".join(base), *longer, *(" ".join([*base[:172], f"{tag}end{i}"]) for i in range(5))]


@pytest.mark.parametrize("chunk", [4096, 8])
def test_near_duplicates_linked_between_two_stars(docs, monkeypatch, chunk):
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rows = list(enumerate(t for tag in "pqrs" for t in bridged(tag)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(rows)).collect()}
    assert got == brute_components(rows, 3, 85)
    assert len({c for _, c in got.values()}) == 4


def test_one_stray_does_not_send_all_texts_to_each_other(spark, docs, monkeypatch):
    docs([])
    monkeypatch.setattr(neardup, "CROSS", 10)
    texts = [" ".join(f"w{k}" for k in range(100))[: 380 - i] for i in range(60)] + [" ".join(f"w{k}" for k in range(50))]
    node = [int.from_bytes(shingles.digest(shingles.shingles(t, 3))[:8], "little", signed=True) for t in texts]
    node, texts = zip(*{n: t for n, t in zip(node, texts, strict=True)}.items(), strict=True)
    seen = spark.sparkContext.accumulator(0)

    def counted(width, percent):
        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch.select(["node", "label"]).rename_columns(["a", "b"]).slice(0, 0)
        return run

    monkeypatch.setattr(neardup, "_crossed", counted)
    edges = spark.createDataFrame([(node[0], x) for x in node[1:]], "a long, b long")
    links = spark.createDataFrame([(node[0], x) for x in node[1:-1]], "a long, b long")
    frame = spark.createDataFrame(list(zip(node, texts, strict=True)), "node long, text string")
    neardup.across(edges, links, frame, 3, 85).collect()
    blocks = -(-(len(node) - 1) // 10)
    assert seen.value == len(node) + blocks  # the others once, the stray once a block and once for strays


def test_stars_hold_together_what_may_be_linked():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, 96)
    sigs = np.array([np.where(rng.random(96) < rng.choice([0.02, 0.2, 0.5]), rng.integers(0, 256, 96), base) for _ in range(120)], np.uint8)
    sizes = rng.integers(100, 260, 120)
    edges, _ = neardup.stars(np.arange(120), sizes, sigs, 85)
    assert len(edges) < 2 * 120
    root = list(range(120))
    for a, b in edges:
        root = [root[a] if r == root[b] else r for r in root]
    for a in range(120):
        for b in range(a):
            if 100 * min(sizes[a], sizes[b]) >= 85 * max(sizes[a], sizes[b]) and (sigs[a] == sigs[b]).mean() >= 0.85 - neardup.MARGIN:
                assert root[a] == root[b]


def test_near_duplicates_odd_keys(docs):
    long = " ".join(VOCABULARY)
    rows = [(None, long), (3, long), (3, long), (2, None), (None, None), (9, "alone here now"), (9, "another text altogether")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted([(None, 3, False), (3, 3, True), (3, 3, True), (2, 2, True), (None, None, True), (9, 9, True), (9, 9, True)], key=str)
    assert neardup.near_duplicates(docs([])).count() == 0


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (800, 100, 100))
    one, two = np.unique(np.append(common, a)), np.unique(np.append(common, b))
    assert abs((shingles.signature(one) == shingles.signature(two)).mean() - 0.8) < 0.15
    for n in (1, 2, 5):
        few = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert set(shingles.signature(few)) <= set((shingles.mix64(few) >> np.uint64(32)).astype(np.uint32))


def test_stars_stay_linear_and_keep_the_group():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, 96)
    sigs = np.array([np.where(rng.random(96) < 0.1, rng.integers(0, 256, 96), base) for _ in range(500)], np.uint8)
    edges, _ = neardup.stars(np.arange(500), np.full(500, 300), sigs, 85)
    assert len(edges) < 2 * 500


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (7, 7), (500, 400)] + [(1000, 1000 + i) for i in range(1, 50)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r.node: r.root for r in components(df).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[300] == 100 and got[500] == got[400] == 400 and all(got[1000 + i] == 1000 for i in range(50))
    assert components(df.limit(0)).count() == 0


# ---- repeated strings ----------------------------------------------------------------


def brute_repeats(rows, length):
    texts = sorted(((i, (t or "").encode()) for i, t in rows), key=lambda r: r[0])
    first = {}
    for i, b in texts:
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    out = {}
    for i, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = [True] * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("length", "sorted_at_once"), [(50, 1 << 15), (24, 3)])
def test_repeats_against_brute_force(docs, monkeypatch, length, sorted_at_once):
    monkeypatch.setattr(repeats, "SORTED", sorted_at_once)
    rng = random.Random(6)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(20, 130))) for _ in range(8)] + ["a" * 120, "ab" * 60]
    texts = ["".join(rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("abcdef ") for _ in range(40)) for _ in range(rng.randint(0, 6))) for _ in range(60)]
    rows = list(enumerate([*texts, None, "", "x" * 49, "x" * 50, "x" * 400, "x" * 300, texts[3], texts[3]]))
    rng.shuffle(rows)
    got = repeats.remove_repeats(docs(rows).repartition(4), length=length).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_repeats(rows, length)
    for r in got:
        text = (dict(rows)[r.doc_id] or "").encode()
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and len(r.text.encode()) <= len(text) - r.n_removed


def test_repeats_odd_keys(docs):
    t = "the same fifty bytes and more of them in every one of these texts"
    got = sorted((str(r.doc_id), r.n_removed) for r in repeats.remove_repeats(docs([(5, t), (5, t), (None, t), (None, t), (7, None)])).collect())
    assert got == [("5", 0), ("5", 0), ("7", 0), ("None", len(t)), ("None", len(t))]
    assert repeats.remove_repeats(docs([])).count() == 0


def test_log_index_levels():
    rng = random.Random(8)
    index, seen, told = repeats.LogIndex(), {}, set()
    for batch in range(40):
        run = np.unique(np.array([rng.randrange(500) for _ in range(rng.randint(1, 30))], np.uint32))
        hits, owners = index.add(run, batch)
        assert sorted(hits) == sorted(k for k in run if k in seen)
        expected = {k for k in hits if k not in told}
        assert {(b, k) for b, ks in owners for k in ks} == {(seen[k], k) for k in expected}
        told |= expected
        for k in run:
            seen.setdefault(k, batch)
    sizes = [len(level[0]) for level in index.levels]
    assert sum(sizes) == len(seen) and all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))


# ---- exact search --------------------------------------------------------------------


@pytest.mark.parametrize(("seed", "scale"), [(1, 1.0), (2, 0.01)])
def test_top_k_against_brute_force(spark, docs, monkeypatch, seed, scale):
    docs([])
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(300, 40)) * scale * rng.choice([0.2, 1, 3], size=(300, 1))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(400, None), (420, [float("nan")] * 40), (440, [float("inf")] * 40), (None, rows[0][1]), (460, []), (480, [1.0] * 3), (481, [2.0] * 3), (482, [None] * 40)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, rank string, id string")
    got = {}
    for r in topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    q = np.floor(64 * np.array([r[1] for r in rows[:300]], np.float32).astype(float))
    for i in range(0, 300, 20):
        scores = (q @ q[i]).astype(int)
        order = [j for j in sorted(range(300), key=lambda j: (-scores[j], j)) if j != i][:7]
        assert sorted(got[i]) == [(k + 1, j, scores[j]) for k, j in enumerate(order)]
    assert got[480] == [(1, 481, 64 * 128 * 3)] and set(got) == {*range(0, 300, 20), 480}
    assert topk.top_k(df.limit(0), "vec_id", "embedding", F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_ties_and_repeats(spark, docs):
    docs([])
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(5, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r.vec_id) for r in topk.top_k(df, "vec_id", "embedding", F.col("vec_id") == 0, k=6).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5)]


# ---- pipeline ------------------------------------------------------------------------

ODD = [(900, None, None, None), (901, "", "en", "a"), (902, "12 34 !!", "de", "b"), (None, "the river and the house stand under water", "en", None)]


def test_pipeline_stages(spark, docs):
    base = "the quick river runs under the old house and the stones that lie with water are dark and smooth"
    rows = [(i, f"{base} {i % 3} {VOCABULARY[i]} {VOCABULARY[i + 1]} {VOCABULARY[2 * i]} " * 3, "en", "ab"[i % 2]) for i in range(30)]
    rows += [(50, rows[3][1], "en", "b"), (51, rows[3][1] + " x", "en", "a"), (3, rows[3][1], "en", "b"), (60, "write to some.one@mail.example.com or the house", "en", "c"), *ODD]
    now, seen = docs(rows), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        now = stage(spark, now, None)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == corpus_pipeline.COLUMNS
        now = spark.createDataFrame(now.collect(), now.schema)
        seen.append(name)
        ids = sorted(r[0] for r in now.select("doc_id").collect() if r[0] is not None)
        if name == "language_id":
            assert not {900, 901, 902} & set(ids) and now.count() == before.count() - 3
        if name == "near_dedup":
            want = brute_components([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect() if r.doc_id is not None], 5, 80)
            assert ids == sorted({c for _, c in want.values()}) and now.filter("doc_id IS NULL").count() == 1
        if name == "mask_pii":
            assert now.filter("doc_id = 60").first().text == "write to <EMAIL> or the house" and now.count() == before.count()
        if name == "mix_sources":
            total = before.selectExpr("sum(size(split(trim(text), '\\\\s+')))").first()[0]
            assert abs(now.selectExpr("sum(size(split(trim(text), '\\\\s+')))").first()[0] - 1.5 * total) <= 2
    assert seen == ["language_id", "near_dedup", "mask_pii", "mix_sources", "pack"] and now.count() > 0


def test_pipeline_stages_on_empty_tables(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs([]), None).count() == 0


def test_words_with_equal_sums_stay_apart():
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    hashes = shingles.word_hashes(f"{word} {other} {word}")
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_top_k_floors_hold_back_what_cannot_win(spark, docs, monkeypatch):
    docs([])
    monkeypatch.setattr(topk, "BLOCK", 50)
    monkeypatch.setattr(topk, "SAMPLE", 500)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(1000, 24)) * np.geomspace(0.05, 3, 24)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    q = np.floor(64 * vectors)
    got = {}
    for r in topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for i in range(0, 1000, 50):
        scores = (q @ q[i]).astype(int)
        order = [j for j in sorted(range(1000), key=lambda j: (-scores[j], j)) if j != i][:5]
        assert sorted(got[i]) == [(n + 1, j, scores[j]) for n, j in enumerate(order)]
    ids = np.arange(1000)
    floor = topk.kth_best(ids[:20], q[:20].T, ids[:500], q[:500].T, 5)
    passed = sum(len(x[1]) for a in range(0, 1000, 50) for x in topk.search(ids[:20], q[:20].T, ids[a : a + 50], q[a : a + 50].T, 5, floor))
    assert 20 * 5 <= passed < 20 * 5 * 4  # and not 5 for each query and block


def test_top_k_refuses_what_doubles_cannot_hold(spark, docs):
    docs([])
    df = spark.createDataFrame([(1, [1e9, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="too large"):
        topk.top_k(df, "vec_id", "embedding", F.col("vec_id") == 1)
