import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from drover.llm import factorization, merkle, spelling

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


# ---- Merkle manifest -----------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def beside(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 8 * 8
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 8])))
        i //= 8
    return out


def brute_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r)))
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([x[2] for x in sorted(by[g])]) for g in langs}
    top = levels_of([trees[g][-1][0] for g in langs])
    out = []
    for j, g in enumerate(langs):
        for i, (real, key, leaf) in enumerate(sorted(by[g])):
            steps = beside(trees[g], i) + beside(top, j)
            out.append((key if real else None, leaf, trees[g][-1][0], top[-1][0], steps))
    return sorted(out, key=repr)


def manifest_rows(docs_df, **more):
    got = merkle.manifest(docs_df, FIELDS, **more).select("doc_id", "leaf", "subroot", "root", "steps").collect()
    return sorted(((*r[:4], [tuple(s) for s in r.steps]) for r in got), key=repr)


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_manifest_against_brute_force(docs, digits):
    rng = random.Random(digits)
    texts = [None, "", "Ärger", "x" * 50_000, "A b\nC", "- 1:x"]
    rows = [(i if i % 9 else None, rng.choice(texts), rng.choice(["en"] * 6 + ["de", None, "é"]), rng.choice(["a", None])) for i in range(170)]
    rows += [(5, "same", "en", "a")] * 30 + [(i, "t", f"l{i}", "a") for i in range(11)]  # equal rows, and more groups than a node takes
    df = docs(rows)
    want = brute_manifest([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()])
    assert manifest_rows(df, digits=digits) == want


def test_manifest_small_tables(docs):
    assert manifest_rows(docs([])) == []
    got = merkle.manifest(docs([(1, "a")]), FIELDS).withColumn("p", merkle.digest(merkle.proof(F.col("steps")))).first()
    assert got.leaf == got.subroot == got.root and got.steps == [] and got.p == H("")


def test_a_changed_row_does_not_fold_to_the_root(docs):
    rows = [(i, f"Text {i}") for i in range(40)]
    df = docs(rows)
    low = merkle.leaf([F.lower("text") if f == "text" else F.col(f) for f in FIELDS])
    out = merkle.manifest(df, FIELDS, carry={"other": low}, digits=1)
    got = out.select(
        (merkle.folded(F.col("leaf"), F.col("steps")) == F.col("root")).alias("same"),
        (merkle.folded(F.col("other"), F.col("steps")) == F.col("root")).alias("changed"),
    ).collect()
    assert len(got) == 40 and all(r.same and not r.changed for r in got)


def test_depth_at_the_powers_of_eight(spark):
    sizes = [1, 2, 8, 9, 64, 65, 512, 513, 8**9, 8**9 + 1]
    got = spark.createDataFrame([(s,) for s in sizes], "s long").select(merkle.depth(F.col("s"))).collect()
    assert [r[0] for r in got] == [0, 1, 1, 2, 2, 3, 3, 4, 9, 10]


# ---- factorisation machine -----------------------------------------------------------


def some_documents(n=300, seed=3):
    rng = random.Random(seed)
    words = "river stone bridge water house garden light under over along quiet narrow wide green old".split()
    out = []
    for i in range(n):
        if i % 4 == 0:
            word = rng.choice(words)
            out.append((i, f"{word} " * rng.randint(20, 60), 0))
        else:
            out.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(20, 60))).capitalize() + ".", 1))
    return out


def test_machine_scores_all_pairs():
    rng = np.random.default_rng(1)
    m = factorization.Machine(0.3, rng.normal(size=20), rng.normal(size=(20, 4)))
    index, value, starts = np.array([1, 5, 7, 2, 19, 3]), rng.normal(size=6), np.array([0, 3, 5])
    want = []
    for a, b in ((0, 3), (3, 5), (5, 6)):
        pairs = sum(m.factors[index[i]] @ m.factors[index[j]] * value[i] * value[j] for i in range(a, b) for j in range(i + 1, b))
        want.append(m.bias + sum(m.linear[index[i]] * value[i] for i in range(a, b)) + pairs)
    assert np.allclose(m.margins(starts, index, value)[0], want)


def test_machine_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(2)
    m = factorization.Machine(0.1, rng.normal(size=12), rng.normal(size=(12, 3)))
    starts, index, value, label = np.array([0, 3]), np.array([0, 4, 7, 4, 11]), rng.normal(size=5), np.array([1.0, 0.0])

    def loss():
        p = factorization.logistic(m.margins(starts, index, value)[0])
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    bias, linear, factors = factorization.gradients(m, starts, index, value, label)
    for where, at, grad in ((m.linear, 4, linear[4]), (m.factors, (4, 1), factors[4, 1]), (m.factors, (0, 2), factors[0, 2])):
        before = where[at]
        where[at] = before + 1e-6
        up = loss()
        where[at] = before - 1e-6
        down = loss()
        where[at] = before
        assert abs((up - down) / 2e-6 - grad) < 1e-5
    assert abs(bias - (factorization.logistic(m.margins(starts, index, value)[0]) - label).mean()) < 1e-12


def test_classifier_on_held_out_documents(spark, docs):
    rows = some_documents()
    df = docs([*((i, t) for i, t, _ in rows), (900, None), (901, ""), (902, "river " * 100_000), (None, "a quiet house"), (1, rows[1][1])])
    held = factorization.held_out(F.col("doc_id"))
    labels = spark.createDataFrame([*((i, q) for i, _, q in rows), (None, 1), (2, None), (903, 0), (4, 0), (4, 0)], "doc_id long, label int")
    train = lambda: factorization.train(df.filter(~held), labels.join(df.filter(~held).select("doc_id").distinct(), "doc_id", "left_semi"))
    machine, again = train(), train()
    assert machine.bias == again.bias and (machine.factors == again.factors).all()
    out = factorization.predict(df, machine, ["doc_id", "score"])
    assert out.columns == ["doc_id", "score", "predicted"]
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == 305 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    test = [(i, q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i].predicted == q for i, q in test]) > 0.95 and got[902].predicted == 0


def test_classifier_without_labels_or_documents(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, label int")
    machine = factorization.train(docs([(1, "a")]), labels)
    assert [r.score for r in factorization.predict(docs([(1, "a b"), (2, None)]), machine, ["doc_id"]).collect()] == [0.5, 0.5]
    assert factorization.predict(docs([]), machine, ["doc_id"]).count() == 0


# ---- spelling variants ---------------------------------------------------------------


def brute_counts(rows, least=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(vocab):
    near = {w: [x for x in vocab if one_apart(w, x)] for w in vocab}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best is not None and vocab[best] >= 5 * vocab[w] else None
    out = []
    for w in vocab:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, vocab[w], len(near[w]), form[w], vocab.get(form[w]), root))
    return sorted(out)


def a_vocabulary(seed, size=250, letters="abcé", length=(0, 8)):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*length))) for _ in range(size)}
    return {w: rng.choice([5, 5, 6, 30, 200, 1200]) for w in words}


@pytest.mark.parametrize("block", [1 << 17, 2000, 500])
def test_variants_against_brute_force(spark, block):
    vocab = a_vocabulary(block, 100) | {"prefix" + w: n for w, n in a_vocabulary(block + 1, 60).items()} | {"a" * 300: 7, "a" * 301: 70}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    got = spelling.variants(df, block=block).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(tuple(r) for r in got) == brute_variants(vocab)


def test_variants_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0
    one = spelling.variants(spark.createDataFrame([("single", 9)], "word string, n long")).collect()
    assert [tuple(r) for r in one] == [("single", 9, 0, None, None, "single")]


def test_index_intervals_against_brute_force():
    words = sorted(a_vocabulary(5))
    index = spelling.Index(words)
    text = "\1" + "".join(w + "\1" for w in words) + "\0"
    assert index.suffixes.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    known = [len(w) // 2 for w in words]
    q, w = index.near(words, known)
    want = {
        (i, k) for i, a in enumerate(words) for k, b in enumerate(words)
        if b.endswith(a[len(a) - known[i] :]) and one_apart(a[: len(a) - known[i]], b[: len(b) - known[i]])
    }
    assert set(zip(q.tolist(), w.tolist(), strict=True)) == want


@pytest.mark.parametrize("small", [False, True])
def test_vocabulary_against_brute_force(docs, monkeypatch, small):
    rng = random.Random(9)
    base = ["Straßen", "Été", "garden", "GARDEN", "über×weg", "naïvely", "İstanbul", "日本garden", "o'clock", "colour", "x" * 90, "é" * 40, "gardenñ"]
    rows = [(i if i % 50 else None, " ".join(rng.choice(base) + rng.choice(["", ".", "-", "\n"]) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(7, None), (8, ""), (9, "colour " * 60_000), (9, "colour " * 10)]
    if small:
        monkeypatch.setattr(spelling, "PIECE", 50)
        monkeypatch.setattr(spelling, "HELD_CHARS", 100)
        monkeypatch.setattr(spelling, "_SHORT", 10)
        import pyarrow as pa

        batches = [pa.RecordBatch.from_pydict({"key": [None if k is None else str(k) for k, _ in rows], "text": [t for _, t in rows]})]
        counts = Counter()
        for out in spelling._counted(iter(batches)):
            counts.update(dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True)))
        assert {w: n for w, n in counts.items() if n >= 5} == brute_counts(rows)
        return
    got = {r.word: r.n for r in spelling.vocabulary(docs(rows)).collect()}
    assert got == brute_counts(rows) and spelling.vocabulary(docs([])).count() == 0


def test_roots_follow_long_chains(spark):
    links = spark.createDataFrame([(str(i), str(i + 1)) for i in range(13)] + [("x", "5")], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(links).collect()} == {str(i): "13" for i in range(13)} | {"x": "13"}
