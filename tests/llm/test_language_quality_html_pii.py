import random
import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from drover.llm import html, language, pii, quality

WORDS = {
    "en": "the quick house and with water that river stone which under".split(),
    "de": "der schnelle haus und mit wasser dass fluss stein welche unter über".split(),
    "fr": "le rapide maison et avec eau que rivière pierre laquelle sous été".split(),
}


def sentences(seed=1, n=120):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[k]) for _ in range(12)), k) for i in range(n) for k in [rng.choice(list(WORDS))]]


# ---- language ------------------------------------------------------------------------


def test_language_held_out(docs):
    rows = sentences()
    df = docs([*rows, (500, None), (501, ""), (502, "123 !! 4.5"), (503, "der fluss und das haus " * 90_000, None), (None, "le rapide maison", None), (1, rows[1][1], "en")])
    held = language.held_out(F.col("doc_id"))
    model = language.train(df.filter(~held).select(F.col("doc_id").alias("id"), "text", "lang"))
    assert model.langs == ["de", "en", "fr"]
    got = {r.doc_id: r for r in language.predict(df, model, ["doc_id", "score"]).collect()}
    assert [got[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and got[500].score == 0.0
    assert got[503].lang_pred == "de" and got[None].lang_pred == "fr"
    right = [got[i].lang_pred == lang for i, _, lang in rows if i != 1]
    assert np.mean(right) > 0.95 and all(0 <= r.score <= 1 for r in got.values())


def test_language_counts_every_gram_once(monkeypatch):
    text = "Häuser am Fluss, und 12 Brücken. " * 20
    whole = np.bincount(np.concatenate(list(language.pieces(text))), minlength=language.BUCKETS)
    monkeypatch.setattr(language, "PIECE", 17)
    assert (np.bincount(np.concatenate(list(language.pieces(text))), minlength=language.BUCKETS) == whole).all()


def test_language_without_training(docs):
    model = language.train(docs([(1, "abc", None)]).select(F.col("doc_id").alias("id"), "text", "lang"))
    assert [r.lang_pred for r in language.predict(docs([(1, "abc")]), model, ["doc_id"]).collect()] == ["und"]
    assert language.predict(docs([]), model, ["doc_id"]).count() == 0


# ---- quality -------------------------------------------------------------------------


def brute_repeats(words):
    g = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    return len({i + k for i, w in enumerate(g) if g.count(w) > 1 for k in range(5)})


def test_quality_measures_against_brute_force(docs):
    rng = random.Random(2)
    texts = ["", "a", " \n\t ", "x" * 100_000] + ["".join(rng.choice(["a", "b", " ", " ", "\n", "#", "é", " "]) for _ in range(rng.randint(0, 120))) for _ in range(150)]
    for t in texts:
        m = dict(zip(quality.MEASURES, quality.measure(t), strict=True))
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert m["n_words"] == len(words) and m["word_chars"] == sum(map(len, words)) and m["n_symbols"] == len(re.findall(r"[#*$%&|<>]", t))
        assert m["n_dup_lines"] == sum(x in lines[:i] for i, x in enumerate(lines)) and m["n_repeat_words"] == brute_repeats(words)


def test_quality_ledger_and_ablation(docs):
    good = "the river runs under an old bridge and the stones below are smooth and dark"
    df = docs([(1, good), (2, None), (3, "# * " * 20), (4, "THE RIVER RUNS UNDER AN OLD BRIDGE AND SMOOTH DARK STONES"), (5, "go " * 30), (1, good)])
    book = quality.ledger(df, ["doc_id", "score"])
    rows = book.withColumn("base", quality.verdict("base")).withColumn("kept", quality.verdict("v2")).collect()
    kept = {r.doc_id: (r.base, r.kept) for r in rows}
    assert len(rows) == 6 and kept[1] == (True, True) and kept[2] == (False, False) and kept[4] == (True, False) and not kept[3][1]
    table = {r.rule: r for r in quality.ablation(book, "v2").collect()}
    masks = [r.failed for r in rows]
    for bit, (name, _) in quality.rules().items():
        assert table[name].n_failed == sum(m >> bit & 1 for m in masks)
        assert table[name].n_only == sum(m == 1 << bit for m in masks)
        assert table[name].n_kept_without == sum(m & ~(1 << bit) == 0 for m in masks)
    assert quality.ledger(docs([]), ["doc_id"]).count() == 0


# ---- pages ---------------------------------------------------------------------------

PARA = "This is a paragraph, with commas, and with text enough to count as a part of the article. "


@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("<p>", ""), ("<div><p>x", "x"), ("a<b>b</b>c<br>d", "abc d"),
    (f"<body><nav><a href=x>Menu</a></nav><article><h1>T</h1><p><b>{PARA}<br><p>two&nbsp;\n three</article><footer>f</footer>", f"T\n{PARA.strip()}\ntwo three"),
    (f"<div id=sidebar><p>{PARA}</p></div><div id=content><h2>H</h2><p>{PARA}<p>short<div class='ad-box'><p>{PARA}</div></div><div class=comments><p>{PARA * 3}</p></div>",
     f"H\n{PARA.strip()}\nshort"),
    (f"<div class='content with-sidebar'><p>{PARA}</p></div>", PARA.strip()),
    (f"<script>var a = '<p>no</p>';</script><style>p</style><main><p>{PARA}</p><form><p>{PARA}</p></form><ul><li>one<li>two</ul></main>", f"{PARA.strip()}\none\ntwo"),
    (f"<article><p>{PARA}</p><ul><li><a href=1>link one</a><li><a href=2>link two</a></ul></article>", PARA.strip()),
    (f"<article><p>{PARA}</p></article><footer>&copy; &am", PARA.strip()), ("<p>" + PARA + "<a href='", PARA.strip()),
])
def test_main_text(page, want):
    assert html.main_text(page) == want


def test_extract_frame(spark, docs):
    docs([])
    pages = spark.createDataFrame([(1, "u", f"<p>{PARA}</p>", "x"), (1, "u", f"<p>{PARA}</p>", "x"), (None, None, None, "x"), (3, "u", "<div>" * 50_000 + PARA, "x")],
                                  "page_id long, url string, html string, text string")
    got = html.extract(pages, ["page_id", "url", "text"]).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == sorted([(1, PARA.strip(), len(PARA) - 1)] * 2 + [(0, "", 0), (3, PARA.strip(), len(PARA) - 1)])
    assert html.extract(pages.limit(0), ["page_id"]).count() == 0


# ---- personal data -------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                found.append((*m.span(), kind))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_patterns_against_brute_force():
    rng = random.Random(1)
    bits = ["4465758382889437", "1.2.3.4", "300.1.1.1", "a@b.c", "x.y@z", "+1 (743) 555-3824", "12", "a", ".", "1.2.3.4.5.6.7.8", "a@b@c.d.e", "é", "0000000000000000"]
    for _ in range(4000):
        t = "".join(rng.choice("0123456789..@ -+a()%é") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == brute_spans(t)
        t = rng.choice([" ", ""]).join(rng.choice(bits) for _ in range(rng.randint(0, 6)))
        assert pii.base_spans(t) == brute_spans(t)
    assert pii.base_spans("9" * 100_000 + "." + "1" * 5000) == []  # long runs stay linear


def labelled_docs(n=300):
    rng = random.Random(9)
    word = lambda: rng.choice(WORDS["en"])
    number = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    out = []
    for i in range(n):
        thing = [f"{word()}.{number(2)}@mail{number(1)}.example.com", f"{rng.randint(1, 255)}.{rng.randint(1, 255)}.{rng.randint(1, 255)}.{rng.randint(1, 255)}",
                 "4465758382889437", f"+1 ({number(3)}) 555-{number(4)}", number(3), f"{number(2)}%", word()][i % 7]
        out.append((i, f"{word()} {word()} {thing} {word()}, {word()}"))
    return out


def test_field_learns_and_adds(docs):
    df = docs([*labelled_docs(), (1000, None), (1001, "")])
    field = pii.train(df)
    texts = ["call +1 (555) 555-1234 152.2.3.4 now", "4465758382889437 4465758382889437", "about 300 stones, 12% of 4500", "mail me@x.org or 999"]
    base = [pii.base_spans(t) for t in texts]
    added = pii.added_spans(field, texts, base)
    assert [s[2] for s in base[0]] == ["ip"] and added[0] == [(5, 22, "phone")]  # the pattern runs on into the address and finds too many digits
    assert base[1] == [] and [s[2] for s in added[1]] == ["card", "card"]
    assert added[2] == [] and added[3] == []
    rows = pii.find(df, field, ["doc_id", "spans"]).collect()
    assert len(rows) == 302 and all(r.spans == [] for r in rows if r.doc_id >= 1000)
    hidden = {r.doc_id: r.text for r in pii.redacted(df, field).collect()}
    assert "<EMAIL>" in hidden[0] and "@" not in hidden[0] and hidden[1000] is None and hidden[6] == dict(labelled_docs())[6]


def test_viterbi_against_brute_force():
    from itertools import product

    rng = np.random.default_rng(0)
    k = len(pii.TAGS)
    field = pii.Field({}, np.zeros((0, k)), rng.normal(size=(k + 1, k)))
    scores = rng.normal(size=(3, 3, k))
    move = np.where(pii._FORBIDDEN, -1e6, field.move)
    for s, got in zip(scores, field.viterbi(scores), strict=True):
        value = lambda p: move[-1][p[0]] + s[0][p[0]] + sum(move[p[t - 1]][p[t]] + s[t][p[t]] for t in (1, 2))  # noqa: B023, E731
        assert tuple(got) == max(product(range(k), repeat=3), key=value)


def test_field_without_labels(docs):
    field = pii.train(docs([(1, "no numbers here"), (2, None)]))
    assert pii.added_spans(field, ["+1 (555) 555-1234"], [[]]) == [[]]
    assert pii.find(docs([]), field, ["doc_id"]).count() == 0


def test_redact_merges_overlaps():
    spans = [{"kind": "ip", "start": 2, "end": 9, "base": True}, {"kind": "card", "start": 4, "end": 12, "base": True}]
    assert pii.redact("x 1.2.3.45678901 y", spans) == "x <IP>8901 y" and pii.redact(None, []) is None


def test_field_finds_forms_that_no_pattern_knows(docs):
    field = pii.train(docs(labelled_docs()))
    texts = [
        "555-123-4567", "call 0171 5551234 now", "(555) 123-4567", "tel 212-555-0199, or 030 7654321", "4465.7583.8288.9437",
        "on 2024-03-05 at 10:30", "in 1999 and 2004", "isbn 978-3-16-148410-0", "about 1,200,000 of 12%", "page 10-12 of 300", "v1.2.3 (12/31/1999)",
    ]
    base = [pii.base_spans(t) for t in texts]
    found = [[(t[a:b], k) for a, b, k in x] for t, x in zip(texts, pii.added_spans(field, texts, base), strict=True)]
    assert found == [
        [("555-123-4567", "phone")], [("0171 5551234", "phone")], [("(555) 123-4567", "phone")], [("212-555-0199", "phone"), ("030 7654321", "phone")],
        [("4465.7583.8288.9437", "card")], [], [], [], [], [], [],
    ]


def test_features_cover_whole_words():
    long_word = "x" * 300 + "4465758382889437" + "-" * 100
    own = pii.features([long_word, "12"])[0]
    assert "luhn" in own and "n=16" in own and f"s=x{{16}}{'-' * 100}" in own
    rows = list(pii._labelled(iter([pd.DataFrame({"id": [1], "text": [f"a {'1' * 5000} b 12 c " + "7 " * 40]})])))[0]
    assert rows["words"].tolist() == [["12"]]  # runs beyond the bounds are no part of the table; none is cut


def test_fit_climbs_the_likelihood():
    rng = np.random.default_rng(4)
    rows = [(pii.features([str(w) for w in rng.integers(1, 10**6, n)]), [0] * n) for n in (1, 2, 2, 3)]
    rows.append((pii.features(["+1", "(555)", "555-1234"]), [7, 8, 8]))

    def likelihood(field):
        from itertools import product

        total, k = 0.0, len(pii.TAGS)
        move = np.where(pii._FORBIDDEN, -1e6, field.move)
        for feats, tags in rows:
            s = field.scores(feats)
            value = lambda p: move[-1][p[0]] + s[0][p[0]] + sum(move[p[t - 1]][p[t]] + s[t][p[t]] for t in range(1, len(p)))  # noqa: B023, E731
            every = np.array([value(p) for p in product(range(k), repeat=len(tags))])
            total += value(tags) - (every.max() + np.log(np.exp(every - every.max()).sum()))
        return total - pii.DECAY / 2 * ((field.emit**2).sum() + (field.move**2).sum())

    field = pii.fit(rows)
    best = likelihood(field)
    empty = pii.Field(field.index, np.zeros_like(field.emit), np.zeros_like(field.move))
    assert likelihood(empty) < best
    for table in (field.emit, field.move):  # no single weight can be moved to gain much
        for at in [tuple(rng.integers(0, n) for n in table.shape) for _ in range(12)]:
            for step in (0.3, -0.3):
                table[at] += step
                assert likelihood(field) < best + 0.02
                table[at] -= step


@pytest.mark.parametrize("page", [
    "<b>" * 100_000 + "</i>" * 100_000, "<div>" * 100_000 + "</section>" * 100_000, "<header>" * 100_000 + "x", "<p><li>" * 50_000,
    "<b>" * 50_000 + "<p></b>" * 50_000, "<ul>" * 1000 + "<li>x" * 60_000,
])
def test_unclosed_tags_stay_linear(page):
    began = time.process_time()
    html.main_text(page)
    assert time.process_time() - began < 5


def test_language_refuses_a_column_that_holds_no_languages(docs, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGS", 5)
    rows = docs([(i, "some words", f"l{i}") for i in range(6)])
    with pytest.raises(ValueError, match="language column"):
        language.train(rows.select(F.col("doc_id").alias("id"), "text", "lang"))


def test_language_scores_against_unhashed_counts(docs):
    """A plain classifier over n-grams as text agrees wherever it is sure."""
    import math
    from collections import Counter

    rows = sentences(5, 200)
    model = language.train(docs(rows[:150]).select(F.col("doc_id").alias("id"), "text", "lang"))
    grams = lambda t: [g for n in language.ORDERS for s in [" " + " ".join(t.split()) + " "] for g in (s[i : i + n] for i in range(len(s) - n + 1))]
    counts = {k: Counter(g for _, t, lang in rows[:150] if lang == k for g in grams(t)) for k in WORDS}
    prior = Counter(lang for _, _, lang in rows[:150])
    buckets = language.BUCKETS
    for _, text, _ in rows[150:]:
        want = {k: math.log(prior[k] / 150) + sum(math.log((counts[k][g] + language.ALPHA) / (sum(counts[k].values()) + language.ALPHA * buckets)) for g in grams(text)) for k in WORDS}
        got = dict(zip(model.langs, model.scores(text), strict=True))
        assert max(want, key=want.get) == max(got, key=got.get)
        assert all(abs(want[k] - got[k]) < 0.05 * abs(want[k]) for k in WORDS)
