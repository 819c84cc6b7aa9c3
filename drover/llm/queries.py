"""The operators bound to the driver's tables, one query each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.llm import factorization, html, language, merkle, mixing, neardup, packing, pii, quality, repeats, sharding, spelling, topk
from drover.llm.base import QUERIES, SQL, query, table, words_in

__all__ = ["QUERIES", "SQL"]

#: Shards that the documents lie in before they are put into 24: one per hash of the source.
OLD_SHARDS, NEW_SHARDS = 16, 24


@query("op1_reshard_min_cost_flow")
def _(spark, d) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long") + 8
    # Where a row lies tells it from its equals, so that any number of them is spread.
    lies = {"_in_file": F.xxhash64("_metadata.file_path"), "_in_row": F.col("_metadata.row_index")}
    docs = table(spark, d, "documents").withColumns({"text_crc32": F.crc32(text), **lies})
    old = F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit(""))), F.lit(OLD_SHARDS))
    out, made = sharding.reshard(docs, old, size, ["doc_id", "text_crc32", *lies], OLD_SHARDS, NEW_SHARDS)
    out = out.drop("size", "text_crc32", *lies)
    found = sharding.contents(out, made, sharding.rewrite(out, made))
    return found.select(
        "doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), old.cast("int").alias("old_shard"),
    )


@query("op2_language_naive_bayes")
def _(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    held = language.held_out(F.col("doc_id"))
    model = language.train(docs.filter(~held).select(F.col("doc_id").alias("id"), "text", "lang"))
    out = language.predict(docs, model, ["doc_id"])
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op3_extract_tree_scoring")
def _(spark, d) -> DataFrame:
    return html.extract(table(spark, d, "pages"), ["page_id", "url"])


OP4_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM w),
g AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g WHERE g IS NOT NULL) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM h, range(5) r(k) GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
ll AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
s AS (SELECT doc_id, sum(CASE WHEN word = before THEN 1 ELSE 0 END) AS n_stutter FROM (SELECT doc_id, word, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM p) GROUP BY 1),
tw AS (SELECT doc_id, max(n) AS n_top FROM (SELECT doc_id, word, count(*) AS n FROM p GROUP BY 1, 2) GROUP BY 1),
m AS (SELECT w.doc_id, len(w.w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_stutter, 0) AS n_stutter, coalesce(n_top, 0) AS n_top,
  length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters
  FROM w LEFT JOIN c USING (doc_id) LEFT JOIN ll USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN tw USING (doc_id)),
f AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END) + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
  + (CASE WHEN 2 * n_dup_lines > n_lines AND n_lines >= 4 THEN 8 ELSE 0 END) + (CASE WHEN 10 * n_upper > 4 * n_letters AND n_letters > 0 AND n_words >= 10 THEN 16 ELSE 0 END)
  + (CASE WHEN 10 * n_top > 3 * n_words AND n_words >= 10 THEN 32 ELSE 0 END) + (CASE WHEN 10 * n_stutter > 3 * n_words AND n_words >= 10 THEN 64 ELSE 0 END)
  + (CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 128 ELSE 0 END) AS failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
 CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(failed AS BIGINT) AS failed, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept FROM f"""


@query("op4_quality_ledger", OP4_SQL)
def _(spark, d) -> DataFrame:
    book = quality.ledger(table(spark, d, "documents"), ["doc_id"])
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed",
        (~quality.verdict("base")).alias("base_failed"), quality.verdict("v2").alias("kept"),
    )


OP5_SQL = r"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
t AS (SELECT sum(source_size) AS total, sum(weight) AS weights FROM w),
q AS (SELECT *, coalesce(sum(source_size) OVER o, 0) AS before, coalesce(sum(weight) OVER o, 0) AS weight_before, row_number() OVER (ORDER BY source_size * 1.0 / weight, r) AS k
  FROM w WINDOW o AS (ORDER BY source_size * 1.0 / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT q.*, (CAST(1.5 AS DOUBLE) * t.total - CAST(2 AS DOUBLE) * before) / (t.weights - weight_before) AS level FROM q, t),
u AS (SELECT level FROM l WHERE 2 * source_size > weight * level ORDER BY k LIMIT 1),
g AS (SELECT source, source_size, least(CAST(2 AS DOUBLE) * source_size, weight * coalesce((SELECT level FROM u), 1e300)) AS target FROM w),
b AS (SELECT source, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT p.doc_id, p.size, e.source_size, e.target, CAST(epochs * p.size + greatest(0, least(p.size, budget - epochs * e.source_size - p.before)) AS BIGINT) AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source"""


@query("op5_mix_to_weights", OP5_SQL)
def _(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", words_in(F.col("text")).alias("n"))
    out = mixing.mix(docs, F.col("n"), mixing.random_key("doc_id"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_pii_conditional_random_field")
def _(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    found = pii.find(docs, pii.train(docs), ["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    listed = lambda spans: F.array_join(F.transform(spans, name), ",")
    base = listed(F.filter("spans", lambda s: s["base"]))
    return found.select(
        "doc_id", *(count(k) for k in pii.KINDS), F.sha2(base.cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


@query("op7_pack_bounded_space")
def _(spark, d) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


OP9_SQL = """WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


@query("op9_top_k_branch_and_bound", OP9_SQL)
def _(spark, d) -> DataFrame:
    return topk.top_k(table(spark, d, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20)


OP10_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)"""


@query("op10_minhash_one_permutation", OP10_SQL)
def _(spark, d) -> DataFrame:
    return neardup.near_duplicates(table(spark, d, "documents"), "doc_id", "text", width=3, percent=85)


OP8_SQL = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
v AS (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d), w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS w FROM v),
f AS (SELECT w, min(doc_id) AS m FROM w GROUP BY 1 HAVING min(doc_id) < max(doc_id)), c AS (SELECT doc_id, p FROM w JOIN f USING (w) WHERE m < doc_id),
g AS (SELECT *, sum(CASE WHEN p <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM (SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM c)),
s AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM g GROUP BY 1, 2),
x AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM s UNION ALL SELECT doc_id, n, coalesce(b, 0) FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM s GROUP BY 1) USING (doc_id)),
t AS (SELECT doc_id, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY z, a) AS h FROM x JOIN d USING (doc_id) GROUP BY 1),
r AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS removed, count(*) AS spans FROM s GROUP BY 1)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(t.h)) AS kept_sha256
 FROM d JOIN t USING (doc_id) LEFT JOIN r USING (doc_id)"""


@query("op8_repeats_logarithmic_index", OP8_SQL)
def _(spark, d) -> DataFrame:
    out = repeats.remove_repeats(table(spark, d, "documents"), "doc_id", "text", length=50, with_text=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _crc32_sql(codes: str) -> str:
    """Unsigned crc32 of a list of byte values, as DuckDB SQL."""
    step = "lambda y, z: xor(y >> 1, (y & 1) * 3988292384)"
    byte = f"lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {step})"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), {byte}), 4294967295)"


#: The fields of a leaf, in order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def _op11_sql(levels: int = 9, tops: int = 4) -> str:
    """Trees of at most 8 ** levels leaves and 8 ** tops groups, level by level."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    plain = lambda text: " || ".join(field(text if c == "text" else c) for c in LEAF)
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = _crc32_sql("[ord(c)::BIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]")
    depth = lambda n: " + ".join(f"CAST({n} > {8 ** d} AS INT)" for d in range(levels))
    beside = "string_agg(h, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN {})"
    parts = [
        f"l AS (SELECT doc_id, lang AS g, sha256({plain('text')}) AS h, CASE WHEN {crc} % 3 = 0 THEN sha256({plain(low)}) ELSE sha256({plain('text')}) END AS t FROM documents)",
        f"a0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, {depth('count(*) OVER (PARTITION BY g)')} AS d FROM l)",
    ]

    def climb(name: str, most: int) -> None:
        for k in range(most):
            parts.append(
                f"{name}s{k} AS (SELECT g, i, coalesce({beside.format('UNBOUNDED PRECEDING AND 1 PRECEDING')}, '') AS b, "
                f"coalesce({beside.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')}, '') AS f FROM {name}{k} WHERE d > {k})"
            )
            parts.append(
                f"{name}{k + 1} AS (SELECT g, i // 8 AS i, any_value(d) AS d, CASE WHEN any_value(d) > {k} THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM {name}{k} GROUP BY 1, 2)"
            )

    climb("a", levels)
    parts.append(f"b0 AS (SELECT 0 AS g, g AS lang, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, {depth('count(*) OVER ()')} AS d FROM a{levels})")
    climb("b", tops)
    parts.append(
        f"p0 AS (SELECT a0.doc_id, a0.g, a0.h, b0.h AS sub, b0.i AS j, a0.i AS i, r.h AS root, '' AS proof, a0.t AS fold FROM a0 JOIN b0 ON a0.g IS NOT DISTINCT FROM b0.lang, b{tops} r)"
    )
    k = 0
    for name, most, place in (("a", levels, "p.i"), ("b", tops, "p.j")):
        for n in range(most):
            group = "s.g IS NOT DISTINCT FROM p.g AND" if name == "a" else ""
            parts.append(
                f"p{k + 1} AS (SELECT p.doc_id, p.g, p.h, p.sub, p.j, p.i, p.root, CASE WHEN s.i IS NULL THEN p.proof ELSE p.proof || s.b || s.f END AS proof, "
                f"CASE WHEN s.i IS NULL THEN p.fold ELSE sha256(s.b || p.fold || s.f) END AS fold FROM p{k} p LEFT JOIN {name}s{n} s ON {group} s.i = {place} // {8 ** n})"
            )
            k += 1
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, h AS leaf, sub AS subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, "
        f"fold = root AS verified FROM p{k}"
    )


@query("op11_merkle_nested_rollup", _op11_sql())
def _(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf([low if c == "text" else F.col(c) for c in LEAF]))
    out = merkle.manifest(docs, LEAF, carry={"tampered": tampered})
    fold = merkle.folded(F.coalesce("tampered", "leaf"), F.col("steps"))
    out = out.withColumn("folded_root", fold).withColumn("proof_sha256", merkle.digest(merkle.proof(F.col("steps"))))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_BYTES = "flatten([CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, (ord(c) - 64)::BIGINT] END FOR c IN string_split(doc_id || ':' || run, '')])"
OP13_SQL = rf"""WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
e AS (SELECT doc_id, run, count(*) AS k FROM r GROUP BY 1, 2), h AS (SELECT run, k, {_crc32_sql(_BYTES)} AS h FROM e),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, CAST(sum(k) AS BIGINT) AS n FROM h GROUP BY 1 HAVING length(word) >= 6 AND sum(k) >= 5),
x AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT a.word, b.word AS other FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word UNION SELECT word, less FROM x WHERE less IN (SELECT word FROM w) UNION SELECT less, word FROM x WHERE less IN (SELECT word FROM w)),
b AS (SELECT p.word, count(*) AS n_near, arg_min(o.word, {{'n': -o.n, 'word': o.word}}) AS best, max(o.n) AS best_n FROM p JOIN w o ON o.word = other GROUP BY 1),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n FROM w LEFT JOIN b USING (word)),
c AS (SELECT word, word AS here, 0 AS hop FROM f UNION ALL SELECT c.word, f.form, hop + 1 FROM c JOIN f ON f.word = c.here AND f.form IS NOT NULL),
t AS (SELECT word, arg_max(here, hop) AS root FROM c GROUP BY 1)
SELECT word, n, n_near, form, form_n, root FROM f JOIN t USING (word)"""


@query("op13_spelling_fm_index", OP13_SQL)
def _(spark, d) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, d, "documents")))


@query("op12_quality_factorization_machine")
def _(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    held = factorization.held_out(F.col("doc_id"))
    labels = table(spark, d, "labels").filter(~held).select("doc_id", F.col("quality").alias("label"))
    machine = factorization.train(docs.filter(~held), labels)
    out = factorization.predict(docs, machine, ["doc_id"])
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")
