"""The registered queries of the corpus operators and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import byte_spans, context_tree, decontamination, hard_negatives, line_quality, manifest, mixing, near_duplicates, pii, quality, sharding, tokens, word_spans


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.tile_benchmark(table(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir))


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_documents(context_tree.held_out_split(table(spark, sf_dir)))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir), table(spark, sf_dir, "labels"))


def op6_word_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_spans.remove_repeats(table(spark, sf_dir)).drop("kept_text")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir), 8)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir))


def op9_byte_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_spans.remove_repeats(table(spark, sf_dir)).drop("kept")


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(table(spark, sf_dir))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify_documents(table(spark, sf_dir))


def op12_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.score_documents(table(spark, sf_dir), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w FROM s),
c AS (SELECT *, CAST(source_size AS DOUBLE) * 2 AS cap, CAST(source_size AS DOUBLE) * 2 / w AS ratio FROM w),
v AS (SELECT *, ((SELECT CAST(sum(source_size) AS DOUBLE) FROM c) * 1.5
        - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size,
        coalesce(least(cap, (SELECT arg_min(level, ratio) FROM v WHERE level < ratio) * w), cap) AS target FROM v),
p AS (SELECT *, CAST(round(target) AS BIGINT) // greatest(source_size, 1) AS whole FROM t),
q AS (SELECT *, CAST(round(target) AS BIGINT) - whole * source_size AS extra FROM p),
r AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.whole, q.extra,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, CAST(size * whole + greatest(0, least(size, extra - before)) AS BIGINT) AS taken FROM r
"""


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM d),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM g),
e AS (SELECT doc_id, unnest(s) AS k FROM g),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM e a JOIN e b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, u.b FROM r JOIN u ON u.a = r.reach)
SELECT n.doc_id, any_value(n.n) AS n_shingles, min(reach) AS component_id, min(reach) = n.doc_id AS kept FROM n JOIN r USING (doc_id) GROUP BY n.doc_id
"""

OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM p),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM h),
c AS (SELECT DISTINCT doc_id, i + j AS pos FROM f CROSS JOIN (SELECT unnest(range(20)) AS j) WHERE n > 1),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.pos) FILTER (WHERE c.pos IS NULL) AS kept, count(c.pos) AS gone FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.pos = x.pos GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
p AS (SELECT doc_id, x, unnest(range(0, n - 399)) AS i FROM d WHERE n >= 400),
h AS (SELECT doc_id, i, md5(substring(x, 2 * i + 1, 800)) AS k FROM p),
s AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS m FROM h) WHERE m > 1),
b AS (SELECT *, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 1 ELSE 0 END AS new FROM s),
r AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b),
g AS (SELECT doc_id, run, min(i) AS a, max(i) + 400 AS z FROM r GROUP BY 1, 2),
k AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a0, a, z, row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS last FROM g),
t AS (SELECT k.doc_id, count(*) AS n_spans, sum(z - a) AS gone, string_agg(substring(x, 2 * a0 + 1, 2 * (a - a0)) || CASE WHEN last THEN substring(x, 2 * z + 1) ELSE '' END, '' ORDER BY a) AS kept FROM k JOIN d USING (doc_id) GROUP BY 1),
p3 AS (SELECT doc_id, x, unnest(range(0, n - 303)) AS i FROM d WHERE n >= 304),
h3 AS (SELECT doc_id, i, md5(substring(x, 2 * i + 1, 608)) AS k FROM p3),
s3 AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS m FROM h3) WHERE m > 1),
c3 AS (SELECT doc_id, i, least(304, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 304)) AS n FROM s3),
t3 AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_repeated FROM c3 GROUP BY 1)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, coalesce(n_repeated, 0) AS n_repeated, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN t3 USING (doc_id)
"""


_TAGGED = {c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", "text", "(n_chars + 1)")}
_LEAF = " || ".join(_TAGGED[c] for c in ("doc_id", "source", "lang", "n_chars", "text"))
_CHANGED = " || ".join(_TAGGED[c] for c in ("doc_id", "source", "lang", "(n_chars + 1)", "text"))
_CRC32 = """xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP11_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, sha256({_LEAF}) AS leaf, CASE WHEN n_chars IS NOT NULL AND {_CRC32} % 7 = 0 THEN sha256({_CHANGED}) END AS changed FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM d),
n AS (SELECT t, CAST(ceil(log2(count(*))) AS BIGINT) AS depth FROM l GROUP BY 1),
v(t, level, i, h) AS (SELECT t, 0, i, leaf FROM l UNION ALL
  SELECT v.t, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM v JOIN n USING (t) WHERE level < depth GROUP BY v.t, level, i // 2),
s AS (SELECT v.t, h FROM v JOIN n ON n.t = v.t AND level = depth),
m AS (SELECT CAST(ceil(log2(count(*))) AS BIGINT) AS depth FROM s),
u(level, i, h) AS (SELECT 0, t, h FROM s UNION ALL SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u CROSS JOIN m WHERE level < depth GROUP BY level, i // 2),
r AS (SELECT h FROM u CROSS JOIN m WHERE level = depth),
p AS (SELECT l.t, l.i, k.level, CASE WHEN h IS NULL THEN 'L' WHEN v.i % 2 = 0 THEN 'L' || h ELSE 'R' || h END AS step
    FROM l JOIN (SELECT t, unnest(range(depth)) AS level FROM n) k ON k.t = l.t LEFT JOIN v ON v.t = l.t AND v.level = k.level AND v.i = xor(l.i >> k.level, 1)
  UNION ALL SELECT l.t, l.i, 1000 + k.level, CASE WHEN h IS NULL THEN 'L' WHEN u.i % 2 = 0 THEN 'L' || h ELSE 'R' || h END
    FROM l CROSS JOIN (SELECT unnest(range(depth)) AS level FROM m) k LEFT JOIN u ON u.level = k.level AND u.i = xor(l.t >> k.level, 1)),
a AS (SELECT t, i, list(step ORDER BY level) AS steps FROM p GROUP BY 1, 2),
f AS (SELECT l.doc_id, leaf, s.h AS subroot, r.h AS root, coalesce(steps, []) AS steps, coalesce(changed, leaf) AS given FROM l JOIN s USING (t) CROSS JOIN r LEFT JOIN a ON a.t = l.t AND a.i = l.i),
g AS (SELECT *, list_reduce([given] || steps, lambda h, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || h ELSE h || x[2:] END)) AS folded_root FROM f)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda x: x[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM g
"""


OP13_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id != b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) QUALIFY row_number() OVER w <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_decontamination, op2_mixing, op3_context_tree, op4_near_duplicates, op5_quality, op6_word_spans, op7_sharding, op8_pii, op9_byte_spans, op10_tokens, op11_manifest, op12_line_quality, op13_hard_negatives]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": OP2_SQL, "op4_near_duplicates": OP4_SQL, "op6_word_spans": OP6_SQL, "op9_byte_spans": OP9_SQL, "op11_manifest": OP11_SQL, "op13_hard_negatives": OP13_SQL}
