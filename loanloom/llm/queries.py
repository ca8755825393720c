"""Registered queries of the operators: production parameters, whole tables, and the digests that the contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanloom.llm import (
    importance, language, line_dedup, manifest, mixing, multi_index, packing, pii, prefix_tree, quality, secrets, threshold_topk, toxicity
)
from loanloom.llm.common import held_out, materialized, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@_register
def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10)


@_register
def op2_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.top_products(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


ORACLES["op2_threshold_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@_register
def op3_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@_register
def op4_budget_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialized(mixing.measured(table(spark, sf_dir, "documents"), ["doc_id"]), "sizes")
    return mixing.mix(rows, mixing.plan(rows)).select("doc_id", F.col("_size").alias("size"), "source_size", "target", "taken", "copies")


@_register
def op5_winnowed_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_deleted", "text")


ORACLES["op5_winnowed_line_dedup"] = r"""
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL
), solid AS (
  SELECT doc_id, pos, trim(line) AS line, lead(trim(line)) OVER w AS next_line, lead(pos) OVER w AS next_pos
  FROM raw WHERE trim(line) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), runs AS (
  SELECT doc_id, pos, next_pos AS last, [line, next_line] AS content FROM solid WHERE next_pos IS NOT NULL
  UNION ALL
  SELECT doc_id, pos, pos, [line] FROM solid WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50
), later AS (
  SELECT doc_id, pos, last FROM runs QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, pos) > 1
), kept AS (
  SELECT r.*, EXISTS (SELECT 1 FROM later l WHERE l.doc_id = r.doc_id AND r.pos BETWEEN l.pos AND l.last) AS gone FROM raw r
), cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM kept GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(c.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(c.n_deleted, 0) AS BIGINT) AS n_deleted, c.text
FROM documents d LEFT JOIN cleaned c USING (doc_id)
"""


@_register
def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id"))
    model = language.train(docs, ~F.col("held_out"))
    return language.identify(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "lang_mix")


@_register
def op9_lexicon_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id"))
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out("id"))
    return toxicity.score(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "score", "predicted", "n_hits", "terms")


@_register
def op8_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.report(docs, pii.find(docs))


@_register
def op10_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.report(docs, secrets.find(docs))


@_register
def op6_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree.join(table(spark, sf_dir, "documents"), n=4, num=85, den=100).select("doc_id", "n_shingles", "component_id", "stays")


# Unsigned crc32 of the UTF-8 bytes of each distinct ``w`` of a relation ``words``, by the table of the reflected polynomial 0xEDB88320.
_CRC32 = """
crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
), crcs AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM words WHERE w IS NOT NULL), crc_table
)
"""


@_register
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_importance_resampling"] = rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row, doc_id, text, TRUE AS source FROM documents UNION ALL SELECT -row_number() OVER (), NULL, text, FALSE FROM benchmark
), words AS (
  SELECT row, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts
), {_CRC32.strip()}, hashed AS (
  SELECT row, source, crc % 10000 AS bucket, count(*) AS n FROM words JOIN crcs USING (w) GROUP BY ALL
), counts AS (
  SELECT b AS bucket, coalesce(sum(n) FILTER (source), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT source), 0)::DOUBLE AS t
  FROM range(10000) r(b) LEFT JOIN hashed ON bucket = b GROUP BY b
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000)) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM counts
), weights AS (
  SELECT row, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM hashed JOIN gains USING (bucket) GROUP BY row
), noise AS (
  SELECT row, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM texts LEFT JOIN weights USING (row) WHERE source
), scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM noise
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""


@_register
def op12_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.filtered(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "lang", ~held_out("doc_id"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


def _rules_sql(risk: float, error: float) -> str:
    rules = quality.RULES
    grid = ", ".join(f"('{r.name}', {i}, {c})" for i, r in enumerate(rules) for c in r.cutoffs)
    parts = " ".join(f"WHEN '{r.name}' THEN {r.part}" for r in rules)
    wholes = " ".join(f"WHEN '{r.name}' THEN {r.whole}" for r in rules)
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT row, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM texts)
), windows AS (
  SELECT row, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY row ORDER BY i)
), twice AS (
  SELECT row, i FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY row, a, b, c) > 1
), repeats AS (
  SELECT row, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(3) r(k) GROUP BY row
), sizes AS (
  SELECT row, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM w GROUP BY row
), lines AS (
  SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row
), measures AS (
  SELECT row, doc_id, lang, text, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_lines, 0) AS n_lines,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM texts LEFT JOIN sizes USING (row) LEFT JOIN lines USING (row) LEFT JOIN repeats USING (row)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measures
), words AS (
  SELECT doc_id::VARCHAR AS w FROM labels
), {_CRC32.strip()}, marks AS (
  SELECT doc_id, max(quality) AS quality FROM labels JOIN crcs ON w = doc_id::VARCHAR WHERE crc % 4 <> 2 AND quality IS NOT NULL GROUP BY doc_id
), good AS (
  SELECT lang, text, any_value(b) AS b FROM based b JOIN marks USING (doc_id) WHERE NOT base_failed GROUP BY lang, text HAVING max(quality) = 1
), grid AS (
  SELECT * FROM (VALUES {grid}) g(rule, nr, cutoff)
), tried AS (
  SELECT lang, rule, cutoff, count(*) AS good, count(*) FILTER (1000 * CASE rule {parts} END > cutoff * CASE rule {wholes} END) AS lost
  FROM (SELECT lang, unnest(b) FROM good) x(lang, row, doc_id, l2, text, n_words, word_chars, n_lines, n_symbols, n_capitals, n_dup_lines, n_repeat_words, base_failed), grid
  GROUP BY ALL
), tested AS (
  SELECT *, (SELECT sum(exp(lgamma(good + 1) - lgamma(k + 1) - lgamma(good - k + 1) + k * ln({risk / len(rules)}) + (good - k) * ln(1 - {risk / len(rules)})))
             FROM range(lost + 1) r(k)) AS chance, (SELECT count(DISTINCT coalesce(lang, chr(0))) FROM good) AS strata FROM tried
), chosen AS (
  SELECT lang, rule, any_value(cutoff ORDER BY cutoff) AS cutoff FROM tested
  WHERE lost < good * {risk / len(rules)} AND chance <= {error} / ({len(rules)} * strata) GROUP BY lang, rule
), rejected AS (
  SELECT row, string_agg(rule, ',' ORDER BY nr) AS rejected_by
  FROM based b JOIN chosen c ON b.lang IS NOT DISTINCT FROM c.lang JOIN (SELECT DISTINCT rule, nr FROM grid) USING (rule)
  WHERE 1000 * CASE rule {parts} END > cutoff * CASE rule {wholes} END GROUP BY row
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rejected_by IS NULL AS kept,
  coalesce(rejected_by, '') AS rejected_by
FROM based LEFT JOIN rejected USING (row)
"""


ORACLES["op12_risk_controlled_rules"] = _rules_sql(0.05, 0.05)


@_register
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return manifest.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "lang", tampered, {"n_chars": F.col("n_chars") + 1})


def _leaf_sql(**changed: str) -> str:
    written = (changed.get(c, c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    return "sha256(" + " || ".join(f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in written) + ")"


# A level's rows are (grp, level, place, node); a group stops where one node is left.
_LEVELS = """
  SELECT grp, 0 AS level, place, node, count(*) OVER (PARTITION BY grp) AS size FROM {leaves}
  UNION ALL
  SELECT grp, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), any_value((size + 1) // 2) FROM {levels} WHERE size > 1
  GROUP BY grp, level, place // 2
"""
ORACLES["op13_merkle_manifest"] = rf"""
WITH RECURSIVE leaves AS (
  SELECT lang AS grp, doc_id, n_chars, {_leaf_sql()} AS node, {_leaf_sql(n_chars="n_chars + 1")} AS altered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, node) - 1 AS place FROM documents
), low AS ({_LEVELS.format(leaves="leaves", levels="low")}), subroots AS (
  SELECT 0 AS grp, grp AS member, node, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS place FROM low WHERE size = 1
), high AS ({_LEVELS.format(leaves="subroots", levels="high")}), words AS (
  SELECT doc_id::VARCHAR AS w FROM documents
), {_CRC32.strip()}, start AS (
  SELECT l.grp, l.doc_id, l.place, l.node AS leaf, s.node AS subroot, s.place AS group_place,
    CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN altered ELSE l.node END AS claim
  FROM leaves l JOIN subroots s ON l.grp IS NOT DISTINCT FROM s.member LEFT JOIN crcs ON w = doc_id::VARCHAR
), climb AS (
  SELECT grp, place, doc_id, leaf, subroot, group_place, claim AS node, '' AS proof, 0 AS level, place AS spot FROM start
  UNION ALL
  SELECT c.grp, c.place, doc_id, leaf, subroot, group_place,
    sha256(CASE WHEN spot % 2 = 1 THEN coalesce(s.node, '') ELSE '' END || c.node || CASE WHEN spot % 2 = 0 THEN coalesce(s.node, '') ELSE '' END),
    proof || coalesce(s.node, ''), c.level + 1, spot // 2
  FROM climb c JOIN (SELECT DISTINCT grp, level, size FROM low) z ON z.grp IS NOT DISTINCT FROM c.grp AND z.level = c.level AND z.size > 1
  LEFT JOIN low s ON s.grp IS NOT DISTINCT FROM c.grp AND s.level = c.level AND s.place = xor(spot, 1)
), arrived AS (
  SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY grp, place ORDER BY level DESC) = 1
), rise AS (
  SELECT grp, place, doc_id, leaf, subroot, node, proof, 0 AS level, group_place AS spot FROM arrived
  UNION ALL
  SELECT c.grp, c.place, doc_id, leaf, subroot,
    sha256(CASE WHEN spot % 2 = 1 THEN coalesce(s.node, '') ELSE '' END || c.node || CASE WHEN spot % 2 = 0 THEN coalesce(s.node, '') ELSE '' END),
    proof || coalesce(s.node, ''), c.level + 1, spot // 2
  FROM rise c JOIN (SELECT DISTINCT level, size FROM high) z ON z.level = c.level AND z.size > 1
  LEFT JOIN high s ON s.level = c.level AND s.place = xor(spot, 1)
), finished AS (
  SELECT * FROM rise QUALIFY row_number() OVER (PARTITION BY grp, place ORDER BY level DESC) = 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM finished f, (SELECT node AS root FROM high WHERE size = 1)
"""
