"""The operators of this subpackage, each over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavault.catalog.base import Query, table
from stratavault.llm import chat_format, decontaminate, exact_dedup, merkle, mixing, ngram_join, quality, secrets, simhash, structure, toxicity, url_filter, warc
from stratavault.session import scratch_path

#: (host, path, verdict)
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.page_archive(table(spark, sf_dir, "pages"), path)
    return warc.archived_pages(spark, path)


OP1_SQL = """
WITH texts AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
groups AS (SELECT page_id, html, strlen(html) AS bytes, max(page_id) OVER (PARTITION BY html) AS first FROM texts)
SELECT page_id, bytes AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM groups
"""


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
placed AS (
  SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place, count(*) OVER (PARTITION BY norm) AS group_size
  FROM texts WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM placed
"""


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.read_back(chat_format.expand(rows.unionByName(added)))


OP6_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
escaped AS (
  SELECT *, replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;') AS r,
         replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS t FROM turns),
placed AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(length(r) + length(t) + 14) OVER (w ROWS UNBOUNDED PRECEDING) AS chars
  FROM escaped WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) FILTER (role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


OP9_SQL = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
best AS (
  SELECT n, max_by(r.host || r.path, length(r.host) + length(r.path)) AS rule,
         max_by(r.verdict, length(r.host) + length(r.path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
"""


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
item_words AS (
  SELECT *, least(5, len(w)) AS k FROM (
    SELECT row_number() OVER () AS i, item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark)
  WHERE len(w) > 0),
doc_shingles AS (
  SELECT r, doc_id, k, len(w) - k + 1 AS m, p - 1 AS p, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM doc_words JOIN (SELECT DISTINCT k FROM item_words) ON len(w) >= k)),
item_shingles AS (
  SELECT i, item_id, k, n, s, count(*) AS c FROM (
    SELECT i, item_id, k, len(w) - k + 1 AS n, array_to_string(w[p:p + k - 1], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM item_words)) GROUP BY ALL),
windows AS (
  SELECT DISTINCT r, doc_id, i, item_id, k, n, least(n, m) AS shown, least(p, greatest(m - n, 0)) AS t
  FROM doc_shingles JOIN item_shingles USING (s, k)),
weights AS (
  SELECT w.r, w.doc_id, w.i, w.item_id, w.n, w.shown, w.t, d.s, count(*) AS a
  FROM windows w JOIN doc_shingles d ON d.r = w.r AND d.k = w.k AND d.p >= w.t AND d.p < w.t + w.shown GROUP BY ALL),
scored AS (
  SELECT r, doc_id, item_id, t, sum(least(a, c)) / (n + shown - sum(least(a, c))) AS similarity
  FROM weights JOIN item_shingles USING (i, s, item_id, n) GROUP BY r, doc_id, i, item_id, n, shown, t)
SELECT doc_id, item_id, max(similarity) AS similarity, arg_min(t, struct_pack(a := -similarity, b := t)) AS start
FROM scored WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"), width=4, percent=85)


OP11_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p:p + 3], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.a = d.doc_id
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    values = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    changed = values | {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    leaves = docs.select("doc_id", "lang", merkle.leaf(list(values.values())).alias("leaf"), merkle.leaf(list(changed.values())).alias("shown"))
    proofs = merkle.manifest(leaves, "lang", "doc_id").withColumn("folded_root", merkle.folded(F.col("shown"), F.col("steps"), F.col("siblings")))
    return proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("siblings")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(n_chars: str) -> str:
    entries = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(entries)})"


OP12_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) AS crc FROM documents),
leaves AS (
  SELECT doc_id, lang, {_sql_leaf('n_chars')} AS leaf, {_sql_leaf('(n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END)')} AS shown FROM crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
grown AS (
  SELECT lang, 0 AS lev, list(leaf ORDER BY pos) AS a FROM placed GROUP BY lang
  UNION ALL SELECT lang, lev + 1, list_transform(range(0, len(a), 2), lambda i: sha256(a[i + 1] || coalesce(a[i + 2], ''))) FROM grown WHERE len(a) > 1),
subroots AS (SELECT lang, a[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM grown WHERE len(a) = 1),
top AS (
  SELECT 0 AS lev, list(subroot ORDER BY pos) AS a FROM subroots
  UNION ALL SELECT lev + 1, list_transform(range(0, len(a), 2), lambda i: sha256(a[i + 1] || coalesce(a[i + 2], ''))) FROM top WHERE len(a) > 1),
low_steps AS (
  SELECT p.lang, p.pos, list(CASE WHEN (p.pos >> lev) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(a[xor(p.pos >> lev, 1) + 1], '') ORDER BY lev) AS s
  FROM placed p JOIN grown g ON g.lang IS NOT DISTINCT FROM p.lang AND len(a) > 1 GROUP BY ALL),
top_steps AS (
  SELECT p.lang, list(CASE WHEN (p.pos >> lev) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(a[xor(p.pos >> lev, 1) + 1], '') ORDER BY lev) AS s
  FROM subroots p JOIN top ON len(a) > 1 GROUP BY ALL),
proofs AS (
  SELECT p.*, r.subroot, (SELECT a[1] FROM top WHERE len(a) = 1) AS root, list_concat(coalesce(l.s, []), coalesce(t.s, [])) AS steps
  FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN low_steps l ON l.lang IS NOT DISTINCT FROM p.lang AND l.pos = p.pos LEFT JOIN top_steps t ON t.lang IS NOT DISTINCT FROM p.lang),
folds AS (
  SELECT *, list_reduce(list_prepend(shown, steps), lambda d, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || d ELSE d || s[2:] END)) AS folded_root FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256, folded_root,
       folded_root = root AS verified FROM folds
"""


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text = F.coalesce("text", space)
    damaged = rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), (kind != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"))
    return structure.audited(damaged, F.col("present"))


QUERIES = {
    "op1_warc": Query(op1_warc, OP1_SQL),
    "op2_secrets": Query(op2_secrets),
    "op3_exact_dedup": Query(op3_exact_dedup, OP3_SQL),
    "op4_mix": Query(op4_mix),
    "op5_toxicity": Query(op5_toxicity),
    "op6_chat_format": Query(op6_chat_format, OP6_SQL),
    "op7_simhash_dedup": Query(op7_simhash_dedup),
    "op8_quality": Query(op8_quality),
    "op9_url_filter": Query(op9_url_filter, OP9_SQL),
    "op10_decontaminate": Query(op10_decontaminate, OP10_SQL),
    "op11_ngram_join": Query(op11_ngram_join, OP11_SQL),
    "op12_merkle_manifest": Query(op12_merkle_manifest, OP12_SQL),
    "op13_conversation_repair": Query(op13_conversation_repair),
}
