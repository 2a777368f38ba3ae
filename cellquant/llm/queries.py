"""Queries of this subpackage for the entry point: thin digests over the operators, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellquant.llm import ann, chat, decontam, html, lm, merkle, periodic, pieces, pii, simhash, suffix, toxicity, urls

#: Verdict, host and path of the rules that the URL query is asked for.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: The conversation that the chat query adds.
EXTRA_TURN = "\\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeats_digest(suffix.remove_repeats(_table(spark, sf_dir, "documents")))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TURN).alias("text"))
    return chat.conversation_digest(chat.format_conversations(rows.unionByName(extra)))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), decoded=True)
    text = F.coalesce("text", F.lit(""))
    return coded.select(
        "doc_id",
        F.length(text).cast("long").alias("n_chars"),
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_xxhash64"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == text).alias("lossless"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.decontamination_digest(decontam.decontamination_report(docs, _table(spark, sf_dir, "benchmark")))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pii_digest(pii.find_pii(docs, pii.train_pii(docs)))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_toxicity(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", "severity", "grade", "p_toxic", "toxic")


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def _planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten repeats a stretch of its words to its end."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.runs_digest(periodic.periodic_runs(_table(spark, sf_dir, "documents"), change=_planted))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.leaf_hash(*(F.col(c) + 1 if c == "n_chars" else c for c in fields)))
    leaves = docs.select("doc_id", "lang", merkle.leaf_hash(*fields).alias("leaf"), altered.alias("altered"))
    proved = merkle.manifest(leaves, "lang", ["doc_id"], "leaf").withColumn("siblings", merkle.siblings())
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof_sha256"),
        merkle.folded(F.coalesce("altered", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_chat_format, op3_sentencepiece, op4_decontamination, op5_simhash, op6_pii, op7_toxicity, op8_lm_scores, op9_url_filter, op10_nearest, op11_periodic_runs, op12_html_text, op13_merkle_manifest)}


_REPEATS_SQL = """
WITH d AS (SELECT doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k
  FROM (SELECT doc_id, h, unnest(generate_series(0, length(h) // 2 - 100)) AS i FROM d WHERE length(h) >= 200)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM w) WHERE r > 1),
runs AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS g
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM later)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM runs GROUP BY doc_id, g),
parts AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS e FROM spans
  UNION ALL SELECT d.doc_id, coalesce(max(z), 0), any_value(length(h)) // 2 FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s) AS k FROM parts JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS gone FROM spans GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

_CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r AS (
  SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS body,
    CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
      ELSE 7 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) END AS head FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(body + head + 9) AS BIGINT) AS formatted_chars,
  bool_and((before = '' AND role IN ('system', 'user')) OR (before = 'system' AND role = 'user')
    OR (before = 'user' AND role = 'assistant') OR (before = 'assistant' AND role = 'user')) AS valid
FROM r GROUP BY conv_id"""

_DECONTAM_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS w, least(len(ws), 10) AS n
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM d, sizes WHERE len(ws) >= n)),
m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.w = bw.w AND dw.n = bw.n),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id),
pos AS (SELECT doc_id, unnest(ws) AS term, unnest(generate_series(1, len(ws))) AS p FROM d),
it AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, unnest(ws) AS term FROM b),
tc AS (SELECT term, count(*) AS c FROM pos WHERE term IN (SELECT term FROM it) GROUP BY term),
rk AS (SELECT item, term, row_number() OVER (PARTITION BY item ORDER BY c, term) AS r FROM it JOIN tc USING (term)),
pk AS (SELECT *, max(r) OVER (PARTITION BY item) AS n FROM rk WHERE r <= 3),
mg AS (
  SELECT doc_id, item, p, n, last_value(CASE WHEN r = 1 THEN p END IGNORE NULLS) OVER u AS l1,
    last_value(CASE WHEN r = 2 THEN p END IGNORE NULLS) OVER u AS l2, last_value(CASE WHEN r = 3 THEN p END IGNORE NULLS) OVER u AS l3
  FROM pos JOIN pk USING (term) WINDOW u AS (PARTITION BY doc_id, item ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
near AS (
  SELECT doc_id, count(DISTINCT item) AS n_near FROM mg
  WHERE l1 IS NOT NULL AND (n < 2 OR l2 IS NOT NULL) AND (n < 3 OR l3 IS NOT NULL) AND p - least(l1, l2, l3) < 20 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)"""


#: unsigned CRC-32 of a decimal number
_CRC = """xor(list_reduce(list_prepend(4294967295, list_concat(list_transform(range(8 * length({0}::VARCHAR)),
    lambda k: CASE WHEN k % 8 = 0 THEN ord(substr({0}::VARCHAR, CAST(k // 8 + 1 AS INTEGER), 1)) ELSE 0 END))),
    lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384) ELSE xor(c, b) >> 1 END), 4294967295)"""

_RUNS_SQL = (
    r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, """
    + _CRC.format("doc_id")
    + r""" AS h FROM documents),
e AS (
  SELECT doc_id, w, len(w) AS n, h, CASE WHEN len(w) > 0 THEN h // 10 % len(w) ELSE 0 END AS a, 3 + h // 10 % 8 AS b FROM d),
t AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // b) END + 1]) ELSE w END AS w FROM e),
g AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 6], ' ') AS k FROM (SELECT doc_id, w, unnest(range(n - 5)) AS i FROM t WHERE n >= 12)),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i),
s AS (
  SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 6 AS same
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS r FROM m) GROUP BY doc_id, q, r),
r AS (
  SELECT doc_id, start, same + q AS length, min(q) AS period FROM s WHERE same >= q AND same + q >= 12 GROUP BY doc_id, start, same + q),
b AS (
  SELECT doc_id, count(*) AS n_runs, min((-length, start, period)) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM (SELECT doc_id, unnest(w) AS x, unnest(range(n)) AS i FROM t) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[2] AS start, -best[1] AS length, best[3] AS period, -1000 * best[1] // best[3] AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN b USING (doc_id) LEFT JOIN kept USING (doc_id)"""
)

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + "))"
_MERKLE_SQL = (
    "WITH RECURSIVE d AS (SELECT doc_id, lang, "
    + _LEAF.format("n_chars")
    + " AS leaf, CASE WHEN "
    + _CRC.format("doc_id")
    + " % 7 = 0 THEN "
    + _LEAF.format("(n_chars + 1)")
    + """ END AS altered FROM documents),
l AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS n FROM d),
low AS (
  SELECT tree, 0 AS level, place, n, leaf AS h FROM l
  UNION ALL SELECT tree, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM low WHERE n > 1 GROUP BY tree, level, place // 2, n),
high AS (
  SELECT 0 AS level, tree - 1 AS place, count(*) OVER () AS n, h FROM low WHERE n = 1
  UNION ALL SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM high WHERE n > 1 GROUP BY level, place // 2, n),
way AS (
  SELECT l.tree, l.place, x.level, x.place & 1 AS odd, y.h AS sibling
  FROM l JOIN low x ON x.tree = l.tree AND x.place = l.place >> x.level AND x.n > 1 LEFT JOIN low y ON y.tree = x.tree AND y.level = x.level AND y.place = xor(x.place, 1)
  UNION ALL SELECT l.tree, l.place, 100 + x.level, x.place & 1, y.h
  FROM l JOIN high x ON x.place = (l.tree - 1) >> x.level AND x.n > 1 LEFT JOIN high y ON y.level = x.level AND y.place = xor(x.place, 1)),
steps AS (SELECT *, row_number() OVER (PARTITION BY tree, place ORDER BY level) AS k FROM way),
fold AS (
  SELECT tree, place, 0 AS k, coalesce(altered, leaf) AS h FROM l
  UNION ALL SELECT f.tree, f.place, s.k, sha256(CASE WHEN odd = 1 THEN concat(sibling, h) ELSE concat(h, sibling) END) FROM fold f JOIN steps s ON s.tree = f.tree AND s.place = f.place AND s.k = f.k + 1),
ends AS (SELECT tree, place, max_by(h, k) AS folded_root FROM fold GROUP BY tree, place),
proof AS (SELECT tree, place, sha256(coalesce(string_agg(sibling, '' ORDER BY k), '')) AS proof_sha256 FROM steps GROUP BY tree, place)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = r.h AS verified
FROM l JOIN ends USING (tree, place) LEFT JOIN proof USING (tree, place) JOIN (SELECT tree, h FROM low WHERE n = 1) s USING (tree) CROSS JOIN (SELECT h FROM high WHERE n = 1) r"""
)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffix_dedup": _REPEATS_SQL,
        "op2_chat_format": _CHAT_SQL,
        "op4_decontamination": _DECONTAM_SQL,
        "op11_periodic_runs": _RUNS_SQL,
        "op13_merkle_manifest": _MERKLE_SQL,
    }
