"""Registered queries of the training-data operators: op<number>_<name>."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geonest.llm.common import table
from geonest.llm.conversation_repair import damage, repair_conversations, summarise_repairs
from geonest.llm.ctw import score_documents
from geonest.llm.decontaminate import contaminated
from geonest.llm.filter_audit import ORDERS, audit_filters
from geonest.llm.hd_language import identify_languages
from geonest.llm.jaccard_join import jaccard_components
from geonest.llm.line_dedup import dedup_lines
from geonest.llm.packing import pack_documents
from geonest.llm.piece_bpe import decode_pieces, encode_pieces
from geonest.llm.topk import search_embeddings
from geonest.llm.toxicity import classify_toxicity
from geonest.llm.url_filter import judge_urls
from geonest.llm.warc import archive_pages

#: Rules of the URL filter: host, path, verdict. Fixed values of the contract.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_embeddings(table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS t(host, path, verdict)")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_pages(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return summarise_repairs(repair_conversations(damage(conversations), conversations))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    pieces = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), model), model)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return pieces.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


LLM_QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_toxicity": op4_toxicity,
    "op5_url_filter": op5_url_filter,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_line_dedup": op7_line_dedup,
    "op8_language_id": op8_language_id,
    "op9_warc": op9_warc,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_filter_audit": op11_filter_audit,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_sentencepiece": op13_sentencepiece,
}


def _audit_bit(place: str) -> str:
    return f"(1 << (strpos('ABCDE', substring(filter_order, {place}, 1)) - 1))"


def _edit(state: str, cost: str, letter: str, line: str) -> str:
    """A state's survivor after one more edit, as SQL; null stays null."""
    return f"CASE WHEN {state} IS NOT NULL THEN {{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'body': {state}.body || {line}}} END"


def _insert(state: str, role: str) -> str:
    return _edit(state, "2", "I", f"'{role}:' || chr(10)")


_GONE = "''"
_KEPT = "role || ':' || text || chr(10)"


def _rerole(state: str, role: str) -> str:
    return f"CASE WHEN NOT must_go THEN {_edit(state, '2 + cut', 'R', f"'{role}:' || text || chr(10)")} END"


def _keep(state: str, initial: str) -> str:
    return f"CASE WHEN NOT must_go AND initial = '{initial}' THEN {_edit(state, 'cut', 'K', _KEPT)} END"


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LLM_ORACLE_SQL = {
    "op3_exact_top_k": """
WITH v AS (
  SELECT vec_id, min([CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
  GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] for i in range(1, least(len(q.v), len(c.v)) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
""",
    "op5_url_filter": f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), {_LOWER}) AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(r, '') AS r FROM rest)
), rules(h, p, verdict) AS (
  VALUES {", ".join(str(r) for r in URL_RULES)}
), fits AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT s.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split s LEFT JOIN fits f ON s.page_id = f.page_id
""",
    "op6_jaccard_join": f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, [w for w in string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[\\x20\\x09-\\x0D]+') if w <> ''] AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws] ELSE [ws[i:i + 4] for i in range(1, len(ws) - 3)] END) AS s FROM docs
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id
""",
    "op7_line_dedup": f"""
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM docs
), keyed AS (
  SELECT *, translate(trim(line, {_SPACE}), {_LOWER}) AS k FROM lines
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), kept AS (
  SELECT d.doc_id, d.pos, d.line, s.k IS NULL OR d.doc_id = s.keeper AS stays FROM keyed d LEFT JOIN shared s ON d.k = s.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM kept GROUP BY doc_id
""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT *, [('0x' || substring(hex, 1 + 5 * i, 5))::BIGINT for i in range(8)] AS groups FROM p
), d AS (
  SELECT page_id, payload_bytes,
         list_aggregate([substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((groups[1 + k // 4] >> (15 - 5 * (k % 4))) & 31 AS INTEGER), 1) for k in range(32)], 'string_agg', '') AS payload_digest
  FROM bits
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
""",
    "op11_filter_audit": f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT *, [w for w in string_split_regex(t, '[\\x20\\x09-\\x0D]+') if w <> ''] AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM docs
), marks AS (
  SELECT doc_id, coalesce(max(quality = 1), false) AS good, coalesce(max(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(m.toxic, false) AS toxic,
         (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS fails
  FROM words w LEFT JOIN marks m USING (doc_id)
), orders AS (
  SELECT unnest([{", ".join(f"'{o}'" for o in ORDERS)}]) AS filter_order
), steps AS (
  SELECT filter_order, step, {_audit_bit("step")} AS own,
         list_sum([{_audit_bit("i")} for i in range(1, step + 1)])::INT AS after
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders)
), tallies AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM masks GROUP BY part, fails
), counted AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (fails & after = 0), 0) AS kept,
         coalesce(sum(n) FILTER (fails & after = own), 0) AS removed,
         coalesce(sum(n) FILTER (fails & own <> 0 AND fails & (after - own) <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
         coalesce(sum(n_good) FILTER (fails & after = own), 0) AS good_lost,
         coalesce(sum(n_toxic) FILTER (fails & after = own), 0) AS toxic_lost
  FROM tallies, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
""",
    "op12_conversation_repair": f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), bits AS (
  SELECT *, list_prepend(4294967295::BIGINT, flatten([[ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0] for c in string_split(name, '')])) AS steps FROM named
), dice AS (
  SELECT *, xor(list_reduce(steps, lambda crc, x: xor(xor(crc, x) >> 1, 3988292384 * (xor(crc, x) & 1))), 4294967295) % 20 AS r FROM bits
), damaged AS (
  SELECT conv_id, turn, CASE WHEN r = 4 THEN 'user' ELSE role END AS role,
         CASE r WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN r = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM dice WHERE r <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n, rtrim(text, {_SPACE}) AS body FROM damaged
), judged AS (
  SELECT *, substring(role, 1, 1) AS initial, CASE
    WHEN body = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN NOT right(body, 1) IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    substring(lag(role) OVER (PARTITION BY conv_id ORDER BY n), 1, 1) AS last_initial
  FROM placed
), marked AS (
  SELECT *, fault IN ('blank', 'duplicate') AS must_go, (fault = 'truncated')::INT AS cut FROM judged
), figures AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (n > 1 AND last_initial || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), walk AS (
  SELECT conv_id, 0::BIGINT AS n, {{'cost': 0, 'audit': '', 'body': ''}} AS e, NULL::STRUCT(cost INTEGER, audit VARCHAR, body VARCHAR) AS s,
         NULL::STRUCT(cost INTEGER, audit VARCHAR, body VARCHAR) AS u, NULL::STRUCT(cost INTEGER, audit VARCHAR, body VARCHAR) AS a
  FROM figures
  UNION ALL
  SELECT conv_id, n, {_edit("e", "3", "D", _GONE)}, list_min([{_edit("s", "3", "D", _GONE)}, {_keep("e", "s")}]),
         list_min([{_edit("u", "3", "D", _GONE)}, {", ".join(f"{_keep(x, 'u')}, {_rerole(x, 'user')}" for x in "esa")}]),
         list_min([{_edit("a", "3", "D", _GONE)}, {_keep("u", "a")}, {_rerole("u", "assistant")}])
  FROM (
    SELECT conv_id, n, role, text, initial, must_go, cut, e, s, u, list_min([a, {_insert("u", "assistant")}]) AS a
    FROM (
      SELECT w.conv_id, m.n, m.role, m.text, m.initial, m.must_go, m.cut, w.e, w.s, w.a,
             list_min([u, {_insert("e", "user")}, {_insert("s", "user")}, {_insert("a", "user")}]) AS u
      FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.n + 1
    )
  )
), ended AS (
  SELECT w.conv_id, list_min([e, a, {_insert("u", "assistant")}, {_insert("su", "assistant")}]) AS best
  FROM (SELECT *, {_insert("s", "user")} AS su FROM walk) w JOIN figures f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.rows = w.n
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(left(best.body, greatest(length(best.body) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
""",
}
