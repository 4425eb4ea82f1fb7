"""The registered queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff_lm, balanced_ann, edit_decontam, entropy_mix, fuzzy_lines, lexical_scan, merkle_manifest, mixed_langid, rans_tokens, simhash_gray, token_scan, tool_links, warc_zstd
from .common import shared_folder, table


def op3_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_gray.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_mixed_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = mixed_langid.train(mixed_langid.training_rows(docs))
    texts = docs.select("doc_id", mixed_langid.held_out().alias("held_out"), "text")
    return mixed_langid.predict(texts, model).select("doc_id", "held_out", "lang_pred", "score",
                                                     F.size("spans").alias("n_spans"))


def op5_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = entropy_mix.sized(table(spark, sf_dir, "documents"))
    return entropy_mix.mix(docs, size=F.col("size")).select("doc_id", "size", "source_size", "target", "taken")


def op6_edit_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.judged_lines(table(spark, sf_dir, "documents"))


def op10_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.score(table(spark, sf_dir, "documents"))


def op7_warc_zstd_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc_zstd.write_archives(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    return warc_zstd.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN strlen(html) >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 1000 AND page_id < last THEN last END AS refers_to
FROM (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS last
      FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
"""


def op8_token_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.token_counts(table(spark, sf_dir, "documents"), shared_folder(spark, "tokens"))


def op11_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans_tokens.roundtrip(table(spark, sf_dir, "documents"), shared_folder(spark, "rans"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verified(merkle_manifest.document_manifest(table(spark, sf_dir, "documents")))


def op13_lexical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_scan.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_balanced_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op1_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_links.from_turns(table(spark, sf_dir, "conversations"))
    return tool_links.link(calls, results, tool_links.SCHEMAS)


OP1_SQL = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, role, text FROM conversations WHERE role IN ('system', 'user')
), walks AS (
  SELECT conv_id, turn, turn AS at, CAST(0 AS BIGINT) AS steps FROM calls
  UNION
  SELECT w.conv_id, w.turn, c.turn, w.steps + 1
  FROM walks w JOIN calls c ON c.conv_id = w.conv_id AND c.turn IN (w.at - 1, w.at - 2)
), levels AS (SELECT conv_id, turn, max(steps) AS level FROM walks GROUP BY ALL)
SELECT c.conv_id, c.conv_id || ':' || c.turn AS call_id, c.turn AS position, l.level,
       CASE c.role WHEN 'user' THEN 'ask' ELSE 'configure' END AS tool,
       CASE WHEN r.text IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
       true AS valid, '' AS faults, CAST(0 AS BIGINT) AS duplicates,
       '{"arguments":{"text":' || to_json(c.text) || ',"turn":' || c.turn
       || CASE c.role WHEN 'user' THEN ',"words":' || len(regexp_split_to_array(trim(c.text), '\\s+')) ELSE '' END
       || '},"call_id":"' || c.conv_id || ':' || c.turn || '","conv_id":' || c.conv_id || ',"level":' || l.level
       || ',"result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null')
       || ',"tool":"' || CASE c.role WHEN 'user' THEN 'ask' ELSE 'configure' END || '"}' AS message
FROM calls c JOIN levels l USING (conv_id, turn)
LEFT JOIN conversations r ON r.role = 'assistant' AND r.conv_id = c.conv_id AND r.turn = c.turn + 1
"""


_FIELDS = " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
                      for c in ("doc_id", "source", "lang", "{chars}", "text"))
# the CRC-32 of a decimal number, bit by bit: each character is taken in, then shifted out in eight steps
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_prepend(CAST(ascii(c) AS BIGINT), list_transform(range(8), lambda i: CAST(-1 AS BIGINT)))))),
  lambda a, o: CASE WHEN o >= 0 THEN xor(a, o) WHEN a % 2 = 1 THEN xor(a // 2, CAST(3988292384 AS BIGINT)) ELSE a // 2 END), CAST(4294967295 AS BIGINT))"""
OP12_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, sha256({_FIELDS.format(chars="n_chars")}) AS leaf,
    CASE WHEN {_CRC} % 7 = 0 THEN sha256({_FIELDS.format(chars="(n_chars + 1)")}) END AS changed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos FROM leaves
), nodes AS (
  SELECT lang, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), max((n + 1) // 2)
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2
), subroots AS (
  SELECT lang, level AS depth, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, place AS pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), max((n + 1) // 2) FROM upper WHERE n > 1 GROUP BY level, pos // 2
), siblings AS (
  SELECT p.doc_id, p.lang, p.pos, n.level AS step, CASE WHEN n.pos < (p.pos >> n.level) THEN n.h END AS l, CASE WHEN n.pos > (p.pos >> n.level) THEN n.h END AS r
  FROM placed p JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.pos = xor(p.pos >> n.level, 1)
  UNION ALL
  SELECT p.doc_id, p.lang, p.pos, s.depth + u.level, CASE WHEN u.pos < (s.place >> u.level) THEN u.h END, CASE WHEN u.pos > (s.place >> u.level) THEN u.h END
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN upper u ON u.pos = xor(s.place >> u.level, 1)
), fold AS (
  SELECT p.lang, p.pos, 0 AS step, coalesce(changed, leaf) AS h, s.depth + (SELECT max(level) FROM upper) AS steps
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
  UNION ALL
  SELECT f.lang, f.pos, f.step + 1, sha256(coalesce(x.l, '') || f.h || coalesce(x.r, '')), f.steps
  FROM fold f LEFT JOIN siblings x ON x.lang IS NOT DISTINCT FROM f.lang AND x.pos = f.pos AND x.step = f.step
  WHERE f.step < f.steps
), proofs AS (
  SELECT lang, pos, sha256(string_agg(coalesce(l, r), '' ORDER BY step)) AS proof FROM siblings GROUP BY lang, pos
), root AS (SELECT h AS root FROM upper WHERE n = 1)
SELECT p.doc_id, p.leaf, s.subroot, root.root, coalesce(q.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root.root AS verified
FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang CROSS JOIN root
JOIN fold f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos AND f.step = f.steps
LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.pos = p.pos
"""

_TERMS = """unnest(regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"""
OP13_SQL = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, text FROM documents
), tf AS (
  SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, {_TERMS.format("text")} FROM docs) t GROUP BY ALL
), sizes AS (
  SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r
), corpus AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf CROSS JOIN corpus GROUP BY term
), wanted AS (
  SELECT item_id, text, term, count(*) AS times FROM (SELECT DISTINCT item_id, text, text AS t FROM benchmark) b
  CROSS JOIN LATERAL (SELECT {_TERMS.format("b.t")}) x GROUP BY ALL
), scored AS (
  SELECT q.item_id, q.text, t.doc_id, t.r,
    sum(q.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * s.n * c.n_docs) // c.n_terms))))::BIGINT AS score
  FROM wanted q JOIN tf t USING (term) JOIN weights w USING (term) JOIN sizes s USING (r) CROSS JOIN corpus c
  GROUP BY q.item_id, q.text, t.doc_id, t.r
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0) x
WHERE rank <= 20
"""


QUERIES = {
    "op1_tool_links": op1_tool_links,
    "op2_balanced_ann": op2_balanced_ann,
    "op7_warc_zstd_dict": op7_warc_zstd_dict,
    "op8_token_separator_scan": op8_token_separator_scan,
    "op10_stupid_backoff": op10_stupid_backoff,
    "op9_fuzzy_lines": op9_fuzzy_lines,
    "op4_mixed_language_id": op4_mixed_language_id,
    "op5_entropy_mix": op5_entropy_mix,
    "op6_edit_decontam": op6_edit_decontam,
    "op3_simhash_gray": op3_simhash_gray,
    "op11_rans_tokens": op11_rans_tokens,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_lexical_scan": op13_lexical_scan,
}
ORACLES = {"op1_tool_links": OP1_SQL, "op7_warc_zstd_dict": OP7_SQL, "op12_merkle_manifest": OP12_SQL, "op13_lexical_scan": OP13_SQL}
