"""The queries op1 to op13, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embed_dedup, langid, minhash, mixture, search, secret_scan, sentencepiece_codec, suffix_dedup, tokenbin, toxicity, turns, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors. A null, zero or non-finite vector or a null label links with nothing; rows of null or repeated vec_id are vectors of their own."""
    return embed_dedup.vector_links(_table(spark, sf_dir, "embeddings"), 0.98)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each whole text loses to 400-byte repeats. Null is empty; rows of null or repeated doc_id are documents of their own."""
    return suffix_dedup.repeated_spans(_table(spark, sf_dir, "documents"), 400).drop("spans")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents. Null, empty and wordless texts stand alone; rows of null or repeated doc_id are documents of their own."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), 5, 75)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded, row by row. Null is empty and has no ids."""
    return sentencepiece_codec.encode_decode(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back. Null html is an empty payload; rows of null page_id are left out; a repeated row of a response revisits it."""
    return warc.archive_table(_table(spark, sf_dir, "pages"), 0).drop("url")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark. Null has no words; rows of null or repeated doc_id are documents of their own; an item without an id is the item of the empty id."""
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, row by row. A null text, or one without letters, is und with score 0; rows of null doc_id are held out by neither value."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()).select("lang", "text"))
    out = langid.identify(docs, model)
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in token files, read back. Null is empty and has the end id; rows of null doc_id are left out, repeated ones stand side by side."""
    return tokenbin.token_table(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), 1)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every text, row by row. Null and empty texts score as texts without a match; null labels teach nothing."""
    docs = _table(spark, sf_dir, "documents")
    held = langid.held_out(parts=3, part=1)
    labels = _table(spark, sf_dir, "labels").where(~held).select("doc_id", "toxic")
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels))
    out = toxicity.score(docs, lexicon, 0.7)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", "n_words", F.size("matches").alias("n_matches"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate finding with the forest's verdict; null and empty texts give none, rows of one doc_id give their own."""
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs)).drop("token")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged by rule, then repaired at least cost. A null conv_id is a conversation; one without rows left has zeros and the empty digest."""
    given = _table(spark, sf_dir, "conversations")
    return turns.repair_table(given, turns.damaged(given))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of each document. A null text has size 0; a null source is the last one."""
    return mixture.mix_table(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each item, of all documents. Null texts have no terms; an item without a hit has no row."""
    return search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 50)


QUERIES = {f.__name__: f for f in (op1_embedding_near_dedup, op2_suffix_array_dedup, op3_minhash_near_dedup, op4_sentencepiece, op5_warc, op6_decontamination, op7_language_id, op8_token_files, op9_toxicity, op10_secret_scan, op11_conversation_repair, op12_source_mixing, op13_ranked_search)}

_COMPONENTS = """
reach(id, r) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT l.v, reach.r FROM reach JOIN links l ON l.u = reach.id
),
comp AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
"""

SQL = {
    "op1_embedding_near_dedup": f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.98
),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_COMPONENTS}
SELECT n.id AS vec_id, coalesce(c.n, 0)::BIGINT AS n_links, k.component_id, n.id = k.component_id AS kept
FROM nodes n JOIN comp k ON k.id = n.id LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY u) c ON c.u = n.id
""",
    "op3_minhash_near_dedup": rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM docs
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
nodes AS (SELECT doc_id AS id FROM documents),
{_COMPONENTS}
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, k.component_id, d.doc_id = k.component_id AS kept
FROM docs d JOIN comp k ON k.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
""",
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(h, 1 + 5 * i, 5))::BIGINT) AS q, max(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
  array_to_string(list_transform(q, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 15) & 31), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 10) & 31), 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> 5) & 31), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (x & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> head THEN head END AS refers_to
FROM g
""",
    "op6_decontamination": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, 10 AS k, unnest(list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' '))) AS run FROM b WHERE len(w) >= 10
  UNION ALL SELECT item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 9
),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS pos, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS run FROM d, sizes WHERE len(w) >= k),
hit AS (SELECT dw.doc_id, pos, dw.k, item_id FROM dw JOIN bw ON bw.k = dw.k AND bw.run = dw.run),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN named m USING (doc_id)
""",
    "op11_conversation_repair": r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_reduce([4294967295::BIGINT] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT),
      lambda c, b: list_reduce([xor(c, b)] || list_value(0::BIGINT, 0, 0, 0, 0, 0, 0, 0), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS register
  FROM conversations
),
dealt AS (SELECT *, xor(register, 4294967295) % 20 AS kind FROM given),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM dealt WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS told FROM damaged
),
flagged AS (
  SELECT *, told = '' AS blank, told <> '' AND seen > 1 AS duplicate, told <> '' AND seen = 1 AND right(told, 1) NOT IN ('.', '!', '?') AS truncated,
    substr(role, 1, 1) AS c, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM placed
),
paths AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 'e' AS state, 0::BIGINT AS cost, '' AS audit, '' AS said FROM flagged
  UNION ALL
  SELECT conv_id, i, state, cost, audit, said FROM (
    SELECT x.conv_id, x.i, x.state, x.cost, x.audit, x.said, row_number() OVER (PARTITION BY x.conv_id, x.state ORDER BY x.cost, x.audit) AS best FROM (
      SELECT f.conv_id, f.i, m.state, m.cost + w.cost AS cost, m.audit || w.letter AS audit, m.said || CASE WHEN w.letter = 'D' THEN '' ELSE chr(30) || w.role || ':' || f.text END AS said, w.state AS wanted
      FROM (
        SELECT conv_id, i, state, cost, audit, said FROM paths
        UNION ALL SELECT conv_id, i, 'u', cost + 2, audit || 'I', said || chr(30) || 'user:' FROM paths WHERE state <> 'u'
        UNION ALL SELECT conv_id, i, 'a', cost + 2, audit || 'I', said || chr(30) || 'assistant:' FROM paths WHERE state = 'u'
        UNION ALL SELECT conv_id, i, 'a', cost + 4, audit || 'II', said || chr(30) || 'user:' || chr(30) || 'assistant:' FROM paths WHERE state <> 'u'
      ) m
      JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.i = m.i + 1,
      LATERAL (
        SELECT 'D' AS letter, 3 AS cost, m.state AS state, '' AS role
        UNION ALL SELECT 'K', CASE WHEN f.truncated THEN 1 ELSE 0 END, f.c, f.role WHERE NOT f.blank AND NOT f.duplicate AND ((f.c = 's' AND m.state = 'e') OR (f.c = 'u' AND m.state <> 'u') OR (f.c = 'a' AND m.state = 'u'))
        UNION ALL SELECT 'R', CASE WHEN f.truncated THEN 3 ELSE 2 END, CASE WHEN m.state = 'u' THEN 'a' ELSE 'u' END, CASE WHEN m.state = 'u' THEN 'assistant' ELSE 'user' END WHERE NOT f.blank AND NOT f.duplicate
      ) w
    ) y(conv_id, i, before, cost, audit, said, state), LATERAL (SELECT y.conv_id, y.i, y.state, y.cost, y.audit, y.said) x
  ) WHERE best = 1
),
ends AS (
  SELECT conv_id, cost, audit, said FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS best FROM (
      SELECT p.conv_id, p.cost, p.audit, p.said FROM paths p JOIN (SELECT conv_id, max(i) AS n FROM flagged GROUP BY conv_id) q ON p.conv_id IS NOT DISTINCT FROM q.conv_id AND p.i = q.n WHERE p.state IN ('e', 'a')
      UNION ALL SELECT p.conv_id, p.cost + 2, p.audit || 'I', p.said || chr(30) || 'assistant:' FROM paths p JOIN (SELECT conv_id, max(i) AS n FROM flagged GROUP BY conv_id) q ON p.conv_id IS NOT DISTINCT FROM q.conv_id AND p.i = q.n WHERE p.state = 'u'
      UNION ALL SELECT p.conv_id, p.cost + 4, p.audit || 'II', p.said || chr(30) || 'user:' || chr(30) || 'assistant:' FROM paths p JOIN (SELECT conv_id, max(i) AS n FROM flagged GROUP BY conv_id) q ON p.conv_id IS NOT DISTINCT FROM q.conv_id AND p.i = q.n WHERE p.state <> 'u'
    )
  ) WHERE best = 1
),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (p IS NOT NULL AND p || c NOT IN ('su', 'ua', 'au')) AS illegal FROM flagged GROUP BY conv_id
)
SELECT h.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate, coalesce(s.truncated, 0)::BIGINT AS truncated,
  coalesce(s.illegal, 0)::BIGINT AS illegal, coalesce(e.cost, 0)::BIGINT AS cost, coalesce(e.audit, '') AS audit, sha256(replace(substr(coalesce(e.said, ''), 2), chr(30), chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) h LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM h.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM h.conv_id
""",
    "op13_ranked_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
total AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS terms FROM d),
sizes AS (SELECT r, doc_id, 50 + (50 * len(w)::BIGINT * docs) // greatest(terms, 1) AS m FROM d, total),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
q AS (SELECT DISTINCT item_id, unnest(list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term FROM benchmark),
scored AS (
  SELECT q.item_id, s.doc_id, sum(weights.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * s.m)))::BIGINT AS score
  FROM q JOIN weights USING (term) JOIN tf USING (term) JOIN sizes s USING (r) GROUP BY q.item_id, tf.r, s.doc_id
),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
""",
}
