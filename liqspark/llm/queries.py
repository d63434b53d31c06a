"""Registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, fingerprint, mixing, neighbours, ngram_jaccard, pieces, quality, secrets, toxicity, trie, url_filter, warc
from .tables import stored, table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against the rules and the list of the canonical URLs of the stated query set
    (pages whose id is divisible by 50)."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.url_filter(pages, pages.where("page_id % 50 = 0")).drop("maybe")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.ngram_jaccard(table(spark, sf_dir, "documents")).drop("group_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels")))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger is stored once; policy and ablations read its bits. ``n_sole``: documents that the policy
    would keep without the row's sole rule."""
    ledger = stored(quality.quality_ledger(table(spark, sf_dir, "documents")), "ledger")
    alone = quality.ablations(ledger).where("policy = 'v3'").select(F.col("rule").alias("sole_rule"), F.col("alone").alias("n_sole"))
    judged = quality.apply_policy(ledger, "v3").join(F.broadcast(alone), "sole_rule", "left")  # a row for each rule
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "fail_bits", "sole_rule", "n_sole")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_neighbours(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """A public tokenizer's file, the SentencePiece model by default; LLM_TOKENIZERS names another folder of models."""
    folder = os.environ.get("LLM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), pieces.model_bytes(tokenizer_path()))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolve_revisits(warc.page_captures(table(spark, sf_dir, "pages")))


def op10_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        byte_model = f.read()
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), byte_model, pieces.model_bytes(tokenizer_path()))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def _sql_canonical(url: str) -> str:
    host = f"regexp_replace(regexp_replace({_sql_host(url)}, '^www[.]', ''), ':(80|443)$', '')"
    path = f"regexp_replace({_sql_path(url)}, '([.]html|/+)$', '')"
    query = (f"regexp_replace(regexp_replace(regexp_extract(coalesce({url}, ''), '://[^?#]*\\?([^#]*)', 1), "
             f"'{url_filter.TRACKING}', '', 'g'), '^&', '')")
    return (f"CASE WHEN {_sql_host(url)} = '' THEN '' ELSE {host} || {path} || "
            f"CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END")


def _sql_host(url: str) -> str:
    return f"translate(regexp_extract(coalesce({url}, ''), '://([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}')"


def _sql_path(url: str) -> str:
    return f"regexp_extract(coalesce({url}, ''), '://[^/?#]*([^?#]*)', 1)"


def _sql_rules(what: int) -> str:
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    tests = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
                     f"THEN '{(h + p) if what == 0 else v}'" for v, h, p in rules)
    return f"CASE {tests} END"


# Whether a URL passed the Bloom filter depends on hashes that DuckDB lacks, so the query
# leaves that column out.
SQL_OP1 = f"""
WITH p AS (SELECT page_id, {_sql_host('url')} AS host, {_sql_path('url')} AS path, {_sql_canonical('url')} AS canonical FROM pages),
listed AS (SELECT DISTINCT canonical FROM p WHERE page_id % 50 = 0 AND canonical <> ''),
j AS (SELECT p.*, canonical IN (SELECT canonical FROM listed) AS listed FROM p)
SELECT page_id, host, path, {_sql_rules(0)} AS rule,
       coalesce({_sql_rules(1)}, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, canonical, listed
FROM j"""


def _sql_hits() -> str:
    one = []
    for name, pattern, group in [("assign", secrets.ASSIGN, 2), ("access", secrets.ACCESS, 0), ("hex", secrets.HEX, 0),
                                 *((n, p, 0) for n, p in secrets.PARTS)]:
        p = "'" + pattern.replace("'", "''") + "'"
        one.append(f"SELECT doc_id, '{name}' AS kind, unnest(range(len(string_split_regex(t, {p})))) AS pos, "
                   f"unnest(string_split_regex(t, {p})) AS gap, unnest(regexp_extract_all(t, {p}, 0)) AS m, "
                   f"unnest(regexp_extract_all(t, {p}, {group})) AS v FROM d WHERE regexp_matches(t, {p})")
    return "\nUNION ALL ".join(one)


def _sql_in(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


SQL_OP2 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({_sql_hits()}),
ends AS (SELECT *, sum(length(gap) + coalesce(length(m), 0)) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS "end" FROM hits),
spans AS (SELECT doc_id, CAST("end" - length(m) AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end",
  CASE WHEN kind = 'assign' AND length(v) < 6 OR kind = 'access' AND length(m) < 10 THEN NULL
       WHEN kind = 'assign' AND length(v) < 12 THEN 'weak_assign' WHEN kind = 'access' AND length(m) < 18 THEN 'weak_access'
       ELSE kind END AS kind FROM ends WHERE m IS NOT NULL),
linked AS (SELECT * FROM spans s WHERE kind IN ({_sql_in(secrets.BASE)})
  OR kind = 'weak_assign' AND EXISTS (SELECT 1 FROM spans o WHERE o.doc_id = s.doc_id AND o.kind IN ({_sql_in(secrets.IDENTIFIERS + secrets.ENDPOINTS)})
     AND o.start <= s."end" + {secrets.SCOPE} AND o."end" >= s.start - {secrets.SCOPE})
  OR kind = 'weak_access' AND EXISTS (SELECT 1 FROM spans o WHERE o.doc_id = s.doc_id AND o.kind IN ({_sql_in(secrets.SECRETS)})
     AND o.start <= s."end" + {secrets.SCOPE} AND o."end" >= s.start - {secrets.SCOPE})),
named AS (SELECT *, kind || ':' || start || ':' || "end" AS name, list_position([{_sql_in(secrets.KINDS)}], kind) AS rank FROM linked),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, string_agg(name, ',' ORDER BY start, rank) FILTER (kind IN ({_sql_in(secrets.BASE)})) AS base,
  string_agg(name, ',' ORDER BY start, rank) AS spans, count(*) FILTER (kind NOT IN ({_sql_in(secrets.BASE)})) AS n_linked
  FROM named GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM d LEFT JOIN g USING (doc_id)"""

SQL_OP5 = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))) AS mark, row_number() OVER () AS row FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM d GROUP BY source),
s1 AS (SELECT *, CASE number % 3 WHEN 1 THEN 3.0::DOUBLE WHEN 2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
       CAST(2 * source_size AS DOUBLE) AS bound, sum(source_size) OVER () AS total FROM s0),
s2 AS (SELECT *, bound / weight AS full_at, sum(weight) OVER () AS weights FROM s1),
s3 AS (SELECT *, (1.5::DOUBLE * CAST(total AS DOUBLE) - coalesce(sum(bound) OVER w, 0)) / (weights - coalesce(sum(weight) OVER w, 0)) AS rate
       FROM s2 WINDOW w AS (ORDER BY full_at, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, number, coalesce(least(bound, weight * max(CASE WHEN full_at > rate THEN rate END) OVER ()), bound) AS target FROM s3),
q AS (SELECT d.*, source_size, number, target, CAST(sum(size) OVER (PARTITION BY number ORDER BY mark, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS begin
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, (size + 63) // 64 AS n, unnest(range(2 * ((size + 63) // 64))) AS piece FROM q WHERE size > 0),
p AS (SELECT *, least(64, size - piece % n * 64) AS offered, begin + piece // n * source_size + piece % n * 64 AS start FROM k),
r AS (SELECT *, sum(offered) OVER (ORDER BY CAST(start + offered AS DOUBLE) / target, number, start ROWS UNBOUNDED PRECEDING) AS running FROM p),
u AS (SELECT row, sum(greatest(0, least(offered, (SELECT CAST(floor(1.5 * sum(size)) AS BIGINT) FROM d) - running + offered))) AS taken FROM r GROUP BY row)
SELECT doc_id, source, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM q LEFT JOIN u USING (row)"""

SQL_OP6 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS word,
             unnest(range(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')))) AS pos FROM d),
r AS (SELECT doc_id, pos, string_agg(word, ' ') OVER f AS run, count(*) OVER f AS n FROM w
      WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
m AS (SELECT doc_id, pos, n = 8 AND count(*) OVER (PARTITION BY doc_id, run, n) > 1 AS again FROM r),
c AS (SELECT doc_id, max(CAST(again AS INT)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM m),
reps AS (SELECT doc_id, CAST(sum(hit) AS BIGINT) AS n_repeat_words FROM c GROUP BY doc_id),
words AS (SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars FROM w GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
x AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower
      FROM d LEFT JOIN words USING (doc_id) LEFT JOIN reps USING (doc_id) LEFT JOIN lines USING (doc_id)),
b AS (SELECT *, CAST(CAST(n_words < 20 AS INT) + 2 * CAST(100 * n_repeat_words > 30 * n_words AS INT) + 4 * CAST(10 * n_symbols > n_words AS INT)
        + 8 * CAST(2 * n_dup_lines > n_lines AS INT) + 16 * CAST(word_chars < 2 * n_words OR word_chars > 20 * n_words AS INT)
        + 32 * CAST(n_upper > 20 AND 2 * n_upper > n_upper + n_lower AS INT) AS BIGINT) AS fail_bits FROM x),
c2 AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits,
  CASE fail_bits WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'symbols' WHEN 8 THEN 'repeated_lines'
                 WHEN 16 THEN 'word_length' WHEN 32 THEN 'shouting' END AS sole_rule FROM b)
SELECT *, CASE WHEN sole_rule IS NOT NULL THEN count(*) OVER (PARTITION BY sole_rule) END AS n_sole FROM c2"""

SQL_OP9 = f"""
WITH p AS (SELECT *, md5(coalesce(html, '')) AS body FROM pages),
f AS (SELECT 'f' || page_id AS record_id, {_sql_canonical('url')} AS canonical, page_id * 1000 AS time, body AS etag,
        'day ' || (page_id % 9) AS last_modified, body AS digest, 'max-age=60' AS cache, CAST(length(coalesce(html, '')) AS VARCHAR) AS size FROM p),
a AS (SELECT 'r' || page_id AS record_id, {_sql_canonical('url')} AS canonical,
        CASE WHEN page_id % 11 = 0 THEN page_id * 1000 - 500 ELSE page_id * 1000 + ((page_id * 7919) % 9973 + 1) * 50 END AS time,
        CASE WHEN page_id % 5 = 0 THEN md5('new:' || page_id) WHEN page_id % 7 <> 0 THEN body END AS etag,
        'day ' || (page_id % 9 + CASE WHEN page_id % 35 = 14 THEN 1 ELSE 0 END) AS last_modified,
        'day ' || (page_id + 1) AS date, 'day ' || (page_id + 2) AS expires FROM p),
j AS (SELECT a.*, f.record_id AS response_id, f.digest, f.cache, f.size, f.etag AS f_etag, f.last_modified AS f_modified,
        row_number() OVER (PARTITION BY a.record_id ORDER BY f.time DESC, f.record_id DESC) AS place
      FROM a LEFT JOIN f ON a.canonical = f.canonical AND a.canonical <> '' AND f.time < a.time),
o AS (SELECT *, CASE WHEN response_id IS NULL THEN 'missing'
        WHEN coalesce(CASE WHEN etag IS NOT NULL THEN etag = f_etag ELSE last_modified = f_modified END, false) THEN 'resolved' ELSE 'changed' END AS outcome
      FROM j WHERE place = 1)
SELECT record_id, nullif(canonical, '') AS canonical, response_id, outcome, CASE WHEN outcome = 'resolved' THEN digest END AS digest,
  CASE WHEN outcome = 'resolved' THEN 'cache-control: ' || cache || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html'
    || chr(10) || 'date: ' || date || chr(10) || 'expires: ' || expires END AS headers FROM o"""

SQL_OP10 = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.*, perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
        CASE WHEN speaker <> 'system' AND speaker <> perspective THEN speaker END AS name
      FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
h AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM r),
g AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM h),
e AS (SELECT *, CAST(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS seg_end FROM g)
SELECT conv_id, perspective, turn, role, name, segment, seg_end - length(segment) AS seg_start, seg_end,
  CASE WHEN role = 'assistant' THEN concat(seg_end - length(segment) + length(head), ':', seg_end - 1) ELSE '' END AS mask FROM e"""

# crc32 of the decimal id, bit by bit: a byte is put in, then eight shifts follow it.
SQL_OP13 = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS own, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(CAST(conv_id AS VARCHAR), ''), lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::BIGINT ELSE 0 END) END), 4294967295::BIGINT) % 4 AS h
      FROM t GROUP BY conv_id),
b AS (SELECT c.*, least(c.h, coalesce(o.own, 0)) AS got FROM c LEFT JOIN c o ON o.conv_id = c.base),
r AS (SELECT b.conv_id, place AS depth, role, text FROM b JOIN t ON t.conv_id = b.base AND place <= h
      UNION ALL SELECT b.conv_id, got + place - h, role, text FROM b JOIN t ON t.conv_id = b.conv_id AND place > h),
k AS (SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
        md5(string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM b),
l AS (SELECT conv_id, max(depth) AS length FROM k GROUP BY conv_id),
n AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM k GROUP BY key, depth),
e AS (SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM k JOIN l USING (conv_id) WHERE depth = length GROUP BY key),
p AS (SELECT DISTINCT x.key, y.key AS parent FROM k x JOIN k y ON x.conv_id = y.conv_id AND y.depth = x.depth - 1),
m AS (SELECT parent AS key, count(*) AS n_children FROM p GROUP BY parent),
u AS (SELECT DISTINCT x.key AS above, y.key FROM k x JOIN k y ON x.conv_id = y.conv_id AND x.depth <= y.depth),
s AS (SELECT above AS key, CAST(count(*) FILTER (m.key IS NULL) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
      FROM u JOIN n ON n.key = u.key LEFT JOIN m ON m.key = u.key GROUP BY above)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN s USING (key) LEFT JOIN m USING (key) LEFT JOIN e USING (key) LEFT JOIN p USING (key) LEFT JOIN n q ON q.key = p.parent"""

QUERIES = {f.__name__: f for f in (op1_url_filter, op2_secret_scan, op3_ngram_jaccard, op4_toxicity, op5_source_mix, op6_quality_rules,
                                   op7_fingerprint, op8_sentencepiece, op9_warc_revisits, op10_chat_rotation, op11_nearest_neighbours,
                                   op12_tokenizer_alignment, op13_conversation_trie)}
ORACLES = {"op1_url_filter": SQL_OP1, "op2_secret_scan": SQL_OP2, "op5_source_mix": SQL_OP5, "op6_quality_rules": SQL_OP6,
           "op9_warc_revisits": SQL_OP9, "op10_chat_rotation": SQL_OP10,
           "op13_conversation_trie": SQL_OP13}
