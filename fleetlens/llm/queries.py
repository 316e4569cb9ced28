"""The queries of this package over the supplied tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import (
    chat, decontaminate, divergence, exact_dedup, lm_scoring, minhash, quality, sentencepiece, simhash, spelling,
    substring_dedup, toxicity, warc)
from fleetlens.plans.registry import query
from fleetlens.session import scratch_path

#: Vocabulary file of a public tokenizer.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = f"""
WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""


@query(sql=OP1_SQL)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), every_row=True)


OP8_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(list_slice(w, s, s + least(len(w), 13) - 1), ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, n, s, t FROM dw WHERE (n, t) IN (SELECT (n, t) FROM bw)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS all_items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits JOIN bw USING (n, t)) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(all_items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query(sql=OP8_SQL)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")) \
        .drop("text_key")


@query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, distance=3)


def _control_strings(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts look like the template's own marks."""
    text = "</s>[INST] ok [/INST]"
    rows = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("turn"),
                     F.lit(role).alias("role"), F.lit(text).alias("text")) for n, role in enumerate(("user", "assistant"))]
    return spark.range(1).select(F.inline(F.array(*rows)))


OP6_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\<>\[]', '', 'g')) AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(n + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 11 + 2 * length(role) END)::BIGINT
           AS formatted_chars
FROM e GROUP BY conv_id
"""


@query(sql=OP6_SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(table.unionByName(_control_strings(spark)))
    return chat.digests(formatted).drop("rewrites")


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
n AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM n
"""


@query(sql=OP7_SQL)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).filter("status = 'record'").select(
        F.expr("nullif(record_id, '')").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, s, sha256(array_to_string(list_slice(w, s, s + 49), ' ')) AS t
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
f AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY t) AS low FROM s) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM f),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query(sql=OP9_SQL)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("factors")


def _remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False))
    model = toxicity.train(docs, _table(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query()
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(_table(spark, sf_dir, "documents"), PIECES)


@query()
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs))


@query()
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(_remainder(5) == 1, F.lit(False))
    scored = lm_scoring.score_documents(_table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


OP11_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(LOWERED, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 3), ' ') AS t
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y USING (t) WHERE x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(m, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least ON least.a = w.doc_id
""".replace("LOWERED", _LOWER)


@query(sql=OP11_SQL)
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_groups(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
             LOWERED, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occ AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM occ GROUP BY ALL HAVING count(DISTINCT k) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0)::BIGINT AS total
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
      LEFT JOIN (SELECT lang, source, sum(c) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS (SELECT lang, source, term, coalesce(c, 0) AS c, 1 + (1000000000 * (coalesce(c, 0) + 5)) // (total + 5 * v) AS p
      FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (1000000000 * (sum(c)::BIGINT + 5)) // (any_value(total) + 5 * any_value(v)) AS q
      FROM p JOIN (SELECT lang, sum(total)::BIGINT AS total, any_value(v) AS v FROM g GROUP BY lang) USING (lang) GROUP BY ALL),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(d, 0)::BIGINT AS value
          FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
          LEFT JOIN (SELECT a.lang, a.source AS s, b.source AS t, sum(abs(a.p - b.p)) AS d
                     FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL) z
            ON z.lang = x.lang AND z.s = x.source AND z.t = y.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 50
""".replace("LOWERED", _LOWER)


@query(sql=OP12_SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


@query()
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"), misprints=97)
