"""Registered queries of the subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import ship, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@_query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents: words taken from each document under its source's target."""
    from martforge.llm.source_mix import mix_sources

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mix_sources(docs, word_count(F.col("text")), F.col("source"), F.col("doc_id"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


SQL["op3_source_mix"] = r"""
WITH d AS (SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS src,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s0 AS (SELECT no_source, src, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
s1 AS (SELECT *, row_number() OVER (ORDER BY no_source, src) AS no, sum(source_size) OVER ()::BIGINT * 1.5::DOUBLE AS total FROM s0),
s2 AS (SELECT *, [5, 2, 1][((no - 1) % 3 + 1)::INT] AS w, source_size * 2.0::DOUBLE AS cap FROM s1),
s3 AS (SELECT *, cap / w AS fill FROM s2),
s4 AS (SELECT *, row_number() OVER f AS k,
              (total - coalesce(sum(cap) OVER (ORDER BY fill, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY fill, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lvl
       FROM s3 WINDOW f AS (ORDER BY fill, no)),
stop AS (SELECT k AS stop_k, lvl AS stop_lvl FROM s4 WHERE fill >= lvl ORDER BY k LIMIT 1),
t AS (SELECT no_source, src, source_size, CASE WHEN k < stop_k THEN cap ELSE least(cap, stop_lvl * w) END AS target,
             ('0x' || substr(md5('mix-1|' || no_source::VARCHAR || '|' || src), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
      FROM s4, stop),
r AS (SELECT d.*, row_number() OVER (PARTITION BY no_source, src ORDER BY length(bin(size)),
             size >> greatest(length(bin(size)) - 4, 0), substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2), size, doc_id) - 1 AS rk FROM d),
j AS (SELECT r.doc_id, r.size, t.source_size, t.target, t.u, r.rk,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate FROM r JOIN t USING (no_source, src))
SELECT doc_id, size, source_size, target,
       (least(floor(rate * (rk + 1) + u) - floor(rate * rk + u), ceil(rate))::BIGINT * size)::BIGINT AS taken FROM j
"""


@_query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back."""
    from martforge.llm.chat_format import format_conversations, read_back

    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(rows.unionByName(more)))


SQL["op4_chat_format"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(regexp_replace(role, '(<)(\\*)(/?s>)', '\1\\\2\3', 'g'), '(\[)(\\*)(/?INST\])', '\1\\\2\3', 'g') AS er,
             regexp_replace(regexp_replace(text, '(<)(\\*)(/?s>)', '\1\\\2\3', 'g'), '(\[)(\\*)(/?INST\])', '\1\\\2\3', 'g') AS et FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<s>[INST]' || er || '[/INST]' || et || '</s>'))::BIGINT AS formatted_chars, true AS same_turns
FROM e GROUP BY conv_id
"""


@_query
def op9_piece_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded with the merge-type piece model and decoded again."""
    import public_tokenizers

    from martforge.llm.piece_encode import encode_decode

    ship(spark)
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality metrics and verdict of every document; its source stands for the host."""
    from martforge.llm.line_quality import line_quality

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return line_quality(docs, F.col("doc_id"), F.col("text"), F.col("source"))


SQL["op8_line_quality"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_repeat_words
        FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
              FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
ln AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM ln
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
norm AS (SELECT doc_id, source, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
                trim(regexp_replace(regexp_replace(lower(line), '\p{Nd}', '0', 'g'), '[^\p{L}0]+', ' ', 'g')) AS l FROM ln),
host AS (SELECT source, count(DISTINCT doc_id) AS host_docs FROM documents GROUP BY source),
freq AS (SELECT f.source, l FROM (SELECT source, l, count(DISTINCT doc_id) AS c FROM norm WHERE l <> '' GROUP BY source, l) f
         JOIN host ON f.source IS NOT DISTINCT FROM host.source WHERE c >= 5 AND 100 * c > 5 * host_docs),
gone AS (SELECT doc_id, sum(n)::BIGINT AS n_removed_words FROM norm JOIN freq ON norm.l = freq.l AND norm.source IS NOT DISTINCT FROM freq.source
         GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_words, 0) AS n_removed_words
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept FROM m
"""


@_query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text; a document stands for the repository, its source for the owner."""
    from martforge.llm.secret_scan import count_kind, scan_secrets, spell

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan_secrets(docs, F.col("doc_id"), F.col("text"), F.col("doc_id"), F.col("source"))
    count = [count_kind("base", k).alias(n) for k, n in enumerate(("n_assign", "n_access", "n_hex"))]
    live = F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live")
    return found.select("doc_id", *count, F.sha2(spell("base"), 256).alias("base_sha256"), spell("spans").alias("spans"), live)


@_query
def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, cut by size, language and source."""
    from martforge.llm.kd_shards import hash_scale, kd_shards, log_scale

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = kd_shards(docs, F.col("doc_id"), F.col("text"), [log_scale(F.coalesce(F.col("n_chars"), F.lit(0))), hash_scale(F.col("lang")), hash_scale(F.col("source"))])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query
def op6_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as token ids in seekable frame files, read back from them."""
    import public_tokenizers

    from martforge.llm.token_frames import read_token_frames, write_token_frames

    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_token_frames(write_token_frames(docs, public_tokenizers.path("byte_bpe_50k.json"), 2))


@_query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under a 3-word shingle Jaccard similarity of 0.9."""
    from martforge.llm.ngram_join import ngram_components

    ship(spark)
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL["op1_ngram_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 90 * (na.n + nb.n - i)),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) m ON m.a = w.doc_id
"""


@_query
def op5_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors at cosine 0.95: links, components and the kept ones."""
    from martforge.llm.embedding_forest import near_duplicates

    ship(spark)
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@_query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the documents that are not held out."""
    from martforge.llm.language_id import fit, held_out, identify

    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    doc_id, text = F.col("doc_id"), F.col("text")
    models = fit(docs, doc_id, text, F.col("lang"), ~held_out(doc_id))
    out = identify(docs, models, doc_id, text)
    return out.select("doc_id", held_out(doc_id).alias("held_out"), "lang_pred", "score", "entropy", "accepted")


def _span_rows(kind: int, pattern: str, group: int) -> str:
    """DuckDB rows (doc_id, source, kind, start, end, value) of all matches of a pattern; end exclusive."""
    return f"""SELECT doc_id, source, {kind} AS kind, begin_ AS start, begin_ + length(hits[i]) AS stop, vals[i] AS value FROM (
  SELECT doc_id, source, hits, vals, i, (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0))::BIGINT AS begin_
  FROM (SELECT doc_id, source, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits,
               regexp_extract_all(t, '{pattern}', {group}) AS vals, unnest(range(1, len(regexp_extract_all(t, '{pattern}')) + 1)) AS i FROM d))"""


SQL["op10_secret_scan"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, source FROM documents),
base AS (
  SELECT * FROM ({_span_rows(0, '''((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)''', 2)}) WHERE length(value) >= 6
  UNION ALL SELECT * FROM ({_span_rows(1, 'AKIA[A-Z0-9]+', 0)}) WHERE length(value) >= 20
  UNION ALL SELECT * FROM ({_span_rows(2, '[0-9a-f]{24,}', 0)}) WHERE length(value) >= 24),
mixed AS (
  SELECT * FROM ({_span_rows(3, '[A-Za-z0-9+/_-]{24,}', 0)}) m
  WHERE length(value) >= 24 AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.start < m.stop AND m.start < b.stop)),
both_ AS (SELECT * FROM base UNION ALL SELECT * FROM mixed),
live AS (SELECT value FROM (SELECT DISTINCT value, source, doc_id FROM both_) GROUP BY value
         HAVING count(DISTINCT source) + max((source IS NULL)::INT) <= 2 AND count(*) <= 20),
spans AS (SELECT b.*, l.value IS NOT NULL AS live, ['assign', 'access', 'hex', 'mixed'][kind + 1] || ':' || start || ':' || stop AS said
          FROM both_ b LEFT JOIN live l USING (value) WHERE kind < 3 OR l.value IS NOT NULL),
s AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
             string_agg(said, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(said, ',' ORDER BY start, kind) AS spans,
             count(*) FILTER (live) AS n_live FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN s USING (doc_id)
"""


@_query
def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents: near words, form and root of each."""
    from martforge.llm.spelling_groups import variant_groups

    ship(spark)
    return variant_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# crc32 byte by byte with its table made by the rule; near words by what is left when a letter goes.
SQL["op11_spelling_groups"] = r"""
WITH RECURSIVE t AS (SELECT list(c ORDER BY i) AS tbl FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)::BIGINT AS c FROM (SELECT unnest(range(256))::BIGINT AS i))),
r0 AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
       FROM documents),
r1 AS (SELECT doc_id, run, count(*) AS c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hx FROM r0 WHERE length(run) >= 7 GROUP BY ALL),
r2 AS (SELECT run, c, xor(list_reduce(list_transform(range(0, length(hx) // 2), lambda k: ('0x' || substr(hx, 2 * k::INT + 1, 2))::BIGINT),
         lambda a, b: xor(a >> 8, tbl[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM r1, t),
v AS (SELECT word, sum(c)::BIGINT AS n FROM (SELECT c, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
        ELSE run END AS word FROM r2) WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
del AS (SELECT DISTINCT word, n, k, left(word, k::INT) || substr(word, k::INT + 2) AS s FROM (SELECT *, unnest(range(0, length(word))) AS k FROM v)),
near AS (SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM del a JOIN del b ON a.k = b.k AND a.s = b.s AND a.word <> b.word
         UNION SELECT v.word, d.word, d.n FROM v JOIN del d ON d.s = v.word
         UNION SELECT d.word, v.word, v.n FROM v JOIN del d ON d.s = v.word),
best AS (SELECT word, count(*)::BIGINT AS n_near, arg_min(other, (-m, encode(other))) AS other, max(m) AS m FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * v.n THEN other END AS form, CASE WHEN m >= 10 * v.n THEN m END AS form_n
      FROM v LEFT JOIN best USING (word)),
walk(word, reached, ahead) AS (SELECT word, word, form FROM f UNION ALL SELECT w.word, w.ahead, f.form FROM walk w JOIN f ON f.word = w.ahead)
SELECT f.word, f.form, w.reached AS root, f.n, f.n_near, f.form_n FROM f JOIN walk w ON w.word = f.word AND w.ahead IS NULL
"""


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item, from one scan of all texts."""
    from martforge.llm.lexical_search import lexical_search

    ship(spark)
    return lexical_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

SQL["op12_lexical_search"] = rf"""
WITH d AS (SELECT doc_id, {_TERMS} FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
c AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM len),
w AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS} FROM benchmark)),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN len USING (doc_id), c GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""


@_query
def op13_vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    from martforge.llm.vantage_search import nearest

    ship(spark)
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


SQL["op13_vantage_search"] = r"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
             AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_transform(list_zip(q.x, v.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
      FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id AND len(q.x) = len(v.x))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank FROM d) WHERE rank <= 10
"""
