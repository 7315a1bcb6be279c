"""Registered queries of the training-data operators."""

from __future__ import annotations

from walletflow.llm import (
    binary_packing,
    fertility_rules,
    language_score,
    link_trust,
    merge_rounds,
    piece_spans,
    prefix_trie,
    secret_scan,
    sharding,
    simhash_dedup,
    source_divergence,
    vector_search,
    warc_archive,
)
from walletflow.llm.common import read_table

QUERIES: dict = {}
ORACLE: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; pass another path to the operators to use other files."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_secret_scan(spark, sf_dir):
    return secret_scan.secret_report(read_table(spark, sf_dir, "documents"))


@query
def op3_sharding(spark, sf_dir):
    return sharding.shard_report(read_table(spark, sf_dir, "documents"))


@query
def op6_packing(spark, sf_dir):
    import public_tokenizers

    return binary_packing.packing_report(
        read_table(spark, sf_dir, "documents"),
        vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256},
    )


@query
def op7_url_filter(spark, sf_dir):
    judged = link_trust.judge_pages(read_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op9_simhash_dedup(spark, sf_dir):
    return simhash_dedup.simhash_report(read_table(spark, sf_dir, "documents"))


@query
def op4_vector_search(spark, sf_dir):
    return vector_search.exact_top(read_table(spark, sf_dir, "embeddings"))


@query
def op5_fertility(spark, sf_dir):
    return fertility_rules.fertility_report(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op8_bpe(spark, sf_dir):
    return merge_rounds.encoding_report(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op10_warc(spark, sf_dir):
    return warc_archive.archive_report(read_table(spark, sf_dir, "pages"))


@query
def op2_language_score(spark, sf_dir):
    return language_score.score_documents(read_table(spark, sf_dir, "documents"))


@query
def op11_source_divergence(spark, sf_dir):
    return source_divergence.divergence_report(read_table(spark, sf_dir, "documents"))


@query
def op12_piece_spans(spark, sf_dir):
    return piece_spans.piece_report(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


ORACLE["op4_vector_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.w, v.w) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id
),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLE["op10_warc"] = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

ORACLE["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
l AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT d.lang, d.source, coalesce(any_value(s.total), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) AS d
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source) AS s USING (lang, source)
  GROUP BY d.lang, d.source
),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
    1 + (1000000000 * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
r AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM pairs LEFT JOIN sums USING (lang, source, item)
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE["op13_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL
),
n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
crc AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS base,
    xor(list_reduce(
      list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda a, x: list_reduce(range(8), lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END, xor(a, x)),
      CAST(4294967295 AS BIGINT)
    ), 4294967295) % 9 AS h
  FROM n
),
c AS (SELECT crc.conv_id, base, h, least(h, coalesce(b.n, 0)) AS k FROM crc LEFT JOIN n AS b ON b.conv_id = base),
r AS (
  SELECT c.conv_id, t.i AS depth, role, text FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, t.i - c.h + c.k, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h
),
m AS (
  SELECT conv_id, depth, strlen(text) AS bytes,
    list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM r
  UNION ALL
  SELECT conv_id, 0, 0, [] FROM c
),
e AS (SELECT conv_id, max(depth) AS length FROM m GROUP BY conv_id),
g0 AS (
  SELECT path, depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM m JOIN e ON m.conv_id = e.conv_id GROUP BY path, depth
),
up AS (SELECT *, CASE WHEN depth > 0 THEN path[1 : depth - 1] END AS above FROM g0),
kids AS (SELECT above, count(*) AS n FROM up WHERE depth > 0 GROUP BY above),
g AS (SELECT up.*, coalesce(kids.n, 0) AS n_children FROM up LEFT JOIN kids ON kids.above = up.path),
s AS (
  SELECT x.path, sum((g.n_convs - 1) * g.bytes) AS saved, count(*) FILTER (g.n_children = 0) AS leaves
  FROM g JOIN m AS x ON x.conv_id = g.conv_id AND x.depth <= g.depth GROUP BY x.path
)
SELECT g.conv_id, g.depth, p.conv_id AS parent_conv_id, g.n_convs, g.n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, g.ends_sha256
FROM g JOIN s ON s.path = g.path LEFT JOIN g AS p ON g.depth > 0 AND p.path = g.above
"""
