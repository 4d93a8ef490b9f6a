"""The registered queries of the training-data operators and their SQL.

Each query applies one operator, with production parameters, to its whole table
and derives the columns of its contract.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.common import id_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.mixing import mix_sources
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL["op5_source_mix"] = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':0'), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM docs GROUP BY source),
-- The level at which weight * level, held at twice the size, sums to the goal: tried at every source's own brim.
brim AS (
  SELECT a.source, any_value(2.0 * a.source_size / a.w) AS full_at,
         (1.5 * sum(b.source_size) - coalesce(sum(2 * b.source_size) FILTER (WHERE 2.0 * b.source_size / b.w < 2.0 * a.source_size / a.w), 0))
           / sum(b.w) FILTER (WHERE 2.0 * b.source_size / b.w >= 2.0 * a.source_size / a.w) AS level
  FROM src a CROSS JOIN src b GROUP BY a.source),
goal AS (SELECT min_by(level, full_at) AS level FROM brim WHERE level <= full_at),
target AS (
  SELECT source, source_size, source_size / n_docs AS mean_size,
         least(2.0 * source_size, coalesce(level * w, 2.0 * source_size))::DOUBLE AS target
  FROM src, goal),
split AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS certain,
         target - certain * source_size AS rest,
         CASE WHEN source_size > 0 THEN rest / source_size ELSE 0.0 END AS part
  FROM target),
ranked AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, s.certain, s.rest,
         sum(d.size) OVER (PARTITION BY s.source ORDER BY
           d.u / (d.u + CASE WHEN mean_size > 0 THEN part / (1 - part) * d.size / mean_size ELSE 0.0 END * (1 - d.u)),
           d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) - d.size AS ahead
  FROM docs d JOIN split s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       (size * (certain + CASE WHEN rest > 0 AND ahead + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked
"""


@register
def op7_maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.maxscore import top_k
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLE_SQL["op7_maxscore_search"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum([coalesce(z[1] * z[2], 0) FOR z IN list_zip(q.vec, c.vec)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


@register
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.fingerprints import edited_pairs
    return edited_pairs(table(spark, sf_dir, "documents"))


@register
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), n=2, percent=80)


ORACLE_SQL["op3_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN list_filter([array_to_string(w, ' ')], lambda x: x <> '')
                               ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
"""


@register
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.substring_dedup import dedup_substrings
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs, n=35).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE_SQL["op9_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
windows AS (
  SELECT doc_id, i, w[i] AS word,
         CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS win FROM spots),
counted AS (
  SELECT doc_id, i, word, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS repeated FROM windows),
marked AS (
  SELECT doc_id, i, word, coalesce(bool_or(repeated) OVER (
           PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), false) AS gone
  FROM counted)
SELECT d.doc_id, count(m.i) AS n_words, count(m.i) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id
"""


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.language_id import fit, identify
    docs = table(spark, sf_dir, "documents")
    fold = F.coalesce(id_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    model = fit(docs, ~fold)
    found = identify(docs, model)
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@register
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.quality import fit, with_score
    docs = table(spark, sf_dir, "documents")
    fold = F.coalesce(id_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    model = fit(docs, table(spark, sf_dir, "labels"), "quality", ~fold)
    return (with_score(docs.select("doc_id", "text"), model)
            .select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")))


@register
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from stocktake.llm.bpe import read_ranks, tokenize
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tokenize(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, ids=False)


@register
def op6_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.lm_scores import backoff_scores
    return backoff_scores(table(spark, sf_dir, "documents"))


ORACLE_SQL["op6_backoff_scores"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM docs),
grams AS (
  SELECT doc_id, i, w, lag(w) OVER d AS v, lag(w, 2) OVER d AS u FROM words
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
others AS (
  SELECT doc_id, i, count(*) OVER () AS n,
         count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY doc_id, w) AS c1,
         CASE WHEN v IS NOT NULL THEN count(*) OVER (PARTITION BY v, w) - count(*) OVER (PARTITION BY doc_id, v, w) END AS c2,
         CASE WHEN u IS NOT NULL THEN count(*) OVER (PARTITION BY u, v, w)
                                      - count(*) OVER (PARTITION BY doc_id, u, v, w) END AS c3
  FROM grams),
scored AS (
  SELECT doc_id,
         CASE WHEN c3 > 0 THEN c3::DOUBLE / lag(c2) OVER d
              WHEN c2 > 0 THEN 0.4::DOUBLE * c2 / lag(c1) OVER d
              WHEN c1 > 0 THEN 0.16::DOUBLE * c1 / n ELSE 0.064::DOUBLE / n END AS score
  FROM others WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
summed AS (
  SELECT doc_id, count(*) AS n_words, sum(round(ln(score) * 1e6)::BIGINT)::BIGINT AS log_micro
  FROM scored GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(log_micro, 0) AS log_micro, log_micro / n_words / 1e6 AS mean_log
FROM documents d LEFT JOIN summed USING (doc_id)
"""


@register
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.licenses import scan_licenses
    return scan_licenses(table(spark, sf_dir, "documents"))



@register
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.prefix_trie import rebuilt, symbols, trie
    conv = F.col("conv_id")
    turns = symbols(table(spark, sf_dir, "conversations"))
    return trie(rebuilt(turns, conv - conv % 100, id_mod(conv, 6)))


#: The CRC-32 table, by its polynomial, and the CRC of a list of bytes.
CRC_TABLE = """SELECT [list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
          FOR i IN range(256)] AS t"""


def _crc(data: str) -> str:
    return f"xor(list_reduce({data}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295)"


ORACLE_SQL["op12_prefix_trie"] = f"""
WITH tab AS ({CRC_TABLE}),
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         {_crc("[ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own), tab),
""" + r"""
turns AS (
  SELECT i.conv_id, o.place, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.base AND o.place <= h
  UNION ALL SELECT o.conv_id, o.place, o.role, o.text FROM own o JOIN ids USING (conv_id) WHERE o.place > h),
seqs AS (
  SELECT i.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY place) FILTER (place IS NOT NULL), []) AS s
  FROM ids i LEFT JOIN turns t ON t.conv_id = i.conv_id GROUP BY i.conv_id),
steps AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS depth FROM seqs),
nodes AS (
  SELECT depth, s[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = depth), '')) AS ends_sha256
  FROM steps GROUP BY depth, s[1:depth]),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children, CASE WHEN n.depth > 0 THEN len(n.path[n.depth].text) ELSE 0 END AS chars
  FROM nodes n LEFT JOIN children c ON c.path = n.path),
subtrees AS (
  SELECT v.path[1:u.depth] AS path, sum((v.n_convs - 1) * v.chars) AS saved_tokens, count(*) FILTER (v.n_children = 0) AS n_leaves
  FROM counted v JOIN (SELECT DISTINCT depth FROM nodes) u ON u.depth <= v.depth GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees t ON t.path = n.path LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""


def _one_deleted(doc_id: str) -> Callable[[str], str]:
    """Deletes a letter of a run where the CRC of id and run says so."""
    begun = zlib.crc32(f"{doc_id}:".encode())

    def spoiled(run: str) -> str:
        h = zlib.crc32(run.encode(), begun)
        if h % 199:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]

    return spoiled


@register
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.spelling import spelling_variants, word_counts
    words = word_counts(table(spark, sf_dir, "documents"), min_letters=6, min_count=5, spoil=_one_deleted)
    return spelling_variants(words, ratio=5)


ORACLE_SQL["op13_spelling_variants"] = f"""
WITH RECURSIVE tab AS ({CRC_TABLE}),
""" + r"""
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
grouped AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE len(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, n, """ + _crc("flatten([CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END "
                            "FOR x IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')])") + r""" AS h
  FROM grouped, tab),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, len(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT word, rest FROM less WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM less WHERE rest IN (SELECT word FROM words)),
best AS (
  SELECT near.word, count(*) AS n_near, min({'n': -o.n, 'other': other}) AS best
  FROM near JOIN words o ON o.word = other GROUP BY near.word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 5 * w.n THEN best.other END AS form,
         CASE WHEN -best.n >= 5 * w.n THEN -best.n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.at AND e.form IS NULL
"""


@register
def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stocktake.llm.embedding_dedup import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


ORACLE_SQL["op11_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS vec, sqrt(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding])) AS norm
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_sum([z[1] * z[2] FOR z IN list_zip(a.vec, b.vec)]) >= 0.95::DOUBLE * a.norm * b.norm),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = e.vec_id
"""
