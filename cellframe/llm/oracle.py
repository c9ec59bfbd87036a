"""The queries of this package that SQL can express, for DuckDB."""

from __future__ import annotations

from cellframe.llm.common import WORD
from cellframe.llm.lexical import TERM

SQL: dict[str, str] = {}

# Shares by weight under caps, as in `mixing.fill`.
_FILLED = """
  SELECT *, total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER g AS rest_total,
         sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER g AS rest_weight
  FROM (SELECT *, (total - before_cap) * weight
                  >= cap * (sum(weight) OVER () - before_weight) AS is_full
        FROM (SELECT *,
                coalesce(sum(cap) OVER b, 0) AS before_cap,
                coalesce(sum(weight) OVER b, 0) AS before_weight
              FROM {entries}
              WINDOW b AS (ORDER BY cap / weight, entry
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
  WINDOW g AS ()
"""


def mixing_sql(documents: str = "documents") -> str:
    """`mix_plan` with its default parameters: every quotient is listed and ranked."""
    return f"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         'mix-1:' || coalesce(doc_id::VARCHAR, '') AS k
  FROM {documents}),
s0 AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs,
         row_number() OVER (ORDER BY source NULLS LAST) AS entry
  FROM d GROUP BY source),
s1 AS (
  SELECT *, ([3, 1, 2])[((entry - 1) % 3 + 1)::INT] AS weight, 200 * source_size AS cap,
         150 * sum(source_size) OVER () AS total, ceil(docs / 2000)::BIGINT AS shards
  FROM s0),
s AS (
  SELECT *, CASE WHEN is_full THEN cap / 100
                 ELSE (weight * rest_total)::DOUBLE / (100 * rest_weight)::DOUBLE END AS target
  FROM ({_FILLED.format(entries="s1")})),
p AS (
  SELECT d.doc_id, d.size, s.entry, s.source_size, s.target, md5(d.k) AS place,
         ('0x' || substr(md5(d.k), 1, 8))::BIGINT % s.shards AS shard
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
h AS (
  SELECT entry, shard, sum(size)::BIGINT AS shard_size,
         (2 * sum(size) + 31)::BIGINT // 32 AS cap
  FROM p WHERE size > 0 GROUP BY entry, shard),
q AS (
  SELECT entry, count(*) AS seats
  FROM (SELECT entry, row_number() OVER (ORDER BY (2 * k - 1) / weight, entry) AS place, seats
        FROM (SELECT entry, weight, unnest(range(1, c.cap + 1)) AS k,
                     ((rest_total + 1600) // 3200)::BIGINT AS seats
              FROM s JOIN (SELECT entry, sum(cap)::BIGINT AS cap
                           FROM h GROUP BY entry) c USING (entry)
              WHERE NOT is_full))
  WHERE place <= seats GROUP BY entry),
r AS (
  SELECT entry, shard, count(*) AS quota
  FROM (SELECT entry, shard, seats, row_number() OVER (
                 PARTITION BY entry ORDER BY (2 * k - 1) / shard_size, shard) AS place
        FROM (SELECT h.*, q.seats, unnest(range(1, h.cap + 1)) AS k
              FROM h JOIN q USING (entry)))
  WHERE place <= seats GROUP BY entry, shard),
t AS (
  SELECT entry, shard, shard_size, words // shard_size AS rounds, words % shard_size AS run,
         ('0x' || substr(md5('mix-1:' || shard || ':' || entry), 1, 8))::BIGINT
           % ceil(shard_size / 32)::BIGINT * 32 AS from_word
  FROM (SELECT h.*, CASE WHEN is_full THEN 2 * shard_size
                         ELSE least(coalesce(quota, 0) * 32, 2 * shard_size) END AS words
        FROM h JOIN s USING (entry) LEFT JOIN r USING (entry, shard)))
SELECT doc_id, size, source_size, target,
       (CASE WHEN size = 0 THEN 0 ELSE rounds * size
         + greatest(0, least("end", from_word + run) - greatest("end" - size, from_word))
         + greatest(0, least("end", from_word + run - shard_size) - ("end" - size))
         END)::BIGINT AS taken
FROM (SELECT *, sum(size) OVER (PARTITION BY entry, shard ORDER BY place, doc_id, size
                                ROWS UNBOUNDED PRECEDING) AS "end" FROM p) p
LEFT JOIN t USING (entry, shard)
"""


SQL["op5_mixing"] = mixing_sql()


def line_rules_sql(documents: str = "documents") -> str:
    """`judge` with its default limits, on the lines themselves."""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
  FROM {documents}),
win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n
  FROM (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
rep AS (
  SELECT rid, count(DISTINCT i + o) AS n_repeat_words
  FROM win, (SELECT unnest([0, 1, 2]) AS o) WHERE n > 1 GROUP BY rid),
line AS (
  SELECT rid, doc_id, host, t, line, len(regexp_extract_all(line, '{WORD}')) AS lw,
         lower(array_to_string(regexp_extract_all(line, '{WORD}'), ' ')) AS norm
  FROM (SELECT rid, doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{WORD}')),
dup AS (
  SELECT rid, sum(n - 1) AS n_dup_lines
  FROM (SELECT rid, line, count(*) AS n FROM line GROUP BY rid, line) GROUP BY rid),
texts AS (SELECT host, count(DISTINCT t) AS texts FROM line GROUP BY host),
freq AS (
  SELECT f.host, norm, first_text
  FROM (SELECT host, norm, count(DISTINCT t) AS docs, arg_min(t, doc_id) AS first_text
        FROM line GROUP BY host, norm) f
  JOIN texts ON texts.host IS NOT DISTINCT FROM f.host
  WHERE docs > 20 AND docs > texts * 0.01),
gone AS (
  SELECT rid, sum(lw) AS removed
  FROM line JOIN freq f ON f.host IS NOT DISTINCT FROM line.host AND f.norm = line.norm
  WHERE t <> first_text GROUP BY rid)
FROM (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         (length(t) - length(regexp_replace(t, '{WORD}', '', 'g')))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed,
         (len(w) - coalesce(removed, 0))::BIGINT AS n_kept_words
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN gone USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_kept_words >= n_words * 0.5 AS kept, n_kept_words
"""


SQL["op4_line_rules"] = line_rules_sql()


def lexical_sql(documents: str = "documents", items: str = "benchmark", top: int = 50) -> str:
    """`search` by scoring every document that holds a term of the item."""
    small = (
        "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    terms = f"regexp_extract_all({small}, '{TERM}')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {terms} AS terms FROM {documents}),
s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
p AS (
  SELECT row, doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  GROUP BY row, doc_id, term),
w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM p, s GROUP BY term, n_docs),
i AS (
  SELECT item, item_id, unnest(list_distinct(terms)) AS term
  FROM (SELECT row_number() OVER () AS item, item_id, {terms} AS terms FROM {items})),
r AS (
  SELECT item, item_id, row, doc_id,
         sum(w * ((1000000000 * tf)
                  // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (
               PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM r WHERE score > 0)
WHERE rank <= {top}
"""


SQL["op11_lexical_search"] = lexical_sql()


def crc32_sql(octets: str) -> str:
    """CRC-32 of a list of bytes, bit by bit."""
    return f"""xor(4294967295::BIGINT, list_reduce(
      list_prepend(4294967295::BIGINT, {octets}),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                               lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


def octets_sql(text: str) -> str:
    """The bytes of a text as a list of numbers."""
    return f"""list_transform(regexp_extract_all(hex(encode({text})), '..'),
                              lambda x: ('0x' || x)::BIGINT)"""


def prefix_trie_sql(conversations: str = "conversations") -> str:
    """`prefix_trie` by grouping every prefix; what a subtree adds up to is counted
    on the members that own its nodes, the smallest ones."""
    return f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            sha256(coalesce(text, ''))) AS i
  FROM {conversations} WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         {crc32_sql(octets_sql("conv_id::VARCHAR"))} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, t.i, role, text FROM c JOIN t ON t.conv_id = c.base WHERE t.i <= h
  UNION ALL
  SELECT c.conv_id, t.i, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.i > h),
m AS (
  SELECT conv_id, row_number() OVER o AS depth, list({{'role': role, 'text': text}}) OVER o AS path,
         len(regexp_extract_all(text, '{WORD}')) AS words
  FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY i)
  UNION ALL
  SELECT conv_id, 0, [], 0 FROM c),
n AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         (count(*) - 1) * any_value(words) AS cost
  FROM m GROUP BY depth, path),
e AS (
  SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max_by(path, depth) AS path FROM m GROUP BY conv_id) GROUP BY path),
u AS (SELECT depth - 1 AS depth, path[:-2] AS path, count(*) AS n_children
      FROM n WHERE depth > 0 GROUP BY ALL),
k AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN u USING (depth, path)),
s AS (
  SELECT a.depth, a.path, sum(cost) AS saved, sum((n_children = 0)::INT) AS leaves
  FROM k JOIN m a USING (conv_id) WHERE a.depth <= k.depth GROUP BY a.depth, a.path)
SELECT k.conv_id, k.depth::BIGINT AS depth, up.conv_id AS parent_conv_id,
       k.n_convs::BIGINT AS n_convs, k.n_children::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM k JOIN s USING (depth, path) LEFT JOIN e ON e.path = k.path
LEFT JOIN n up ON up.depth = k.depth - 1 AND up.path = k.path[:-2]
"""


SQL["op12_prefix_trie"] = prefix_trie_sql()


def sharding_sql(documents: str = "documents", shards: int = 24, seed: str = "shards-1") -> str:
    """`shard_plan` with whole windows."""
    hash32 = "('0x' || substr({}, 1, 8))::BIGINT"
    phase = hash32.format(f"md5('{seed}:' || source)")
    return f"""
WITH d AS (
  SELECT doc_id, coalesce('+' || source, '-') AS source,
         (octet_length(encode(coalesce(text, ''))) + 8)::BIGINT AS size,
         coalesce({crc32_sql(octets_sql("text"))}, 0) AS text_crc32
  FROM {documents}),
w AS (
  SELECT *, md5(coalesce('+' || doc_id::VARCHAR, '-') || ':' || size || ':' || text_crc32 || ':'
                || source) AS who FROM d),
k AS (
  SELECT *, md5('{seed}:' || who || ':'
                || (row_number() OVER (PARTITION BY who) - 1)) AS place FROM w),
f AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY place) - 1
             + ({phase} + 0.5::DOUBLE) / 4294967296::DOUBLE)
            / count(*) OVER (PARTITION BY source) AS "at"
  FROM k),
r AS (SELECT *, row_number() OVER (ORDER BY "at", place) - 1 AS rank, count(*) OVER () AS n FROM f),
s AS (SELECT *, (rank * {shards} // n)::INTEGER AS shard FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard,
       (rank - (shard * n + {shards - 1}) // {shards})::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM s
"""


SQL["op13_sharding"] = sharding_sql()


# Smallest id that each node of `edges` (a, b, both ways) reaches, as `reached`.
_REACHED = """
reach AS (
  SELECT a, b FROM edges
  UNION
  SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
reached AS (SELECT a AS id, least(a, min(b)) AS component FROM reach GROUP BY a)
"""


def embedding_sql(embeddings: str = "embeddings", cosine: float = 0.95) -> str:
    """`near_duplicates` by comparing all pairs; ids are distinct."""
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM {embeddings}
  WHERE len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
n AS (
  SELECT * FROM (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v) WHERE norm > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id < b.vec_id
  WHERE len(a.e) = len(b.e)
    AND list_dot_product(a.e, CASE WHEN len(a.e) = len(b.e) THEN b.e ELSE a.e END)
        / (a.norm * b.norm) >= {cosine}),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
{_REACHED},
links AS (SELECT a AS id, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, coalesce(links.n, 0)::BIGINT AS n_links,
       coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM {embeddings} LEFT JOIN reached ON reached.id = vec_id LEFT JOIN links ON links.id = vec_id
"""


def substring_sql(documents: str = "documents", width: int = 13) -> str:
    """`substring_dedup` on every window's words; ids are distinct."""
    return f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM {documents}),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + {width - 1}], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {width - 2})) AS i FROM d)),
firsts AS (SELECT words, min(doc_id) AS earliest FROM win GROUP BY words HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win JOIN firsts USING (words) WHERE earliest < doc_id),
gone AS (
  SELECT DISTINCT doc_id, i + o AS i FROM hit, (SELECT unnest(range(0, {width})) AS o)),
word AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def jaccard_sql(documents: str = "documents", width: int = 5, percent: int = 75) -> str:
    """`jaccard_components` by counting the shingles of all pairs that share one; ids
    are distinct."""
    small = (
        "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({small}, '{WORD}') AS w FROM {documents}),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {width - 1}], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width - 2}, least(len(w), 1) + 1))) AS i
        FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
pairs AS (
  SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * common >= {percent} * (p.n + q.n - common)),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
{_REACHED}
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce(component, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reached ON reached.id = d.doc_id
"""


SQL["op3_embedding_join"] = embedding_sql()
SQL["op7_substring_dedup"] = substring_sql()
SQL["op8_ngram_join"] = jaccard_sql()
