"""Registered queries of the operators, one ``opN_<name>`` each, over their whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import decontaminate, exact, hyperminhash, licenses, packing, pages, quality, repair, secrets, substring, suffix, topk, trie
from cartwheel.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_digest(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_groups(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_digest(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damage_and_repair(table(spark, sf_dir, "conversations"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.mixed_trie(table(spark, sf_dir, "conversations")).drop("n_nodes")


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


_ALL = (
    op1_substring_dedup, op2_packing, op3_exact_dedup, op4_html_text, op5_decontamination, op6_near_dedup, op7_quality,
    op8_suffix_dedup, op9_licenses, op10_secrets, op11_structure_repair, op12_prefix_trie, op13_exact_topk,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

ORACLE_SQL: dict[str, str] = {}

#: Every window of 35 words, counted over the corpus; a word goes when any repeated window covers it.
ORACLE_SQL["op1_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
h AS (SELECT r, i, md5(array_to_string(w[i:i+34], ' ')) AS win
      FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT win FROM h GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + o AS pos FROM h JOIN rep USING (win), (SELECT unnest(range(35)) AS o)),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d) ANTI JOIN gone USING (r, pos)
  GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

ORACLE_SQL["op3_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS c, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY c DESC, doc_id)
"""

#: Windows of items as strings, joined with the documents' windows of the same number of words.
ORACLE_SQL["op5_decontamination"] = r"""
WITH t AS (
  SELECT 'd' AS kind, CAST(row_number() OVER () AS BIGINT) AS r, CAST(doc_id AS VARCHAR) AS id, text FROM documents
  UNION ALL SELECT 'b', -1, CAST(item_id AS VARCHAR), text FROM benchmark),
w AS (SELECT kind, r, id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM t),
win AS (SELECT DISTINCT id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
        FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM w WHERE kind = 'b' AND len(w) > 0)),
size AS (SELECT DISTINCT k FROM win),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, size WHERE kind = 'd' AND len(w) >= k)),
hit AS (SELECT r, k, i, id FROM dw JOIN win USING (k, s)),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, id FROM hit) GROUP BY r)
SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit,
       coalesce(items.n, 0) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN words USING (r) LEFT JOIN items USING (r) WHERE w.kind = 'd'
"""

#: CRC-32 as a fold over bytes; ``t`` is the table of its polynomial.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, b: xor(a >> 1, 3988292384 * (a & 1)), CAST(i AS BIGINT))) AS t)"""


def _crc(text: str) -> str:
    code = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(4294967295, list_reduce({code}, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), CAST(4294967295 AS BIGINT)))"


def _and(path: str, cost: str, letter: str) -> str:
    """The path with one more letter; a path is its cost in nine digits and its letters, so the least string is the best."""
    return f"(lpad(CAST(CAST({path}[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {path}[10:] || '{letter}')"


def _fold_row() -> str:
    """Paths (e: nothing yet, s: system, u: user, a: assistant) over inserts and one row (i: initial, x: must go, t: truncated)."""
    up = f"least(p.u, {_and('p.e', '2', 'I')}, {_and('p.s', '2', 'I')}, {_and('p.a', '2', 'I')})"
    filled = f"list_transform([{{'e': p.e, 's': p.s, 'a': p.a, 'u': {up}, 'r': r}}], lambda q: {{'e': q.e, 's': q.s, 'u': q.u, 'a': least(q.a, {_and('q.u', '2', 'I')}), 'r': q.r}})[1]"
    keep = lambda path, i: f"CASE WHEN NOT q.r.x AND q.r.i = '{i}' THEN {_and(path, 'q.r.t', 'K')} END"
    role = lambda path: f"CASE WHEN NOT q.r.x THEN {_and(path, '2 + q.r.t', 'R')} END"
    before = ("q.e", "q.s", "q.a")
    user = ", ".join([*(keep(b, "u") for b in before), *(role(b) for b in before)])
    return (f"list_transform([{filled}], lambda q: {{'e': {_and('q.e', '3', 'D')}, 's': least({_and('q.s', '3', 'D')}, {keep('q.e', 's')}), "
            f"'u': least({_and('q.u', '3', 'D')}, {user}), 'a': least({_and('q.a', '3', 'D')}, {keep('q.u', 'a')}, {role('q.u')}), 'r': r}})[1]")


#: The cheapest edits as a fold over the rows of a conversation, least strings in place of weights; then the edits applied.
ORACLE_SQL["op11_structure_repair"] = f"""
WITH {_CRC_TABLE},
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations, crc_table),
g AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM d WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM g),
f AS (SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before,
             CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM o),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
             count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
             count_if(before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
             list({{'i': i, 'x': fault IN ('blank', 'duplicate'), 't': CAST(fault = 'truncated' AS BIGINT)}} ORDER BY place) AS rows FROM f GROUP BY conv_id),
z AS (SELECT {{'e': '000000000', 's': CAST(NULL AS VARCHAR), 'u': CAST(NULL AS VARCHAR), 'a': CAST(NULL AS VARCHAR), 'r': {{'i': '', 'x': false, 't': CAST(0 AS BIGINT)}}}} AS start),
p AS (SELECT c.*, list_reduce(list_transform(rows, lambda r: {{'e': CAST(NULL AS VARCHAR), 's': CAST(NULL AS VARCHAR), 'u': CAST(NULL AS VARCHAR), 'a': CAST(NULL AS VARCHAR), 'r': r}}),
             lambda p, w: list_transform([w.r], lambda r: {_fold_row()})[1], start) AS p FROM c, z),
b AS (SELECT * EXCLUDE (p, rows), least(p.e, p.a, {_and('p.u', '2', 'I')}, {_and(_and('p.s', '2', 'I'), '2', 'I')}) AS best FROM p),
l AS (SELECT conv_id, unnest(string_split(best[10:], '')) AS letter, generate_subscripts(string_split(best[10:], ''), 1) AS nr FROM b WHERE length(best) > 9),
n AS (SELECT *, CASE WHEN letter <> 'I' THEN count(*) FILTER (WHERE letter <> 'I') OVER (PARTITION BY conv_id ORDER BY nr) END AS place FROM l),
k AS (SELECT n.conv_id, nr, letter, role, coalesce(text, '') AS text, row_number() OVER w AS nth, first_value(letter = 'K' AND role LIKE 's%') OVER w AS led
      FROM n LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM n.conv_id AND o.place = n.place WHERE letter <> 'D' WINDOW w AS (PARTITION BY n.conv_id ORDER BY nr)),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (nth - CAST(coalesce(led, false) AS BIGINT)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY nr)) AS sha
      FROM k GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(CAST(best[1:9] AS BIGINT), 0) AS cost, coalesce(best[10:], '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM e.conv_id
"""

#: Whole prefixes as strings; every node adds its leaf and its savings to all of its prefixes.
ORACLE_SQL["op12_prefix_trie"] = f"""
WITH {_CRC_TABLE},
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place, role, text
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM r), crc_table),
b AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM c JOIN r ON r.conv_id = c.base AND place < h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM c JOIN r ON r.conv_id = c.conv_id AND place >= h),
s AS (SELECT conv_id, row_number() OVER w AS depth, length(text) AS n,
             sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS k
      FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
m AS (SELECT conv_id, 0 AS depth, '' AS k, 0 AS n FROM c UNION ALL SELECT conv_id, depth, k, n FROM s),
e AS (SELECT conv_id, depth, k, depth = max(depth) OVER (PARTITION BY conv_id) AS ends, lag(k) OVER (PARTITION BY conv_id ORDER BY depth) AS pk, n FROM m),
node AS (SELECT depth, k, min(conv_id) AS conv_id, min(pk) AS pk, count(*) AS n_convs, (count(*) - 1) * min(n) AS saved,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
         FROM e GROUP BY depth, k),
kids AS (SELECT depth - 1 AS depth, pk AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1, 2),
flat AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (depth, k)),
sub AS (SELECT e.depth, e.k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved
        FROM flat JOIN e ON e.conv_id = flat.conv_id AND e.depth <= flat.depth GROUP BY e.depth, e.k)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       CAST(sub.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM flat f JOIN sub USING (depth, k) LEFT JOIN node p ON p.depth = f.depth - 1 AND p.k = f.pk
"""

#: The stated queries against all other rows, scored in whole numbers.
ORACLE_SQL["op13_exact_topk"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, c.r, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST, r) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 10
"""
