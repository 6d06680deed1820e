"""Independent SQL (DuckDB dialect) for every registered query.

The SQL recomputes each answer from the driver tables with plain SQL
constructs; column names match the Spark results exactly.
"""

from __future__ import annotations

# Text lines of every document; a final line break opens no extra line.
_DOC_LINES = r"""
doc_lines AS (
  SELECT doc_id, unnest(regexp_split_to_array(
           regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')) AS line
  FROM documents
)"""

# Blank-split tokens with trailing empty tokens dropped.
_DOC_WORDS = _DOC_LINES + r""",
doc_words AS (
  SELECT doc_id, unnest(CASE WHEN line = '' THEN ['']
                             WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
                             ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM doc_lines
)"""

_WORD_COUNT = "WITH " + _DOC_WORDS + """
SELECT word, count(*) AS cnt FROM doc_words GROUP BY word"""

_SUBJECTS = r"""
parsed AS (
  SELECT url, string_split(url, '/')[-1] AS teacher FROM pages
),
sc AS (
  SELECT regexp_extract(left(url, greatest(length(url) - length(teacher) - 1, 0)),
                        '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:.]*)', 1) AS subject,
         teacher
  FROM parsed
),
counts AS (
  SELECT subject, teacher, count(*) AS cnt FROM sc GROUP BY subject, teacher
)"""

_LOG = """
recs AS (
  SELECT 'u' || CAST(user_id % 40 AS VARCHAR) AS word, event_type AS status,
         CAST(floor(value) AS INTEGER) AS size
  FROM events
),
wc AS (SELECT word, count(*) AS cnt FROM recs GROUP BY word)"""

_IPS = """
ipn AS (
  SELECT concat_ws('.', o_custkey % 200 + 1, o_orderkey % 256, 0, 7) AS ip,
         ((o_custkey % 200 + 1) << 24) | ((o_orderkey % 256) << 16) | 7 AS n,
         o_orderstatus AS item, o_totalprice AS price
  FROM orders
),
rules AS (
  SELECT (CAST(n_nationkey AS BIGINT) * 8 + 1) << 24 AS lo,
         ((CAST(n_nationkey AS BIGINT) * 8 + 7) << 24) - 1 AS hi,
         n_name AS province
  FROM nation
),
regional AS (
  SELECT ip, n, item, price, coalesce(province, '未知') AS province
  FROM ipn LEFT JOIN rules ON n BETWEEN lo AND hi
)"""

_TOP_GROUP = """
SELECT subject, teacher, cnt, rn FROM (
  SELECT subject, teacher, cnt,
         CAST(row_number() OVER (PARTITION BY subject ORDER BY cnt DESC, teacher ASC) AS BIGINT) AS rn
  FROM counts {where}
) WHERE rn <= 3"""

_ORDER_TOTALS = "WITH " + _IPS + """
SELECT 'total' AS metric, 'TOTAL_INCOME' AS key, round(sum(price), 2) AS amount FROM ipn
UNION ALL
SELECT 'item' AS metric, item AS key, round(sum(price), 2) AS amount FROM ipn GROUP BY item
UNION ALL
SELECT 'province' AS metric, province AS key, round(sum(price), 2) AS amount FROM regional GROUP BY province"""

_HASH_LINES = """
hl AS (
  SELECT concat_ws('#', event_id, '-', user_id, 'u' || CAST(user_id % 40 AS VARCHAR), event_type,
                   CAST(floor(value) AS BIGINT)) AS line
  FROM events
)"""

# GB18030 takes one byte for ASCII, two for the letters listed here, four for the
# other letters of the texts.
_TWO_BYTES = "éóèüêíáàìòúù"
_GB18030 = f"""
SELECT doc_id, text,
       length(text) + length(regexp_replace(text, '[^{_TWO_BYTES}]', '', 'g'))
         + 3 * length(regexp_replace(text, '[\\x00-\\x7F{_TWO_BYTES}]', '', 'g')) AS bytes
FROM documents"""

# Order messages: sparse partitions, offsets rising over the drops.
_ORDER_LOG = """
msgs AS (
  SELECT o_orderkey % {rounds} AS drop_no,
         CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 3 ELSE 7 END AS partition,
         o_orderkey % {rounds} * CAST(1000000000000 AS BIGINT) + o_orderkey AS pos, o_totalprice AS price
  FROM orders
)"""

_USER_ORDER = """
SELECT name, age, fv,
       CAST(row_number() OVER (ORDER BY fv DESC, age ASC, name ASC) AS BIGINT) AS pos,
       printf('name: %s, age: %d, fv: %d', name, age, fv) AS rendered
FROM (SELECT c_name AS name, c_nationkey AS age, CAST(floor(c_acctbal) AS INTEGER) AS fv FROM customer)"""

ORACLE_SQL: dict[str, str] = {
    "word_count": _WORD_COUNT,
    "word_count_top": _WORD_COUNT + "\nORDER BY cnt DESC, word ASC LIMIT 100",
    "hash_token_count": "WITH " + _HASH_LINES + """
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(CASE WHEN line = '' THEN ['']
                     WHEN rtrim(line, '#') = '' THEN []::VARCHAR[]
                     ELSE string_split(rtrim(line, '#'), '#') END) AS word
  FROM hl
) GROUP BY word""",
    "word_count_lines": "SELECT '(' || word || ',' || CAST(cnt AS VARCHAR) || ')' AS line FROM ("
    + _WORD_COUNT + ")",
    "text_sink_roundtrip": _WORD_COUNT,
    "text_sink_order": "SELECT row_number() OVER (ORDER BY cnt DESC, word) AS pos, word, cnt FROM ("
    + _WORD_COUNT + ")",
    "decode_messages": "SELECT doc_id, text FROM documents",
    "decode_messages_gb18030": _GB18030,
    "decode_lines": _WORD_COUNT,
    "url_segment_count": """
SELECT string_split(url, '/')[-1] AS teacher, count(*) AS cnt FROM pages GROUP BY 1""",
    "url_pair_count": "WITH " + _SUBJECTS + "\nSELECT subject, teacher, cnt FROM counts",
    "topn_per_group": "WITH " + _SUBJECTS + _TOP_GROUP.format(where=""),
    "topn_per_group_colocated": "WITH " + _SUBJECTS + _TOP_GROUP.format(where=""),
    "topn_listed_groups": "WITH " + _SUBJECTS
    + _TOP_GROUP.format(where="WHERE subject IN ('blog', 'www', 'm')"),
    "topn_group_partitions": "WITH " + _SUBJECTS + _TOP_GROUP.format(where=""),
    "topn_partition_function": "WITH " + _SUBJECTS + _TOP_GROUP.format(where=""),
    "distinct_groups": "WITH " + _SUBJECTS + "\nSELECT DISTINCT subject FROM sc",
    "multi_key_sort": _USER_ORDER,
    "multi_key_sort_ranges": _USER_ORDER,
    "log_status_count": "WITH " + _LOG + "\nSELECT status, count(*) AS cnt FROM recs GROUP BY status",
    "log_size_stats": "WITH " + _LOG + """
SELECT max_value, min_value,
       printf('%d.%02d', r // 100, r % 100) AS avg_value
FROM (
  SELECT max(size) AS max_value, min(size) AS min_value,
         (200 * sum(size) + count(size)) // (2 * count(size)) AS r
  FROM recs
)""",
    "log_size_range": "WITH " + _LOG + "\nSELECT max(size) AS max_value, min(size) AS min_value FROM recs",
    "combine_by_key": "WITH " + _LOG
    + "\nSELECT word, CAST(sum(size) AS BIGINT) AS total, count(*) AS n FROM recs GROUP BY word",
    "combine_by_key_placed": """
SELECT CAST(l_partkey AS BIGINT) AS part, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
       count(*) AS lines, max(l_extendedprice) AS dearest
FROM lineitem GROUP BY 1""",
    "id_range_read": """
WITH b AS (SELECT max(event_id) // 4 AS lo, max(event_id) // 4 * 3 AS hi FROM events),
r AS (SELECT k, lo + k * (hi - lo + 1) // 8 AS s, lo + (k + 1) * (hi - lo + 1) // 8 - 1 AS e
      FROM b, (SELECT unnest(range(8)) AS k))
SELECT event_id, user_id, event_type, CAST(k AS INTEGER) AS range_no
FROM events JOIN r ON event_id BETWEEN s AND e""",
    "joined_words": "WITH " + _LOG + """
SELECT cnt, string_agg(word, '' ORDER BY word) AS words FROM wc
WHERE cnt IN (SELECT DISTINCT cnt FROM wc ORDER BY cnt DESC LIMIT 5)
GROUP BY cnt""",
    "log_word_count": "WITH " + _LOG + "\nSELECT word, cnt FROM wc",
    "topn_distinct_counts": "WITH " + _LOG + """
SELECT cnt, max(word) AS word FROM wc GROUP BY cnt ORDER BY cnt DESC LIMIT 5""",
    "topn_counts_all_words": "WITH " + _LOG + """,
top AS (SELECT DISTINCT cnt FROM wc ORDER BY cnt DESC LIMIT 5),
sel AS (
  SELECT wc.cnt, wc.word, row_number() OVER (PARTITION BY wc.cnt ORDER BY wc.word) AS position
  FROM wc JOIN top ON wc.cnt = top.cnt
)
SELECT cnt, position, word FROM sel""",
    "ip_to_long": "WITH " + _IPS + "\nSELECT ip, n FROM ipn",
    "ip_to_long_odd": """
SELECT o_orderkey, concat_ws('.', o_custkey % 200 + 1, o_orderkey % 256, o_orderkey % 400) AS ip,
       ((((o_custkey % 200 + 1) << 8) | (o_orderkey % 256)) << 8) | (o_orderkey % 400) AS n
FROM orders""",
    "ip_region_lookup_multilevel": """
WITH rules AS (
  SELECT (CAST(n_nationkey AS BIGINT) * 8 + 1) << 24 AS lo,
         ((CAST(n_nationkey AS BIGINT) * 8 + 7) << 24) - 1 AS hi, n_name AS province FROM nation
  UNION ALL
  SELECT ((CAST(c_nationkey AS BIGINT) * 8 + 7) << 24) + c_custkey * 64,
         ((CAST(c_nationkey AS BIGINT) * 8 + 7) << 24) + c_custkey * 64 + 63, c_name FROM customer
  UNION ALL
  SELECT CAST(250 AS BIGINT) << 24, CAST(1 AS BIGINT) << 40, 'rest'
), facts AS (
  SELECT o_orderkey, (CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 25 * 8 + 7
                           ELSE o_orderkey % 260 END AS BIGINT) << 24) + o_custkey * 64 + o_orderkey % 100 AS n
  FROM orders
)
SELECT o_orderkey, n, coalesce(province, '未知') AS province
FROM facts LEFT JOIN rules ON n BETWEEN lo AND hi""",
    "ip_region_lookup": "WITH " + _IPS + "\nSELECT ip, n, province FROM regional",
    "ip_region_lookup_broadcast": "WITH " + _IPS + "\nSELECT ip, n, province FROM regional",
    "income_total": "SELECT round(sum(o_totalprice), 2) AS total_income FROM orders",
    "income_by_item": """
SELECT o_orderstatus AS item, round(sum(o_totalprice), 2) AS income FROM orders GROUP BY 1""",
    "income_by_region": "WITH " + _IPS + """
SELECT province, round(sum(price), 2) AS income FROM regional GROUP BY province""",
    "stream_batch_counts": "WITH " + _DOC_WORDS + """
SELECT CAST(doc_id % 4 AS BIGINT) AS batch_id, word, count(*) AS cnt
FROM doc_words GROUP BY 1, 2""",
    "stream_running_counts": _WORD_COUNT,
    "stream_state_update": _WORD_COUNT,
    "stream_state_dump": _WORD_COUNT,
    "stream_offsets": "WITH " + _ORDER_LOG.format(rounds=4) + """
SELECT CAST(drop_no AS BIGINT) AS batch_id, partition, min(pos) AS from_offset, max(pos) + 1 AS until_offset
FROM msgs GROUP BY 1, 2""",
    "stream_from_offsets": "WITH " + _ORDER_LOG.format(rounds=1) + """,
top AS (SELECT max(pos) AS top FROM msgs)
SELECT partition, min(pos) AS first_offset, count(*) AS cnt, round(sum(price), 2) AS total
FROM msgs, top
WHERE pos >= CASE partition WHEN 3 THEN top // 2 WHEN 7 THEN top - top // 10 ELSE 0 END
GROUP BY partition""",
    "stream_partition_writer": """
SELECT CAST(event_id % 4 AS BIGINT) AS epoch, event_id, event_type FROM events""",
    "stream_order_totals": _ORDER_TOTALS,
    "stream_resume": _ORDER_TOTALS,
}
