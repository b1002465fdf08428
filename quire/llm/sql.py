"""DuckDB SQL for the corpus queries that SQL can express."""

OP1 = r"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), spots AS (
  SELECT item_id, ws, least(len(ws), 10) AS k, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
  FROM items WHERE len(ws) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i : i + k - 1], ' ') AS g FROM spots
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), places AS (
  SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM windows)
), found AS (
  SELECT p.rid, p.i, p.k, w.item_id FROM (SELECT rid, i, k, array_to_string(ws[i : i + k - 1], ' ') AS g FROM places) p JOIN windows w ON p.k = w.k AND p.g = w.g
), hit AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM found) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (rid) LEFT JOIN named m USING (rid)
"""

OP5 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), grams AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM texts)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 3)) AS j FROM twice) GROUP BY rid
), m AS (
  SELECT t.rid, doc_id, coalesce(lang, chr(1)) AS lang, coalesce(source, chr(1)) AS source,
         CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM texts t LEFT JOIN covered c USING (rid)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         word_chars * 1000 // greatest(n_words, 1) AS length_v, (n_symbols + 1) * 1000 // (n_words + 1) AS symbols_v,
         (n_dup_lines + 1) * 1000 // (n_lines + 1) AS lines_v, (n_repeat_words + 6) * 1000 // (n_words + 6) AS repeats_v
  FROM m
), v AS (
  SELECT lang, source, 'length' AS measure, length_v AS v FROM b WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'symbols', symbols_v FROM b WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'lines', lines_v FROM b WHERE NOT base_failed
  UNION ALL SELECT lang, source, 'repeats', repeats_v FROM b WHERE NOT base_failed
), r AS (
  SELECT lang, source, measure, (v >> greatest(length(bin(v)) - 8, 0)) << greatest(length(bin(v)) - 8, 0) AS v FROM v
), whole AS (
  SELECT measure, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM r GROUP BY ALL
), langs AS (
  SELECT lang, measure, (docs * o.q1 + 50 * whole.q1) // (docs + 50) AS q1, (docs * o.q3 + 50 * whole.q3) // (docs + 50) AS q3
  FROM (SELECT lang, measure, count(*) AS docs, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM r GROUP BY ALL) o JOIN whole USING (measure)
), f AS (
  SELECT o.lang, source, measure, (docs * o.q1 + 50 * langs.q1) // (docs + 50) AS q1, (docs * o.q3 + 50 * langs.q3) // (docs + 50) AS q3
  FROM (SELECT lang, source, measure, count(*) AS docs, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM r GROUP BY ALL) o JOIN langs USING (lang, measure)
), h AS (
  SELECT lang, source,
         max(CASE WHEN measure = 'length' THEN q1 - 4 * (q3 - q1) END) AS length_low,
         max(CASE WHEN measure = 'length' THEN q3 + 4 * (q3 - q1) END) AS length_high,
         max(CASE WHEN measure = 'symbols' THEN q3 + 4 * (q3 - q1) END) AS symbols_high,
         max(CASE WHEN measure = 'lines' THEN q3 + 4 * (q3 - q1) END) AS lines_high,
         max(CASE WHEN measure = 'repeats' THEN q3 + 4 * (q3 - q1) END) AS repeats_high
  FROM f GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(length_v BETWEEN length_low AND length_high AND symbols_v <= symbols_high AND lines_v <= lines_high AND repeats_v <= repeats_high, false) AS kept
FROM b LEFT JOIN h ON b.lang = h.lang AND b.source = h.source
"""

OP2 = r"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id, url, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT rid, page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hex,
         row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST, rid) AS k,
         first_value(page_id) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST, rid) AS best
  FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN best END AS refers_to
FROM d
"""

SQL = {
    "op2_warc": OP2,
    "op5_quality_rules": OP5,
    "op1_decontaminate": OP1,
}
