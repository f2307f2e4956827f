"""DuckDB SQL of the operators that SQL can express."""

from strata.llm.licenses import TEMPLATES

OP10 = r"""
WITH d AS (
  SELECT doc_id, source, md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
named AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM per),
weighed AS (
  SELECT *, source_size * 3 AS cap, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM named),
ordered AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, place) AS rn FROM weighed),
levels AS (
  SELECT *, CAST(SUM(source_size) OVER () - (SUM(cap) OVER (ORDER BY rn) - cap) AS DOUBLE)
            / CAST(SUM(weight) OVER () - (SUM(weight) OVER (ORDER BY rn) - weight) AS DOUBLE) AS level
  FROM ordered),
level AS (
  SELECT MIN(rn) AS rn, MIN_BY(level, rn) AS level FROM levels WHERE level * weight < cap),
targets AS (
  SELECT l.source, l.source_size,
         CAST(CASE WHEN l.rn >= level.rn THEN level.level * l.weight ELSE l.cap END AS DOUBLE) AS target
  FROM levels l LEFT JOIN level ON TRUE),
placed AS (
  SELECT d.*, t.source_size, t.target, CAST(FLOOR(t.target) AS BIGINT) AS budget,
         CAST(COALESCE(SUM(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + GREATEST(0, LEAST(size, budget - epochs * source_size - before)) AS BIGINT) AS taken, source
FROM cut"""



def _op6() -> str:
    values = ", ".join("({}, '{}', '{}')".format(n, name, text.replace("'", "''")) for n, (name, text) in enumerate(TEMPLATES))
    plain = r"trim(regexp_replace(lower({}), '[^a-z0-9\x{{80}}-\x{{10ffff}}]+', ' ', 'g'))"
    return rf"""
WITH t AS (
  SELECT template, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS tp
  FROM (SELECT *, string_split({plain.format("notice")}, ' ') AS w FROM (VALUES {values}) v(template, license, notice))),
r AS (SELECT doc_id, text, ROW_NUMBER() OVER () AS row FROM documents),
l AS (SELECT doc_id, row, unnest(string_split(lower(text), chr(10))) AS body FROM r),
ln AS (SELECT doc_id, row, body, ROW_NUMBER() OVER () AS line,
         string_split(regexp_replace(body, '([.!?])[ 	-
]+', '' || chr(10), 'g'), chr(10)) AS parts FROM l),
s AS (SELECT doc_id, row, line, 0 AS whole, unnest(parts) AS segment FROM ln
      UNION ALL SELECT doc_id, row, line, 1, body FROM ln WHERE len(parts) > 1),
sg AS (SELECT *, ROW_NUMBER() OVER () AS seg, string_split({plain.format("segment")}, ' ') AS w FROM s),
sp AS (SELECT doc_id, row, seg, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p FROM sg WHERE len(w) > 1),
c AS (SELECT doc_id, row, seg, license,
        2.0 * len(list_intersect(p, tp)) / (len(p) + len(tp)) AS dice
      FROM sp JOIN t ON len(p) BETWEEN len(tp) * 0.6 AND len(tp) * 1.6),
b AS (SELECT doc_id, row, seg, arg_min(license, (-dice, license)) AS license, MAX(dice) AS dice
      FROM c WHERE dice >= 0.8 GROUP BY ALL)
SELECT doc_id, license, CAST(ROUND(MAX(dice), 6) AS DOUBLE) AS dice, COUNT(*) AS n_segments
FROM b GROUP BY doc_id, row, license"""


OP11 = r"""
WITH r AS (SELECT doc_id, ROW_NUMBER() OVER () AS row, string_split(COALESCE(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, row, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM r),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, MAX(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key
      HAVING COUNT(DISTINCT doc_id) + MAX(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 5),
d AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.last AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, COUNT(*) AS n_lines, CAST(SUM(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d GROUP BY row"""

ORACLE_SQL: dict[str, str] = {"op6_licenses": _op6(), "op10_mixing": OP10, "op11_line_index": OP11}
