"""DuckDB SQL of the training-data queries."""

ORACLE: dict[str, str] = {}

ORACLE["op2_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), d AS (
  SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x,
         max(page_id) OVER (PARTITION BY h) AS top
  FROM p
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda j:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
           ((CAST('0x' || substr(x, CAST(10 * (j // 8) + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (j % 8) AS BIGINT)) & 31) AS BIGINT), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""

ORACLE["op6_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(text, '\', '\1'), '<|', '<\0|'), '<s>', '<\0s>'),
            '</s>', '<\0/s>'), '[INST]', '[\0INST]'), '[/INST]', '[\0/INST]') AS safe
  FROM c
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, safe) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn, role, safe) FILTER (role = 'assistant'), '') AS trained,
         sum(length('<|turn|>') + length(role) + 1 + length(safe) + length('<|end|>')) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(trained) AS loss_chars,
       sha256(trained) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""

ORACLE["op4_urls"] = r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), o AS (
  SELECT doc_id AS page_id,
         CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END AS bad
  FROM labels
), n AS (
  SELECT host, string_split(host, '.') AS part,
         regexp_matches(host, '(^|\.)[0-9]+(:[0-9]+)?$') AS address,
         count(o.bad) AS n, coalesce(sum(o.bad), 0) AS bad
  FROM p LEFT JOIN o USING (page_id) GROUP BY host
), h AS (
  SELECT host, n, bad,
         CASE WHEN address THEN host
              WHEN array_to_string(part[-2:], '.') IN ('co.uk','org.uk','ac.uk','com.au','co.jp','com.br','co.in','co.nz')
              THEN array_to_string(part[-3:], '.') ELSE array_to_string(part[-2:], '.') END AS domain,
         CASE WHEN address THEN ''
              WHEN array_to_string(part[-2:], '.') IN ('co.uk','org.uk','ac.uk','com.au','co.jp','com.br','co.in','co.nz')
              THEN array_to_string(part[-2:], '.') ELSE part[-1] END AS suffix
  FROM n
), s AS (
  SELECT suffix, sum(n) AS sn, sum(bad) AS sb,
         (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM h) AS p0
  FROM h GROUP BY suffix
), s_fit AS (
  SELECT sum(sn * (sb / sn - p0) * (sb / sn - p0)) AS s, sum(p0 * (1 - p0)) AS p, sum(p0 * (1 - p0) * (sn - 1)) AS q
  FROM s WHERE sn > 0
), s_k AS (
  SELECT 1 / CASE WHEN coalesce(q, 0) = 0 THEN 1 / 1001.0 ELSE least(0.5, greatest(1 / 1001.0, (s - p) / q)) END - 1 AS k FROM s_fit
), sm AS (SELECT suffix, (sb + k * p0) / (sn + k) AS sm FROM s, s_k
), d AS (
  SELECT domain, suffix, sm, dn, db
  FROM (SELECT domain, suffix, sum(n) AS dn, sum(bad) AS db FROM h GROUP BY domain, suffix) JOIN sm USING (suffix)
), d_fit AS (
  SELECT sum(dn * (db / dn - sm) * (db / dn - sm)) AS s, sum(sm * (1 - sm)) AS p, sum(sm * (1 - sm) * (dn - 1)) AS q
  FROM d WHERE dn > 0
), d_k AS (
  SELECT 1 / CASE WHEN coalesce(q, 0) = 0 THEN 1 / 1001.0 ELSE least(0.5, greatest(1 / 1001.0, (s - p) / q)) END - 1 AS k FROM d_fit
), dm AS (SELECT domain, suffix, (db + k * sm) / (dn + k) AS dm FROM d, d_k
), g AS (SELECT host, n, bad, dm FROM h JOIN dm USING (domain, suffix)
), g_fit AS (
  SELECT sum(n * (bad / n - dm) * (bad / n - dm)) AS s, sum(dm * (1 - dm)) AS p, sum(dm * (1 - dm) * (n - 1)) AS q
  FROM g WHERE n > 0
), g_k AS (
  SELECT 1 / CASE WHEN coalesce(q, 0) = 0 THEN 1 / 1001.0 ELSE least(0.5, greatest(1 / 1001.0, (s - p) / q)) END - 1 AS k FROM g_fit
), post AS (SELECT host, bad + k * dm AS a, n - bad + k * (1 - dm) AS b FROM g, g_k
), v AS (
  SELECT host, CASE WHEN a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > 0.5
                    THEN 'block' ELSE 'allow' END AS verdict
  FROM post
), r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p
)
SELECT page_id, host, path, rule,
       CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block'
                 WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow' ELSE verdict END AS verdict
FROM r JOIN v USING (host)
"""
