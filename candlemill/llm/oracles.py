"""DuckDB SQL for the corpus queries that SQL can express.

The others are compared with brute-force versions or held-out labels in ``tests/llm``.
"""

_URL = r"""
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
"""

OP1 = f"""
WITH urls AS ({_URL}), judged AS (
    SELECT *, '.' || host AS dotted FROM urls
), ruled AS (
    SELECT *, CASE
        WHEN dotted LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN dotted LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN dotted LIKE '%.net' AND path LIKE '/%' THEN 'net/'
        WHEN dotted LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    END AS rule FROM judged
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP5 = """
WITH records AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM records
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
FROM firsts
"""

OP9 = r"""
WITH docs AS (
    SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS key,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CAST([1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS weight
    FROM docs GROUP BY source
), steps AS (
    SELECT *, CAST(sum(source_size) OVER () AS BIGINT)
              - CAST(coalesce(sum(3 * source_size) OVER before, 0) AS BIGINT) AS remains,
           CAST(sum(weight) OVER onward AS BIGINT) AS weights,
           row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS step
    FROM sources
    WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           onward AS (ORDER BY source_size / weight, source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), free AS (
    SELECT min(step) AS step FROM steps WHERE weight * (remains / weights) <= 3 * source_size
), targets AS (
    SELECT source, source_size,
           CASE WHEN step < (SELECT step FROM free) THEN CAST(3 * source_size AS DOUBLE)
                ELSE weight * (SELECT remains / weights FROM steps WHERE step = (SELECT step FROM free)) END AS target
    FROM steps
), placed AS (
    SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
           CAST(coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY key, doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
    FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
), passed AS (
    SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes FROM placed
)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(size, budget - passes * source_size - place)) AS BIGINT) AS taken
FROM passed
"""

ORACLES = {"op1_url_filter": OP1, "op5_warc": OP5, "op9_mixing": OP9}
