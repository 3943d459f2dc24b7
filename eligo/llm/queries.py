"""The corpus operators' queries and the SQL that gives the same rows."""

from __future__ import annotations

from eligo.llm.audit import ORACLE as AUDIT_ORACLE
from eligo.llm.audit import op13_filter_audit
from eligo.llm.bpe import op4_bpe_trie
from eligo.llm.chat import ORACLE as CHAT_ORACLE
from eligo.llm.chat import op10_chat_examples
from eligo.llm.fingerprints import op1_fingerprints
from eligo.llm.licenses import op9_license_scan
from eligo.llm.neardup import op5_near_duplicates
from eligo.llm.packing import op7_best_fit_packing
from eligo.llm.piece import op11_piece_rounds
from eligo.llm.quality import op2_quality_rules
from eligo.llm.resample import op12_importance_resampling
from eligo.llm.toxicity import op8_toxicity
from eligo.llm.urlfilter import op6_url_filter
from eligo.llm.warc import op3_warc

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_quality_rules": op2_quality_rules,
    "op3_warc": op3_warc,
    "op4_bpe_trie": op4_bpe_trie,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_url_filter": op6_url_filter,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_chat_examples": op10_chat_examples,
    "op11_piece_rounds": op11_piece_rounds,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_filter_audit": op13_filter_audit,
}

URL_PARTS = """
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
"""

ORACLES: dict[str, str] = {
    "op10_chat_examples": CHAT_ORACLE,
    "op13_filter_audit": AUDIT_ORACLE,
    "op6_url_filter": rf"""
WITH parts AS ({URL_PARTS}),
rules(rule, rule_host, rule_path, rule_verdict) AS (VALUES
    ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
    ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
fits AS (
    SELECT page_id, rule, rule_verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS k
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
links AS (
    SELECT DISTINCT host, path, TRUE AS listed FROM parts JOIN pages ON parts.page_id = pages.page_id
    WHERE host <> '' AND len(regexp_extract_all(coalesce(html, ''), '<a ')) > len(regexp_extract_all(coalesce(html, ''), '<p>')))
SELECT parts.page_id, parts.host, parts.path, rule,
       CASE WHEN rule_verdict IS NOT NULL THEN rule_verdict WHEN listed THEN 'block'
            WHEN regexp_matches(parts.host, '(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.') THEN 'block' ELSE 'allow' END AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) AS f ON parts.page_id = f.page_id LEFT JOIN links ON links.host = parts.host AND links.path = parts.path
""",
    "op3_warc": r"""
WITH made AS (
    SELECT page_id, coalesce(html, '') AS payload, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits,
           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
    FROM pages)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, CAST(5 * k + j + 1 AS BIGINT), 1) AS BIGINT) * (16 >> CAST(j AS INTEGER)))) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM made
""",
    "op5_near_duplicates": r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM cut WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2)
    JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * same >= 80 * (p.n + q.n - same)),
reach AS (SELECT DISTINCT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
groups AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT cut.doc_id, coalesce(n, 0) AS n_shingles, component_id, cut.doc_id = component_id AS kept
FROM cut LEFT JOIN sizes ON sizes.doc_id = cut.doc_id JOIN groups ON groups.x = cut.doc_id
""",
}
