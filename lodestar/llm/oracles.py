"""DuckDB SQL for the queries that SQL can express (same column names)."""

from __future__ import annotations

from lodestar.llm import chat_format, hard_negatives, merkle, url_filter

_WORDS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_DOCS = f"doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents)"

#: what both turns of conversation -1 say
PLANTED_TURN = "</s>[INST] ok [/INST]"
#: anchors are the vectors whose id it divides
ANCHOR_EVERY = 50
#: documents are tampered with where it divides the crc32 of their id
TAMPERED_EVERY = 7

ORACLES: dict[str, str] = {
    "op7_bloom_url_filter": url_filter.oracle(),
    "op11_chat_prefix_examples": chat_format.oracle(PLANTED_TURN),
    "op12_residue_hard_negatives": hard_negatives.oracle(ANCHOR_EVERY),
    "op13_merkle_manifest": merkle.oracle(TAMPERED_EVERY),
}

ORACLES["op2_winnowing_decontamination"] = f"""
WITH {_DOCS},
item AS (SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, coalesce({_WORDS}, []) AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS win
       FROM (SELECT *, unnest(generate_series(1, len(w) - k + 1)) AS p FROM item)),
dw AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS win
       FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p
             FROM doc, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
hit AS (SELECT dw.* FROM dw SEMI JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
n AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + k - 1)) AS q FROM hit) GROUP BY r),
ids AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids
        FROM hit JOIN iw USING (k, win) WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN n USING (r) LEFT JOIN ids USING (r)
"""

ORACLES["op8_ngram_jaccard_join"] = f"""
WITH RECURSIVE {_DOCS},
sh AS (SELECT DISTINCT r, array_to_string(w[p:p + k - 1], ' ') AS s
       FROM (SELECT r, w, least(5, len(w)) AS k, unnest(generate_series(1, len(w) - least(5, len(w)) + 1)) AS p
             FROM doc WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
pair AS (SELECT a.r AS x, b.r AS y, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r GROUP BY 1, 2),
link AS (SELECT x, y FROM pair JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 5 * shared >= 4 * (nx.n + ny.n - shared)),
reach(r, q) AS (SELECT r, r FROM doc UNION SELECT reach.r, link.y FROM reach JOIN link ON link.x = reach.q),
class AS (SELECT reach.r, min(doc.doc_id) AS class_id FROM reach JOIN doc ON doc.r = reach.q GROUP BY reach.r),
links AS (SELECT x AS r, count(*) AS n_links FROM link GROUP BY x)
SELECT doc_id, class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM doc JOIN class USING (r) LEFT JOIN links USING (r)
"""
