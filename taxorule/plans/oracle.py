"""DuckDB SQL for every binding query: an independent statement of the same result.

Written straight from the job's semantics (joins and group-bys as the job had them)
against the raw ``documents`` view, so it shares no code path with the Spark plans.
"""

from __future__ import annotations

from ..functions.text import PY_WHITESPACE

# Python's strip() set spelled as DuckDB chr() calls, derived from the same rule.
_WS = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)

_STRING_FIELDS = ("pim_category_id, pim_category_name, pim_category_path, vendor_short_name, "
                  "vendor_category_id, vendor_category_name, vendor_category_path, article_id, "
                  "description_short")

_BASE = r"""
WITH d0 AS (
  SELECT doc_id, text, lang, source,
         CASE WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'vendorA' ELSE 'vendorB' END
           AS vendor_short_name
  FROM documents),
d1 AS (
  SELECT *, (vendor_short_name = 'vendorA' AND doc_id % 10 = 0) AS untrusted FROM d0),
d2 AS (
  SELECT doc_id, text, lang, source, vendor_short_name,
         CASE WHEN untrusted THEN 'ai_suggestion' ELSE 'existing_category_match' END
           AS assignment_source,
         CASE WHEN untrusted THEN (CASE WHEN lang = 'en' THEN 'fr' WHEN lang = 'fr' THEN 'de'
                                        WHEN lang = 'de' THEN 'es' ELSE 'en' END)
              ELSE lang END AS pim_category_id,
         source AS vendor_category_id, upper(source) AS vendor_category_name,
         vendor_short_name || '/' || source AS vendor_category_path,
         CAST(doc_id AS VARCHAR) AS article_id, text AS description_short,
         doc_id AS ordinal
  FROM d1),
kw AS (
  SELECT doc_id, k AS keyword FROM (
    SELECT doc_id, trim(unnest(string_split_regex(text, '[ \t\n\r\f]+')), WS_CHARS) AS k
    FROM documents) t
  WHERE k <> ''),
nkw AS (SELECT doc_id, count(*) AS n_keywords FROM kw GROUP BY doc_id),
recs AS (
  SELECT d2.*, upper(pim_category_id) AS pim_category_name,
         'Products/' || upper(pim_category_id) AS pim_category_path,
         CAST(coalesce(nkw.n_keywords, 0) AS BIGINT) AS n_keywords
  FROM d2 LEFT JOIN nkw USING (doc_id)),
products AS (SELECT * FROM recs WHERE vendor_short_name = 'vendorA'),
existing AS (SELECT * FROM recs WHERE vendor_short_name = 'vendorB'),
new_recs AS (SELECT * FROM products WHERE assignment_source = 'existing_category_match'),
merged AS (
  SELECT * FROM existing
  UNION ALL BY NAME
  SELECT * REPLACE (ordinal + (SELECT coalesce(max(ordinal) + 1, 0) FROM existing) AS ordinal)
  FROM new_recs),
cnt AS (
  SELECT trim(pim_category_id, WS_CHARS) AS cat_key, count(*) AS n_products FROM merged
  WHERE pim_category_id IS NOT NULL AND trim(pim_category_id, WS_CHARS) <> '' GROUP BY 1),
subset AS (
  SELECT * FROM merged
  WHERE trim(pim_category_id, WS_CHARS) IN (SELECT cat_key FROM cnt WHERE n_products >= 10)),
pcnt AS (
  SELECT trim(pim_category_id, WS_CHARS) AS cat_key, count(*) AS n_products FROM existing
  WHERE pim_category_id IS NOT NULL AND trim(pim_category_id, WS_CHARS) <> '' GROUP BY 1),
previous AS (
  SELECT * FROM existing
  WHERE trim(pim_category_id, WS_CHARS) IN (SELECT cat_key FROM pcnt WHERE n_products >= 10)),
occ AS (SELECT s.pim_category_id, s.article_id, k.keyword FROM subset s JOIN kw k USING (doc_id)),
inside AS (SELECT pim_category_id, keyword, count(*) AS inside_count FROM occ GROUP BY 1, 2),
totals AS (SELECT keyword, count(*) AS train_total_count FROM occ GROUP BY 1),
stats AS (
  SELECT i.pim_category_id, i.keyword, i.inside_count, t.train_total_count,
         t.train_total_count - i.inside_count AS hard_outside_count
  FROM inside i JOIN totals t USING (keyword)),
vocc AS (SELECT p.pim_category_id, k.keyword FROM products p JOIN kw k USING (doc_id)),
vinside AS (SELECT pim_category_id, keyword, count(*) AS vendor_inside_count FROM vocc GROUP BY 1, 2),
vtotals AS (SELECT keyword, count(*) AS vendor_total_count FROM vocc GROUP BY 1),
prev_pairs AS (SELECT DISTINCT p.pim_category_id, k.keyword FROM previous p JOIN kw k USING (doc_id)),
scored0 AS (
  SELECT s.*, CAST(coalesce(vi.vendor_inside_count, 0) AS BIGINT) AS vendor_inside_count,
         CAST(coalesce(vt.vendor_total_count, 0) AS BIGINT) AS vendor_total_count,
         pp.keyword IS NOT NULL AS known_in_previous_training
  FROM stats s
  LEFT JOIN vinside vi ON vi.pim_category_id = s.pim_category_id AND vi.keyword = s.keyword
  LEFT JOIN vtotals vt ON vt.keyword = s.keyword
  LEFT JOIN prev_pairs pp ON pp.pim_category_id = s.pim_category_id AND pp.keyword = s.keyword
  WHERE s.inside_count >= 10 AND s.hard_outside_count <= 0),
scored1 AS (
  SELECT *, vendor_total_count - vendor_inside_count AS vendor_outside_count,
         vendor_total_count > 0 AS has_vendor_usage, TRUE AS global_candidate FROM scored0),
scored2 AS (
  SELECT *, (vendor_inside_count >= 3 AND vendor_outside_count <= 0) AS vendor_supports,
         vendor_outside_count > 0 AS vendor_violates,
         NOT known_in_previous_training AS is_new_rule FROM scored1),
scored AS (
  SELECT *, CASE WHEN is_new_rule AND vendor_supports THEN 'new'
                 WHEN vendor_supports THEN 'supported'
                 WHEN vendor_violates THEN 'violated'
                 WHEN NOT has_vendor_usage THEN 'not_impacted' END AS vendor_status
  FROM scored2),
dim AS (
  SELECT pim_category_id,
         arg_min(pim_category_name, ordinal) FILTER (WHERE pim_category_name IS NOT NULL) AS pim_category_name,
         arg_min(pim_category_path, ordinal) FILTER (WHERE pim_category_path IS NOT NULL) AS pim_category_path
  FROM subset WHERE pim_category_id IS NOT NULL GROUP BY 1),
proposals AS (
  SELECT s.*, dim.pim_category_name FROM scored s LEFT JOIN dim USING (pim_category_id)
  WHERE s.vendor_status IS NOT NULL),
accepted AS (
  SELECT DISTINCT trim(pim_category_id, WS_CHARS) AS cat_key, trim(keyword, WS_CHARS) AS keyword
  FROM proposals WHERE vendor_status IN ('new', 'supported', 'not_impacted')
    AND trim(pim_category_id, WS_CHARS) <> '' AND trim(keyword, WS_CHARS) <> ''),
pdim AS (
  SELECT pim_category_id,
         arg_min(pim_category_name, ordinal) FILTER (WHERE pim_category_name IS NOT NULL) AS pim_category_name
  FROM previous WHERE pim_category_id IS NOT NULL GROUP BY 1),
old_cats AS (SELECT trim(pim_category_id, WS_CHARS) AS cat_key, pim_category_id, pim_category_name FROM pdim),
pocc AS (SELECT p.pim_category_id, k.keyword FROM previous p JOIN kw k USING (doc_id)),
pinside AS (SELECT pim_category_id, keyword, count(*) AS inside_count FROM pocc GROUP BY 1, 2),
ptotals AS (SELECT keyword, count(*) AS total_count FROM pocc GROUP BY 1),
old_rules AS (
  SELECT DISTINCT trim(i.pim_category_id, WS_CHARS) AS cat_key, i.keyword
  FROM pinside i JOIN ptotals t USING (keyword)
  WHERE i.inside_count >= 10 AND t.total_count - i.inside_count <= 0),
new_cats AS (
  SELECT coalesce(o.cat_key, r.cat_key) AS cat_key,
         CASE WHEN o.cat_key IS NOT NULL THEN o.pim_category_id ELSE r.cat_key END AS pim_category_id,
         CASE WHEN o.cat_key IS NOT NULL THEN o.pim_category_name ELSE dim.pim_category_name END
           AS pim_category_name
  FROM old_cats o
  FULL OUTER JOIN (SELECT DISTINCT cat_key FROM accepted) r ON r.cat_key = o.cat_key
  LEFT JOIN dim ON dim.pim_category_id = r.cat_key)
"""

WS_SQL = f"({_WS})"
ORACLE_BASE = _BASE = _BASE.replace("WS_CHARS", WS_SQL)


def _q(body: str) -> str:
    return _BASE + body


ORACLE_SQL = {
    "vendor_match_products": _q("""
SELECT vendor_short_name, vendor_category_id, vendor_category_name, vendor_category_path,
       pim_category_id, pim_category_name, pim_category_path, assignment_source, article_id,
       description_short, n_keywords, CAST(1 AS BIGINT) AS n_class_codes
FROM products"""),
    "accepted_training": _q(f"SELECT {_STRING_FIELDS}, n_keywords, ordinal FROM new_recs"),
    "stable_merge": _q(f"""
, ex3 AS (
  SELECT * REPLACE (CASE WHEN vendor_short_name = 'vendorA' THEN 'stale' ELSE description_short END
                    AS description_short)
  FROM recs
  WHERE vendor_short_name = 'vendorB' OR (vendor_short_name = 'vendorA' AND doc_id % 20 <= 1)),
m3 AS (
  SELECT n.* REPLACE (coalesce(e.ordinal, n.ordinal + (SELECT coalesce(max(ordinal) + 1, 0) FROM ex3))
                      AS ordinal)
  FROM new_recs n
  LEFT JOIN ex3 e ON e.vendor_short_name = n.vendor_short_name AND e.article_id = n.article_id
  UNION ALL BY NAME
  SELECT e.* FROM ex3 e
  WHERE NOT EXISTS (SELECT 1 FROM new_recs n
                    WHERE n.vendor_short_name = e.vendor_short_name AND n.article_id = e.article_id))
SELECT {_STRING_FIELDS}, n_keywords, ordinal FROM m3"""),
    "category_counts": _q("SELECT cat_key, n_products FROM cnt"),
    "usable_categories": _q("SELECT cat_key FROM cnt WHERE n_products >= 100"),
    "training_subset": _q(f"SELECT {_STRING_FIELDS}, n_keywords, ordinal FROM subset"),
    "keyword_occurrences": _q("""
SELECT pim_category_id, article_id, count(*) AS n_occurrences,
       count(DISTINCT keyword) AS n_distinct_keywords
FROM occ GROUP BY 1, 2"""),
    "keyword_stats": _q("SELECT * FROM stats"),
    "keyword_totals": _q("SELECT * FROM totals"),
    "vendor_inside": _q("SELECT * FROM vinside"),
    "vendor_totals": _q("SELECT * FROM vtotals"),
    "previous_pairs": _q("SELECT * FROM prev_pairs"),
    "previous_pairs_min60": _q("""
SELECT DISTINCT e.pim_category_id, k.keyword
FROM existing e JOIN kw k USING (doc_id)
WHERE trim(e.pim_category_id, WS_CHARS) IN (SELECT cat_key FROM pcnt WHERE n_products >= 60)
""".replace("WS_CHARS", f"({_WS})")),
    "scored_candidates": _q("SELECT * FROM scored"),
    "scored_candidates_joins": _q("SELECT * FROM scored"),
    "scored_candidates_by_role": _q("SELECT * FROM scored"),
    "strict_candidates": _q("SELECT * FROM scored WHERE vendor_supports"),
    "rule_proposals": _q("""
SELECT pim_category_id, pim_category_name, 'KEYWORD' AS field_name, 'contains_any' AS operator,
       keyword AS values_include, '' AS values_exclude, inside_count, train_total_count,
       hard_outside_count, vendor_inside_count, vendor_total_count, vendor_outside_count,
       vendor_status
FROM proposals"""),
    "status_summary": _q("SELECT vendor_status, count(*) AS n_rules FROM proposals GROUP BY 1"),
    "accepted_rules": _q("""
SELECT trim(pim_category_id, WS_CHARS) AS pim_category_id, 'KEYWORD' AS field_name,
       'contains_any' AS operator, trim(keyword, WS_CHARS) AS values_include, '' AS values_exclude
FROM proposals WHERE vendor_status IN ('new', 'supported', 'not_impacted')
""".replace("WS_CHARS", f"({_WS})")),
    "category_dim": _q("SELECT * FROM dim"),
    "reference_rule_counts": _q("""
SELECT c.pim_category_id, c.pim_category_name, CAST(count(a.keyword) AS BIGINT) AS n_rules
FROM new_cats c LEFT JOIN accepted a ON a.cat_key = c.cat_key
GROUP BY 1, 2"""),
    "rule_changes": _q("""
, diff AS (
  SELECT coalesce(o.cat_key, a.cat_key) AS cat_key, coalesce(o.keyword, a.keyword) AS keyword,
         CASE WHEN o.cat_key IS NULL THEN 'added' ELSE 'removed' END AS change
  FROM old_rules o FULL OUTER JOIN accepted a ON a.cat_key = o.cat_key AND a.keyword = o.keyword
  WHERE o.cat_key IS NULL OR a.cat_key IS NULL)
SELECT d.cat_key AS pim_category_id, c.pim_category_name, d.change,
       'KEYWORD|contains_any|' || d.keyword || '|' AS rule
FROM diff d LEFT JOIN new_cats c ON c.cat_key = d.cat_key"""),
}
