"""Queries of the ingest and reference edges over the documents binding.

``mixed_match_lines`` renders all documents as match-document fragments with every shape that
ingest has to cope with: several matches and products per category, keyword values that are
lists, texts, numbers, empty or missing, ids that are missing, blank, falsy, padded or shared,
class codes in each of their forms. The oracle states what each shape must become.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import sqltext as q
from ..operators import reference as ref
from ..operators import training as tr
from ..sources import driver_tables as dt
from ..sources.match import match_products
from .binding_plan import BindingRun
from .oracle import ORACLE_BASE, WS_SQL

#: Consecutive ids that share a fragment: what a fragment's lists can hold is bounded.
FRAGMENT_IDS = 16


def mixed_match_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = q.run(spark, f"""
        SELECT source, lang, doc_id, cast(floor(doc_id / {FRAGMENT_IDS}) AS bigint) AS fragment,
               named_struct(
                 'article_id', CASE doc_id % 9
                   WHEN 0 THEN cast(NULL AS variant) WHEN 1 THEN cast(' ' AS variant) WHEN 2 THEN cast(0 AS variant)
                   WHEN 3 THEN cast(concat(' ', doc_id, ' ') AS variant)
                   WHEN 4 THEN cast(concat('s', cast(floor(doc_id / 40) AS bigint)) AS variant)
                   ELSE cast(doc_id AS variant) END,
                 'description_short', doc_id,
                 'keywords', CASE doc_id % 6
                   WHEN 0 THEN cast(NULL AS variant) WHEN 1 THEN cast(split(text, {q.SPLIT}) AS variant)
                   WHEN 2 THEN cast(text AS variant) WHEN 3 THEN cast(doc_id AS variant)
                   WHEN 4 THEN cast(array(concat(' ', lang, ' '), NULL, '', '  ', source) AS variant)
                   ELSE cast('' AS variant) END,
                 'class_codes', CASE doc_id % 5
                   WHEN 0 THEN cast(NULL AS variant)
                   WHEN 1 THEN to_variant_object(named_struct('system', 'LANG', 'code', lang))
                   WHEN 2 THEN cast(array(cast(lang AS variant),
                                          to_variant_object(named_struct('system', 'S', 'code', doc_id))) AS variant)
                   WHEN 3 THEN cast(lang AS variant) ELSE parse_json('[]') END) AS product
        FROM {{docs}}""", docs=dt.read_table(spark, sf_dir, "documents"))
    return q.run(spark, f"""
        SELECT {q.lit(dt.RUN_VENDOR)} AS vendor_short_name, concat(source, '#', fragment) AS source,
               to_json(map(source, named_struct(
                 'vendor_category_name', upper(source),
                 'pim_matches', array_sort(collect_list(match),
                   (a, b) -> CASE WHEN a.pim_category_id < b.pim_category_id THEN -1 ELSE 1 END)))) AS value
        FROM (SELECT source, fragment, named_struct(
                       'pim_category_id', lang,
                       'assignment_source', CASE WHEN lang = 'es' THEN {q.lit(dt.UNTRUSTED_SOURCE)}
                                            ELSE {q.lit(dt.TRUSTED_SOURCE)} END,
                       'products', transform(array_sort(collect_list(named_struct('doc_id', doc_id, 'product', product)),
                         (a, b) -> CASE WHEN a.doc_id < b.doc_id THEN -1 ELSE 1 END), x -> x.product)) AS match
              FROM {{p}} GROUP BY source, fragment, lang)
        GROUP BY source, fragment""", p=products)


def _mixed(spark, sf_dir) -> DataFrame:
    """The flattened products; their ordinal is the document id that the description carries."""
    rows = match_products(mixed_match_lines(spark, sf_dir))
    keep = ", ".join("cast(description_short AS bigint) AS ordinal" if c == "ordinal" else c for c in rows.columns)
    return q.run(spark, f"SELECT {keep} FROM {{r}}", r=rows)


def q_ingest_products(spark, sf_dir):
    """Every product with its coerced id and keywords and its place in the document."""
    return q.run(spark, """
        SELECT vendor_category_id, vendor_category_name, pim_category_id, assignment_source, article_id,
               article_id_falsy, description_short, cast(size(keywords) AS bigint) AS n_keywords,
               md5(array_join(keywords, '|')) AS keywords_md5, cast(match_pos AS bigint) AS match_pos,
               cast(product_pos AS bigint) AS product_pos
        FROM {p}""", p=_mixed(spark, sf_dir))


def q_class_codes(spark, sf_dir):
    return q.run(spark, """
        SELECT description_short, cast(i AS bigint) AS position, c.system AS code_system, c.code AS code
        FROM (SELECT description_short, posexplode(class_codes) AS (i, c) FROM {p})""", p=_mixed(spark, sf_dir))


def q_extraction_rejects(spark, sf_dir):
    return tr.extraction_rejects(_mixed(spark, sf_dir))


def q_merge_duplicates(spark, sf_dir):
    """Repeated ids within one delivery: the last record wins, the first place stays."""
    new = tr.extract_training(_mixed(spark, sf_dir))
    merged = tr.merge_stable(new.limit(0), new)
    return q.run(spark, """SELECT article_id, pim_category_id, description_short, ordinal,
                                  cast(size(keywords) AS bigint) AS n_keywords FROM {m}""", m=merged)


def _edge_reference(spark, sf_dir) -> DataFrame:
    """Old categories with duplicates, padded ids, null mappings, and ids without new rules;
    one language is left out, so it must come in as a new category."""
    return q.run(spark, f"""
        SELECT {q.strip('pim_category_id')} AS cat_key, pim_category_id, pim_category_name,
               cast(NULL AS string) AS pim_category_path, vendor_mappings, cast(NULL AS string) AS entry_json, position
        FROM (SELECT DISTINCT lang FROM {{docs}})
        LATERAL VIEW inline(array(
          named_struct('pim_category_id', concat(' ', lang), 'pim_category_name', concat('Old ', lang),
                       'vendor_mappings', 'null', 'position', 1L),
          named_struct('pim_category_id', lang, 'pim_category_name', concat('Second ', lang),
                       'vendor_mappings', '[1]', 'position', 2L),
          named_struct('pim_category_id', concat('gone-', lang), 'pim_category_name', cast(NULL AS string),
                       'vendor_mappings', '[2]', 'position', 3L))) x
        WHERE lang <> 'de'""", docs=dt.read_table(spark, sf_dir, "documents"))


def q_reference_categories(spark, sf_dir):
    run = BindingRun.build(spark, sf_dir)
    cats, _ = ref.rebuild_reference(_edge_reference(spark, sf_dir), run.proposals_cut(), run.dim_cut())
    return q.run(spark, "SELECT cat_key, pim_category_id, pim_category_name, pim_category_path, vendor_mappings "
                        "FROM {c}", c=cats)


def q_rule_dedup(spark, sf_dir):
    """Rules proposed under an id and under the padded id are one rule of one category."""
    run = BindingRun.build(spark, sf_dir)
    p = run.proposals_cut()
    twice = q.run(spark, f"SELECT * FROM {{p}} UNION ALL SELECT concat(' ', pim_category_id) AS pim_category_id, "
                         f"{', '.join(c for c in p.columns if c != 'pim_category_id')} FROM {{p}}", p=p)
    _, rules = ref.rebuild_reference(_edge_reference(spark, sf_dir), twice, run.dim_cut())
    return q.run(spark, "SELECT cat_key, field_name, operator, array_join(values_include, ',') AS values_include "
                        "FROM {r}", r=rules)


INGEST_QUERIES = {
    "ingest_products": q_ingest_products,
    "class_codes": q_class_codes,
    "extraction_rejects": q_extraction_rejects,
    "merge_duplicates": q_merge_duplicates,
    "reference_categories": q_reference_categories,
    "rule_dedup_relaxed": q_rule_dedup,
}

_MIXED = r"""
WITH tok AS (
  SELECT doc_id, list_filter(string_split_regex(text, '[ \t\n\r\f]+'), lambda t: trim(t, WS_CHARS) <> '') AS tokens
  FROM documents),
p AS (
  SELECT d.doc_id, source, lang, doc_id // 16 AS fragment,
         CASE doc_id % 9 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN '0' WHEN 3 THEN ' ' || doc_id || ' '
                         WHEN 4 THEN 's' || (doc_id // 40) ELSE doc_id::VARCHAR END AS article_id,
         doc_id % 9 IN (0, 2) AS article_id_falsy,
         CASE WHEN lang = 'es' THEN 'ai_suggestion' ELSE 'existing_category_match' END AS assignment_source,
         CASE doc_id % 6 WHEN 1 THEN tok.tokens
                         WHEN 2 THEN CASE WHEN trim(d.text, WS_CHARS) <> '' THEN [d.text] ELSE []::VARCHAR[] END
                         WHEN 3 THEN [doc_id::VARCHAR] WHEN 4 THEN [' ' || lang || ' ', source]
                         ELSE []::VARCHAR[] END AS keywords
  FROM documents d JOIN tok USING (doc_id)),
trusted AS (SELECT * FROM p WHERE assignment_source = 'existing_category_match')
""".replace("WS_CHARS", WS_SQL)

INGEST_SQL = {
    "ingest_products": _MIXED + """
SELECT source AS vendor_category_id, upper(source) AS vendor_category_name, lang AS pim_category_id,
       assignment_source, article_id, article_id_falsy, doc_id::VARCHAR AS description_short,
       len(keywords)::BIGINT AS n_keywords, md5(coalesce(array_to_string(keywords, '|'), '')) AS keywords_md5,
       dense_rank() OVER (PARTITION BY source, fragment ORDER BY lang) - 1 AS match_pos,
       row_number() OVER (PARTITION BY source, fragment, lang ORDER BY doc_id) - 1 AS product_pos
FROM p""",
    "class_codes": """
SELECT doc_id::VARCHAR AS description_short, 0::BIGINT AS position,
       CASE WHEN doc_id % 5 = 1 THEN 'LANG' END AS code_system, lang AS code
FROM documents WHERE doc_id % 5 IN (1, 2, 3)
UNION ALL
SELECT doc_id::VARCHAR, 1, 'S', doc_id::VARCHAR FROM documents WHERE doc_id % 5 = 2""",
    "extraction_rejects": _MIXED + """
SELECT 'vendorA' AS vendor_short_name, source AS vendor_category_id, count(*) AS rejected_products
FROM trusted WHERE doc_id % 9 IN (0, 1) GROUP BY source""",
    "merge_duplicates": _MIXED + """
, k AS (SELECT *, trim(article_id) AS key FROM trusted WHERE doc_id % 9 NOT IN (0, 1, 2)),
w AS (SELECT key, max(doc_id) AS last, min(doc_id) AS ordinal FROM k GROUP BY key)
SELECT k.article_id, k.lang AS pim_category_id, k.doc_id::VARCHAR AS description_short, w.ordinal,
       len(k.keywords)::BIGINT AS n_keywords
FROM w JOIN k ON k.key = w.key AND k.doc_id = w.last""",
    "reference_categories": ORACLE_BASE + """
, o AS (
  SELECT DISTINCT lang AS cat_key, ' ' || lang AS id, 'Old ' || lang AS name, '[]' AS maps
  FROM documents WHERE lang <> 'de'
  UNION ALL
  SELECT DISTINCT 'gone-' || lang, 'gone-' || lang, NULL, '[2]' FROM documents WHERE lang <> 'de')
SELECT coalesce(o.cat_key, r.cat_key) AS cat_key, coalesce(o.id, r.cat_key) AS pim_category_id,
       CASE WHEN o.cat_key IS NULL THEN dim.pim_category_name ELSE o.name END AS pim_category_name,
       CASE WHEN o.cat_key IS NULL THEN dim.pim_category_path END AS pim_category_path,
       coalesce(o.maps, '[]') AS vendor_mappings
FROM o FULL OUTER JOIN (SELECT DISTINCT cat_key FROM accepted) r ON r.cat_key = o.cat_key
LEFT JOIN dim ON dim.pim_category_id = r.cat_key""",
    "rule_dedup_relaxed": ORACLE_BASE + """
SELECT cat_key, 'KEYWORD' AS field_name, 'contains_any' AS operator, keyword AS values_include FROM accepted""",
}
