"""Mapping reference: rebuild from accepted rules, and the rule change log.

The reference is kept flat -- one row per category and one row per (category, rule)
-- so rebuilding and diffing are joins on category / rule keys, never per-category
lists. Opaque parts of old entries (``vendor_mappings``, the whole entry) travel as
JSON text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import ACCEPTED_STATUSES
from ..functions import sqltext as q

CATEGORY_COLUMNS = ("cat_key", "pim_category_id", "pim_category_name", "pim_category_path",
                    "vendor_mappings", "entry_json", "position")
RULE_COLUMNS = ("cat_key", "entry_position", "rule_position", "field_name", "operator",
                "values_include", "values_exclude", "rule_json")

_EMPTY = "cast(array() AS array<string>)"
# Identity of a rule: field, operator and the sorted value lists (NULL lists = empty).
SIGNATURE = (f"named_struct('field_name', field_name, 'operator', operator, "
             f"'values_include', array_sort(coalesce(values_include, {_EMPTY})), "
             f"'values_exclude', array_sort(coalesce(values_exclude, {_EMPTY})))")
SIGNATURE_TEXT = ("concat_ws('|', coalesce(signature.field_name, ''), coalesce(signature.operator, ''), "
                  "array_join(signature.values_include, ','), array_join(signature.values_exclude, ','))")
_RULE_JSON = ("to_json(named_struct('field_name', field_name, 'values_include', values_include, "
              "'values_exclude', values_exclude, 'operator', operator))")


def accepted_rules(proposals: DataFrame) -> DataFrame:
    """Accepted proposals as mapping methods: status new / supported / not_impacted,
    category stripped and non-blank, values stripped, blanks dropped, empty rules dropped."""
    statuses = ", ".join(q.lit(s) for s in ACCEPTED_STATUSES)
    values = q.clean_keywords(f"coalesce(values_include, {_EMPTY})")
    return q.run(proposals.sparkSession, f"""
        SELECT cat_key, field_name, operator, values_include, {_EMPTY} AS values_exclude
        FROM (SELECT {q.strip('pim_category_id')} AS cat_key,
                     coalesce(field_name, 'KEYWORD') AS field_name,
                     coalesce(operator, 'contains_any') AS operator,
                     {values} AS values_include
              FROM {{p}} WHERE stats.vendor_status IN ({statuses})) a
        WHERE cat_key IS NOT NULL AND cat_key <> '' AND size(values_include) > 0""", p=proposals)


def _first_entries(categories: DataFrame) -> DataFrame:
    """One entry per stripped category id: the first one in file order."""
    fields = ", ".join(f"'{c}', {c}" for c in CATEGORY_COLUMNS if c != "cat_key")
    return q.run(categories.sparkSession, f"""
        SELECT cat_key, e.* FROM (
          SELECT cat_key, min_by(named_struct({fields}), position) AS e
          FROM {{c}} WHERE cat_key IS NOT NULL AND cat_key <> '' GROUP BY cat_key)""", c=categories)


def rebuild_reference(old_categories: DataFrame, proposals: DataFrame, dim: DataFrame,
                      allow_empty: bool = True) -> tuple[DataFrame, DataFrame]:
    """New reference (categories, rules) from the old categories and this run's rules.

    Every old category is carried over (first entry per id; NULL ``vendor_mappings``
    become ``[]``) with its rules cleared; categories that only appear in accepted
    rules are added with name and path from ``dim``, looked up by the raw id as the
    job did. Rules are the accepted ones, one per signature. With
    ``allow_empty=False`` an empty reference raises.
    """
    spark = proposals.sparkSession
    rules = q.run(spark, f"""
        SELECT cat_key, r.* FROM (
          SELECT cat_key, min_by(named_struct('field_name', field_name, 'operator', operator,
                                              'values_include', values_include,
                                              'values_exclude', values_exclude),
                                 array_join(values_include, ' ')) AS r
          FROM (SELECT *, {SIGNATURE} AS signature FROM {{a}})
          GROUP BY cat_key, signature)""", a=accepted_rules(proposals))
    categories = q.run(spark, """
        SELECT c.cat_key,
               CASE WHEN c.position IS NOT NULL THEN c.pim_category_id ELSE c.cat_key END AS pim_category_id,
               CASE WHEN c.position IS NOT NULL THEN c.pim_category_name ELSE d.pim_category_name END
                 AS pim_category_name,
               CASE WHEN c.position IS NOT NULL THEN c.pim_category_path ELSE d.pim_category_path END
                 AS pim_category_path,
               coalesce(CASE WHEN c.vendor_mappings <> 'null' THEN c.vendor_mappings END, '[]')
                 AS vendor_mappings,
               c.entry_json,
               -- one entry per category from here on, so every position is 0
               cast(0 AS bigint) AS position
        FROM (SELECT coalesce(o.cat_key, rc.cat_key) AS cat_key, o.pim_category_id, o.pim_category_name,
                     o.pim_category_path, o.vendor_mappings, o.entry_json, o.position
              FROM {o} o FULL OUTER JOIN (SELECT DISTINCT cat_key FROM {r}) rc ON o.cat_key = rc.cat_key) c
        LEFT JOIN {d} d ON d.pim_category_id = c.cat_key""",
                       r=rules, o=_first_entries(old_categories), d=dim)
    rule_rows = q.run(spark, f"""
        SELECT cat_key, cast(0 AS bigint) AS entry_position, cast(0 AS bigint) AS rule_position,
               field_name, operator, values_include, values_exclude, {_RULE_JSON} AS rule_json
        FROM {{r}}""", r=rules)
    if not allow_empty and categories.isEmpty():
        raise RuntimeError("mapping reference has 0 categories")
    return categories, rule_rows


def reference_rule_counts(categories: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules per category of a reference (0 for categories without rules)."""
    return q.run(categories.sparkSession, """
        SELECT c.pim_category_id, c.pim_category_name, cast(coalesce(n.n_rules, 0) AS bigint) AS n_rules
        FROM {c} c LEFT JOIN (SELECT cat_key, count(1) AS n_rules FROM {r} GROUP BY cat_key) n
          ON c.cat_key = n.cat_key""", c=categories, r=rules)


def rule_changes(old_categories: DataFrame, old_rules: DataFrame,
                 new_categories: DataFrame, new_rules: DataFrame) -> DataFrame:
    """Added / removed rules per category, one row per changed rule.

    Old rules count only for the first entry of each category id; within a category
    a repeated signature keeps its last rule object (verbatim JSON). One full outer
    join on (category, signature) yields both differences.
    """
    old_map = f"""(SELECT cat_key, signature, max_by(rule_json, rule_position) AS old_rule
                   FROM (SELECT r.cat_key, {SIGNATURE} AS signature, r.rule_json, r.rule_position
                         FROM {{orr}} r LEFT SEMI JOIN {{first}} f
                           ON r.cat_key = f.cat_key AND r.entry_position = f.position) x
                   GROUP BY cat_key, signature)"""
    new_map = f"""(SELECT cat_key, signature, min(rule_json) AS new_rule
                   FROM (SELECT cat_key, {SIGNATURE} AS signature, rule_json FROM {{nr}}) y
                   GROUP BY cat_key, signature)"""
    diff = f"""(SELECT coalesce(o.cat_key, n.cat_key) AS cat_key,
                       coalesce(o.signature, n.signature) AS signature, o.old_rule, n.new_rule
                FROM {old_map} o FULL OUTER JOIN {new_map} n
                  ON o.cat_key = n.cat_key AND o.signature = n.signature
                WHERE o.old_rule IS NULL OR n.new_rule IS NULL)"""
    names = """(SELECT coalesce(n.cat_key, f.cat_key) AS cat_key,
                       coalesce(n.pim_category_name, f.pim_category_name) AS pim_category_name
                FROM {nc} n FULL OUTER JOIN {first} f ON n.cat_key = f.cat_key)"""
    return q.run(old_categories.sparkSession, f"""
        SELECT d.cat_key AS pim_category_id, names.pim_category_name,
               CASE WHEN d.old_rule IS NULL THEN 'added' ELSE 'removed' END AS change,
               CASE WHEN d.old_rule IS NULL THEN d.new_rule ELSE d.old_rule END AS rule_json,
               {SIGNATURE_TEXT.replace('signature.', 'd.signature.')} AS signature
        FROM {diff} d LEFT JOIN {names} names ON d.cat_key = names.cat_key""",
                 orr=old_rules, first=_first_entries(old_categories), nr=new_rules, nc=new_categories)
