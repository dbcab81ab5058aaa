"""Incremental statistics: what a delivery changes in the counts over the stable dataset.

Four tables stand for the records in all that follows the merge:

* ``categories (cat_key, n_products)``: products per stripped category;
* ``pairs (pim_category_id, keyword, n)``: keyword occurrences of all records, whatever
  the category threshold;
* ``names``: per vendor and raw category, the first non-null name and path with their positions.

Counts are kept under signed changes: a delivery adds the occurrences of the records it puts in
and subtracts those it replaces, so only its own vendor's partition is read and tokenized. The
category threshold is not baked into the counts: it is a join with the categories that reach
it, so a category enters or leaves training without a recount. Minima cannot be subtracted, so
names are kept per vendor; a delivery replaces its vendor's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import sqltext as q
from ..schemas import TRAINING_COLUMNS
from .training import category_counts

CATEGORIES_DDL = "cat_key string, n_products bigint"
PAIRS_DDL = "pim_category_id string, keyword string, n bigint"
NAMES_DDL = ("vendor_key string, pim_category_id string, name_at bigint, pim_category_name string, "
             "path_at bigint, pim_category_path string")

_COLS = q.cols(TRAINING_COLUMNS)
_ARTICLE = q.falsy_key("article_id", "article_id_falsy")


def record_changes(before: DataFrame, after: DataFrame, new: DataFrame) -> DataFrame:
    """Training records with ``sign``: -1 for those of one vendor's partition that a merge took
    out, +1 for those it put in.

    ``before`` and ``after`` are the partition around the merge, ``new`` the extracted records.
    An article that is in no new record and once in the partition is left as it was; articles
    that were there more than once, or without a key, come with both signs in full. A partition
    that never changes hands costs nothing but the keys of the delivery.
    """
    spark = before.sparkSession
    touched = q.run(spark, f"""
        SELECT _k FROM (SELECT {_ARTICLE} AS _k, true AS delivered FROM {{n}}
                        UNION ALL SELECT {_ARTICLE} AS _k, false AS delivered FROM {{b}})
        GROUP BY _k HAVING bool_or(delivered) OR count(1) > 1 OR _k = ''""", n=new, b=before)
    return q.run(spark, f"""
        SELECT r.* FROM (SELECT {_COLS}, -1 AS sign FROM {{b}} UNION ALL SELECT {_COLS}, 1 AS sign FROM {{a}}) r
        LEFT SEMI JOIN {{t}} t ON {q.falsy_key('r.article_id', 'r.article_id_falsy')} = t._k""",
                 b=before, a=after, t=touched)


def _occurrences(records: str, sign: str) -> str:
    return f"""(SELECT pim_category_id, {q.strip_word('_raw')} AS keyword, n
                FROM (SELECT pim_category_id, {sign} AS n, explode_outer(keywords) AS _raw
                      FROM {records} WHERE NOT coalesce(pim_category_id_falsy, false))
                WHERE {q.visible_word('_raw')})"""


def full_counts(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``categories, pairs`` of a whole record set: the start of the incremental tables."""
    pairs = q.run(records.sparkSession, f"""
        SELECT pim_category_id, keyword, cast(sum(n) AS bigint) AS n FROM {_occurrences('{r}', '1')}
        GROUP BY pim_category_id, keyword""", r=records)
    return category_counts(records), pairs


def updated_categories(categories: DataFrame, changes: DataFrame) -> DataFrame:
    """Products per category after the signed ``changes``; an emptied category has no row."""
    key = q.strip("pim_category_id")
    return q.run(categories.sparkSession, f"""
        SELECT cat_key, cast(sum(n_products) AS bigint) AS n_products
        FROM (SELECT cat_key, n_products FROM {{c}}
              UNION ALL SELECT {key} AS cat_key, sign AS n_products FROM {{d}}
                        WHERE {key} IS NOT NULL AND {key} <> '')
        GROUP BY cat_key HAVING sum(n_products) <> 0""", c=categories, d=changes)


def updated_pairs(pairs: DataFrame, changes: DataFrame) -> DataFrame:
    """Keyword occurrences after the signed ``changes``. The changes combine before the shuffle
    like any count; a pair whose last occurrence went has no row. Null categories stay."""
    return q.run(pairs.sparkSession, f"""
        SELECT pim_category_id, keyword, cast(sum(n) AS bigint) AS n
        FROM (SELECT pim_category_id, keyword, n FROM {{p}}
              UNION ALL SELECT pim_category_id, keyword, n FROM {_occurrences('{d}', 'sign')})
        GROUP BY pim_category_id, keyword HAVING sum(n) <> 0""", p=pairs, d=changes)


def vendor_names(records: DataFrame) -> DataFrame:
    """``names`` rows of the records' vendors. The records at the first positions are found on
    (vendor, category, position), so a hot category is spread over its positions."""
    spark = records.sparkSession
    narrow = q.run(spark, f"""
        SELECT {q.falsy_key('vendor_short_name', None)} AS vendor_key, pim_category_id, ordinal,
               pim_category_name, pim_category_path
        FROM {{r}} WHERE pim_category_id IS NOT NULL AND NOT coalesce(pim_category_id_falsy, false)""", r=records)
    first = q.run(spark, """
        SELECT vendor_key, pim_category_id, f.kind, f.at FROM (
          SELECT vendor_key, pim_category_id,
                 min(ordinal) FILTER (WHERE pim_category_name IS NOT NULL) AS name_at,
                 min(ordinal) FILTER (WHERE pim_category_path IS NOT NULL) AS path_at
          FROM {n} GROUP BY vendor_key, pim_category_id)
        LATERAL VIEW inline(array(named_struct('kind', 'name', 'at', name_at),
                                  named_struct('kind', 'path', 'at', path_at))) f""", n=narrow)
    return q.run(spark, """
        SELECT f.vendor_key, f.pim_category_id,
               max(CASE WHEN f.kind = 'name' THEN f.at END) AS name_at,
               max(CASE WHEN f.kind = 'name' THEN n.pim_category_name END) AS pim_category_name,
               max(CASE WHEN f.kind = 'path' THEN f.at END) AS path_at,
               max(CASE WHEN f.kind = 'path' THEN n.pim_category_path END) AS pim_category_path
        FROM {f} f LEFT JOIN {n} n ON f.vendor_key = n.vendor_key AND f.pim_category_id = n.pim_category_id
                                  AND f.at = n.ordinal
        GROUP BY f.vendor_key, f.pim_category_id""", f=first, n=narrow)


def usable(categories: DataFrame, min_products: int) -> DataFrame:
    return q.run(categories.sparkSession,
                 f"SELECT cat_key FROM {{c}} WHERE n_products >= {int(min_products)}", c=categories)


def usable_pairs(pairs: DataFrame, categories: DataFrame, min_products: int) -> DataFrame:
    """The pairs whose category reaches the threshold."""
    return q.run(pairs.sparkSession, f"""
        SELECT p.* FROM {{p}} p LEFT SEMI JOIN {{u}} u ON {q.strip_word('p.pim_category_id')} = u.cat_key""",
                 p=pairs, u=usable(categories, min_products))


def category_lookup(names: DataFrame, categories: DataFrame, min_products: int) -> DataFrame:
    """First non-null name and path per raw usable category, in dataset order over all vendors:
    a row per vendor and category goes in."""
    return q.run(names.sparkSession, f"""
        SELECT n.pim_category_id, min(struct(name_at, pim_category_name))
                 FILTER (WHERE name_at IS NOT NULL).pim_category_name AS pim_category_name,
               min(struct(path_at, pim_category_path))
                 FILTER (WHERE path_at IS NOT NULL).pim_category_path AS pim_category_path
        FROM {{n}} n LEFT SEMI JOIN {{u}} u ON {q.strip('n.pim_category_id')} = u.cat_key
        GROUP BY n.pim_category_id""", n=names, u=usable(categories, min_products))
