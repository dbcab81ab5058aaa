"""Queries of the incremental statistics over the documents binding, and their DuckDB statements.

The stable set before the delivery holds vendorB's documents and earlier copies of some of vendorA's
(``doc_id % 20 <= 1``) under another category; vendorA's delivery replaces some of them, leaves
the untrusted ones, and adds the rest. The statements recount everything in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import sqltext as q
from ..operators import incremental as inc
from ..operators import training as tr
from ..sources import driver_tables as dt
from .oracle import ORACLE_BASE

#: Category threshold of the queries: some categories pass it only before or only after.
MIN_PRODUCTS = 40


class _Delivery:
    """One vendor's partition around a merge, and the counts before and after it."""

    def __init__(self, spark, sf_dir: str):
        earlier = dt.earlier_training(spark, sf_dir)
        mine = q.run(spark, f"SELECT * FROM {{e}} WHERE vendor_short_name = {q.lit(dt.RUN_VENDOR)}", e=earlier)
        new = tr.extract_training(dt.vendor_products(spark, sf_dir))
        changes = inc.record_changes(mine, tr.merge_stable(mine, new), new)
        self.categories, self.pairs = inc.full_counts(earlier)
        self.names = inc.vendor_names(earlier)
        self.now_categories = inc.updated_categories(self.categories, changes)
        self.now_pairs = inc.updated_pairs(self.pairs, changes)


def q_incremental_categories(spark, sf_dir: str) -> DataFrame:
    """Products per category before and after the delivery, and who crosses the threshold."""
    d = _Delivery(spark, sf_dir)
    return q.run(spark, f"""
        SELECT cat_key, coalesce(b.n_products, 0) AS n_before, coalesce(a.n_products, 0) AS n_after,
               coalesce(b.n_products, 0) < {MIN_PRODUCTS} AND coalesce(a.n_products, 0) >= {MIN_PRODUCTS} AS enters,
               coalesce(b.n_products, 0) >= {MIN_PRODUCTS} AND coalesce(a.n_products, 0) < {MIN_PRODUCTS} AS leaves
        FROM {{b}} b FULL OUTER JOIN {{a}} a USING (cat_key)""", b=d.categories, a=d.now_categories)


def q_incremental_pairs(spark, sf_dir: str) -> DataFrame:
    """Occurrences of every training pair after the delivery, from the counts before and the signed changes."""
    d = _Delivery(spark, sf_dir)
    return inc.usable_pairs(d.now_pairs, d.now_categories, MIN_PRODUCTS)


def q_incremental_names(spark, sf_dir: str) -> DataFrame:
    """Name and path of each usable category: the other vendors' rows as they were, the delivering vendor's anew."""
    d = _Delivery(spark, sf_dir)
    earlier = dt.earlier_training(spark, sf_dir)
    mine = q.run(spark, f"SELECT * FROM {{e}} WHERE vendor_short_name = {q.lit(dt.RUN_VENDOR)}", e=earlier)
    new = tr.extract_training(dt.vendor_products(spark, sf_dir))
    now = inc.vendor_names(tr.merge_stable(mine, new)).unionByName(
        q.run(spark, f"SELECT * FROM {{n}} WHERE vendor_key <> {q.lit(dt.RUN_VENDOR)}", n=d.names))
    return inc.category_lookup(now, d.now_categories, MIN_PRODUCTS)


INCREMENTAL_QUERIES = {
    "incremental_categories": q_incremental_categories,
    "incremental_pairs": q_incremental_pairs,
    "incremental_names": q_incremental_names,
}

_EARLIER = """,
earlier AS (
  SELECT doc_id, vendor_short_name, article_id,
         CASE WHEN vendor_short_name = 'vendorA' THEN 'earlier ' || lang || (doc_id % 3)::VARCHAR ELSE pim_category_id END
           AS pim_category_id
  FROM recs WHERE vendor_short_name = 'vendorB' OR doc_id % 20 <= 1),
after AS (
  SELECT * FROM earlier WHERE vendor_short_name <> 'vendorA' OR article_id NOT IN (SELECT article_id FROM new_recs)
  UNION ALL SELECT doc_id, vendor_short_name, article_id, pim_category_id FROM new_recs),
bcat AS (SELECT pim_category_id AS cat_key, count(*) AS n FROM earlier GROUP BY 1),
acat AS (SELECT pim_category_id AS cat_key, count(*) AS n FROM after GROUP BY 1)
"""

INCREMENTAL_SQL = {
    "incremental_categories": ORACLE_BASE + _EARLIER + f"""
SELECT cat_key, coalesce(b.n, 0) AS n_before, coalesce(a.n, 0) AS n_after,
       coalesce(b.n, 0) < {MIN_PRODUCTS} AND coalesce(a.n, 0) >= {MIN_PRODUCTS} AS enters,
       coalesce(b.n, 0) >= {MIN_PRODUCTS} AND coalesce(a.n, 0) < {MIN_PRODUCTS} AS leaves
FROM bcat b FULL OUTER JOIN acat a USING (cat_key)""",
    "incremental_pairs": ORACLE_BASE + _EARLIER + f"""
SELECT a.pim_category_id, k.keyword, count(*) AS n FROM after a JOIN kw k USING (doc_id)
WHERE a.pim_category_id IN (SELECT cat_key FROM acat WHERE n >= {MIN_PRODUCTS}) GROUP BY 1, 2""",
    "incremental_names": ORACLE_BASE + _EARLIER + f"""
SELECT cat_key AS pim_category_id, upper(cat_key) AS pim_category_name, 'Products/' || upper(cat_key) AS pim_category_path
FROM acat WHERE n >= {MIN_PRODUCTS}""",
}
