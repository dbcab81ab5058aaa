"""Keyword statistics: occurrences, pair counts, totals per keyword, vendor usage.

Counts are occurrences (a keyword twice in one product counts twice) and are
case-sensitive. Every aggregate is a hash aggregate with a map-side partial step,
so a keyword present in a third of all products reaches the shuffle as one row per
(task, category).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import sqltext as q


def keyword_occurrences(records: DataFrame) -> DataFrame:
    """(pim_category_id, article_id, keyword) for every keyword of the records.

    Keywords are stripped after the explode, so normalized lists pass unchanged and raw
    lists are normalized on the fly (no per-list lambda).
    """
    return q.run(records.sparkSession, f"""
        SELECT pim_category_id, article_id, keyword
        FROM (SELECT pim_category_id, article_id, {q.strip_word('_raw')} AS keyword
              FROM (SELECT pim_category_id, article_id, explode_outer(keywords) AS _raw FROM {{r}})
              WHERE {q.visible_word('_raw')})""", r=records)


def _stripped_keywords(records: DataFrame) -> DataFrame:
    return q.run(records.sparkSession, f"""
        SELECT pim_category_id, keyword FROM (
          SELECT pim_category_id, {q.strip_word('_raw')} AS keyword
          FROM (SELECT pim_category_id, explode_outer(keywords) AS _raw FROM {{r}})
              WHERE {q.visible_word('_raw')})""", r=records)


def keyword_pairs(records: DataFrame) -> DataFrame:
    """Distinct (pim_category_id, keyword) of a record set (keywords stripped)."""
    return q.run(records.sparkSession, "SELECT DISTINCT pim_category_id, keyword FROM {o}",
                 o=_stripped_keywords(records))


def keyword_totals(occurrences: DataFrame) -> DataFrame:
    """train_total_count: occurrences per keyword over all categories."""
    return q.run(occurrences.sparkSession,
                 "SELECT keyword, count(1) AS train_total_count FROM {o} GROUP BY keyword",
                 o=occurrences)


def keyword_stats(occurrences: DataFrame) -> DataFrame:
    """Per pair: inside_count, train_total_count, hard_outside_count.

    The keyword total is a window sum over the (already aggregated) pairs: one scan of
    the occurrences instead of two aggregates and a join; the window partition of a
    keyword holds at most one row per category.
    """
    spark = occurrences.sparkSession
    inside = q.run(spark, """
        SELECT pim_category_id, keyword, count(1) AS inside_count
        FROM {o} GROUP BY pim_category_id, keyword""", o=occurrences)
    return q.run(spark, """
        SELECT pim_category_id, keyword, inside_count, train_total_count,
               train_total_count - inside_count AS hard_outside_count
        FROM (SELECT pim_category_id, keyword, inside_count,
                     sum(inside_count) OVER (PARTITION BY keyword) AS train_total_count
              FROM {i})""", i=inside)


def vendor_keyword_stats(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The vendor's usage: (pair, vendor_inside_count) and (keyword, vendor_total_count).

    All of the vendor's matches count, trusted or not, with or without article id; a
    NULL category stays a group of its own, which only adds to the keyword total.
    The total is a second-level aggregate over the pair counts.
    """
    spark = products.sparkSession
    inside = q.run(spark, """
        SELECT pim_category_id, keyword, count(1) AS vendor_inside_count
        FROM {o} GROUP BY pim_category_id, keyword""", o=_stripped_keywords(products))
    totals = q.run(spark, """
        SELECT keyword, sum(vendor_inside_count) AS vendor_total_count
        FROM {i} GROUP BY keyword""", i=inside)
    return inside, totals
