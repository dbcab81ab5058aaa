"""Rule scoring: global candidates, vendor support, status, proposals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import (DEFAULT_THRESHOLDS, RULE_FIELD_NAME, RULE_OPERATOR, STATUS_NEW,
                      STATUS_NOT_IMPACTED, STATUS_SUPPORTED, STATUS_VIOLATED, Thresholds)
from ..functions import sqltext as q
from ..schemas import COUNT_COLUMNS, SCORED_COLUMNS

_SCORED = q.cols(SCORED_COLUMNS)


def _global_candidate(th: Thresholds) -> str:
    return f"(inside_count >= {int(th.min_inside)} AND hard_outside_count <= {int(th.max_hard_outside)})"


def _classified(source: str, th: Thresholds) -> str:
    """SQL: flags and vendor_status over a relation (SQL text) carrying the six counts
    and ``known_in_previous_training`` (first matching status wins). Nested subqueries
    rather than a WITH chain: plans stay plain projections for later re-analysis."""
    f1 = f"""(SELECT *, vendor_total_count > 0 AS has_vendor_usage,
                     {_global_candidate(th)} AS global_candidate
              FROM {source}) f1"""
    f2 = f"""(SELECT *,
                     global_candidate AND vendor_inside_count >= {int(th.min_vendor_inside)}
                       AND vendor_outside_count <= {int(th.max_vendor_outside)} AS vendor_supports,
                     global_candidate AND vendor_outside_count > {int(th.max_vendor_outside)} AS vendor_violates,
                     global_candidate AND NOT known_in_previous_training AS is_new_rule
              FROM {f1}) f2"""
    return f"""
        SELECT {_SCORED.replace('vendor_status', '')}
               CASE WHEN is_new_rule AND vendor_supports THEN {q.lit(STATUS_NEW)}
                    WHEN global_candidate AND vendor_supports THEN {q.lit(STATUS_SUPPORTED)}
                    WHEN global_candidate AND vendor_violates THEN {q.lit(STATUS_VIOLATED)}
                    WHEN global_candidate AND NOT has_vendor_usage THEN {q.lit(STATUS_NOT_IMPACTED)}
               END AS vendor_status
        FROM {f2}"""


def classify(stats: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Flags and vendor_status of scored pairs."""
    return q.run(stats.sparkSession, _classified("{s}", th), s=stats)


def role_records(training: DataFrame | None = None, vendor: DataFrame | None = None,
                 previous: DataFrame | None = None) -> DataFrame:
    """Stack the three keyword sources as ``pim_category_id, keywords`` + role flags.

    A source row that plays several roles for one category may also be given once
    with several flags set (the documents binding does this); counts are the same.
    """
    parts, dfs = [], {}
    for name, df, flags in (("t", training, (1, 0, 0)), ("v", vendor, (0, 1, 0)), ("p", previous, (0, 0, 1))):
        if df is not None:
            dfs[name] = df
            parts.append(f"SELECT pim_category_id, keywords, {flags[0]} AS in_training, "
                         f"{flags[1]} AS in_vendor, {flags[2]} AS in_previous FROM {{{name}}}")
    spark = next(iter(dfs.values())).sparkSession
    return q.run(spark, " UNION ALL ".join(parts), **dfs)


def pair_counts(records: DataFrame) -> DataFrame:
    """Occurrences per (category, keyword) of every role, in one pass:
    ``explode -> strip -> groupBy(pair)`` with a map-side partial aggregate, so a keyword
    used by a third of all products reaches the shuffle as one row per (task, category).
    Keys are the raw category strings, exactly as the job's joins matched them.
    ``explode_outer`` because of a plain ``explode`` Catalyst infers ``size(...) > 0`` and
    evaluates the split behind the list a second time; the null it adds is filtered."""
    return q.run(records.sparkSession, f"""
        SELECT pim_category_id, keyword,
               cast(sum(in_training) AS bigint) AS inside_count,
               cast(sum(in_vendor) AS bigint) AS vendor_inside_count,
               cast(sum(in_previous) AS bigint) AS previous_count
        FROM (SELECT pim_category_id, {q.strip_word('_raw')} AS keyword, in_training, in_vendor, in_previous
              FROM (SELECT pim_category_id, in_training, in_vendor, in_previous,
                           explode_outer(keywords) AS _raw FROM {{r}})
              WHERE {q.visible_word('_raw')})
        GROUP BY pim_category_id, keyword""", r=records)


def role_pair_counts(training: DataFrame, vendor: DataFrame, previous: DataFrame) -> DataFrame:
    """``pair_counts`` from counts per role: ``training`` and ``previous`` are
    ``pim_category_id, keyword, n``, ``vendor`` is the pair counts of the vendor's records."""
    return q.run(training.sparkSession, """
        SELECT pim_category_id, keyword, cast(sum(inside_count) AS bigint) AS inside_count,
               cast(sum(vendor_inside_count) AS bigint) AS vendor_inside_count,
               cast(sum(previous_count) AS bigint) AS previous_count
        FROM (SELECT pim_category_id, keyword, n AS inside_count, 0L AS vendor_inside_count, 0L AS previous_count FROM {t}
              UNION ALL SELECT pim_category_id, keyword, 0L, vendor_inside_count, 0L FROM {v}
              UNION ALL SELECT pim_category_id, keyword, 0L, 0L, n FROM {p})
        GROUP BY pim_category_id, keyword""", t=training, v=vendor, p=previous)


def score_pairs(pairs: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS,
                candidates_only: bool = True) -> DataFrame:
    """Keyword totals by a keyword-partitioned window over the pair counts (a keyword's
    partition holds at most one row per category), then flags and status."""
    spark = pairs.sparkSession
    # previous-only pairs add nothing to either total
    totals = q.run(spark, """
        SELECT pim_category_id, keyword, inside_count, vendor_inside_count,
               previous_count > 0 AS known_in_previous_training,
               sum(inside_count) OVER (PARTITION BY keyword) AS train_total_count,
               sum(vendor_inside_count) OVER (PARTITION BY keyword) AS vendor_total_count
        FROM {p} WHERE inside_count > 0 OR vendor_inside_count > 0""", p=pairs)
    cand = f"WHERE {_global_candidate(th)}" if candidates_only else ""
    stats = f"""(SELECT * FROM (
                   SELECT *, train_total_count - inside_count AS hard_outside_count,
                          vendor_total_count - vendor_inside_count AS vendor_outside_count
                   FROM {{t}} WHERE inside_count > 0) s0 {cand}) s1"""
    return q.run(spark, _classified(stats, th), t=totals)


def pair_scores(records: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS,
                candidates_only: bool = True) -> DataFrame:
    """Score every training pair from role-tagged records in one aggregation.

    This is the same as the job's four aggregates and joins (inside, totals, vendor
    inside, vendor totals, previous pairs), in two shuffles and with no join.
    """
    return score_pairs(pair_counts(records), th, candidates_only)


def score_rules(stats: DataFrame, vendor_inside: DataFrame, vendor_totals: DataFrame,
                previous_pairs: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS,
                candidates_only: bool = True) -> DataFrame:
    """Join form of the scoring, for statistics computed separately.

    The candidate test only reads training counts, so it runs before the three left
    joins and they see the (small) candidate set.
    """
    cand = f"WHERE {_global_candidate(th)}" if candidates_only else ""
    joined = f"""(SELECT *, vendor_total_count - vendor_inside_count AS vendor_outside_count FROM (
          SELECT s.pim_category_id, s.keyword, s.inside_count, s.train_total_count, s.hard_outside_count,
                 cast(coalesce(vi.vendor_inside_count, 0) AS bigint) AS vendor_inside_count,
                 cast(coalesce(vt.vendor_total_count, 0) AS bigint) AS vendor_total_count,
                 prev.keyword IS NOT NULL AS known_in_previous_training
          FROM (SELECT * FROM {{s}} {cand}) s
          LEFT JOIN {{vi}} vi ON vi.pim_category_id = s.pim_category_id AND vi.keyword = s.keyword
          LEFT JOIN {{vt}} vt ON vt.keyword = s.keyword
          LEFT JOIN (SELECT DISTINCT pim_category_id, keyword FROM {{p}}) prev
            ON prev.pim_category_id = s.pim_category_id AND prev.keyword = s.keyword) j) k"""
    return q.run(stats.sparkSession, _classified(joined, th),
                 s=stats, vi=vendor_inside, vt=vendor_totals, p=previous_pairs)


def strict_candidates(scored: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Pairs passing all four thresholds at once (the job's conservative probe)."""
    return q.run(scored.sparkSession, f"""
        SELECT * FROM {{s}} WHERE {_global_candidate(th)}
          AND vendor_inside_count >= {int(th.min_vendor_inside)}
          AND vendor_outside_count <= {int(th.max_vendor_outside)}""", s=scored)


def rule_proposals(scored: DataFrame, dim: DataFrame) -> DataFrame:
    """Publishable rules: global candidates with a status, as rule-proposal rows.

    The category lookup is category-level against pair-level rows: AQE broadcasts it
    from its measured size, or falls back to a shuffle join.
    """
    stats = ", ".join(f"'{c}', cast(coalesce(s.{c}, 0) AS bigint)" for c in COUNT_COLUMNS)
    return q.run(scored.sparkSession, f"""
        SELECT s.pim_category_id, d.pim_category_name,
               {q.lit(RULE_FIELD_NAME)} AS field_name, {q.lit(RULE_OPERATOR)} AS operator,
               array(s.keyword) AS values_include, cast(array() AS array<string>) AS values_exclude,
               named_struct({stats}, 'vendor_status', s.vendor_status) AS stats
        FROM {{s}} s LEFT JOIN (SELECT pim_category_id, pim_category_name FROM {{d}}) d
          ON s.pim_category_id = d.pim_category_id
        WHERE s.global_candidate AND s.vendor_status IS NOT NULL""", s=scored, d=dim)


def status_summary(proposals: DataFrame) -> DataFrame:
    return q.run(proposals.sparkSession, """
        SELECT stats.vendor_status AS vendor_status, count(1) AS n_rules
        FROM {p} GROUP BY stats.vendor_status""", p=proposals)
