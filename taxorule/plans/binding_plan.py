"""The rule-mining job composed over the documents binding (see sources.driver_tables).

Every function takes ``(spark, sf_dir)`` and returns a DataFrame; nothing is collected.
Intermediate steps are shared Python functions, so each driver query is exactly the slice
of the job it names. Building a query runs no Spark job, except for the two on the
reference (``reference_rule_counts``, ``rule_changes``): like a production run they hand
pair counts, category lookup and proposals over as written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT_THRESHOLDS, RULE_FIELD_NAME, RULE_OPERATOR, Thresholds
from ..functions import sqltext as q
from ..operators import keywords as kw
from ..operators import reference as ref
from ..operators import scoring as sc
from ..operators import training as tr
from ..schemas import STRING_FIELDS
from ..session import cut_lineage, word_tasks
from ..sources import driver_tables as dt


def _memo(method):
    """Build a run's derived plan once (plans are lazy and pure; building costs analysis)."""
    def wrapper(self):
        cache = self.__dict__.setdefault("_plans", {})
        if method.__name__ not in cache:
            cache[method.__name__] = method(self)
        return cache[method.__name__]
    wrapper.__name__ = method.__name__
    wrapper.__doc__ = method.__doc__
    return wrapper


class BindingRun:
    """Lazy DataFrames of one vendor run over the documents binding; each step's plan
    is built on first use only (building a plan costs analysis time)."""

    def __init__(self, spark: SparkSession, sf_dir: str, th: Thresholds = DEFAULT_THRESHOLDS):
        self.spark, self.sf_dir, self.th = spark, sf_dir, th

    @classmethod
    def build(cls, spark: SparkSession, sf_dir: str, th: Thresholds = DEFAULT_THRESHOLDS):
        return cls(spark, sf_dir, th)

    @property
    @_memo
    def products(self) -> DataFrame:
        return dt.vendor_products(self.spark, self.sf_dir)

    @property
    @_memo
    def existing(self) -> DataFrame:
        return dt.existing_training(self.spark, self.sf_dir)

    @property
    @_memo
    def new(self) -> DataFrame:
        return tr.extract_training(self.products)

    @property
    @_memo
    def merged(self) -> DataFrame:
        return tr.merge_stable(self.existing, self.new)

    @property
    @_memo
    def subset(self) -> DataFrame:
        return tr.training_subset(self.merged, self.th.min_products)

    @property
    @_memo
    def previous(self) -> DataFrame:
        return tr.training_subset(self.existing, self.th.min_products)

    @_memo
    def scored(self) -> DataFrame:
        return sc.score_pairs(self.pair_counts(), self.th)

    @_memo
    def pair_counts(self) -> DataFrame:
        """Pair counts of all three roles with late materialization of the keyword lists.

        In the binding a record's keywords are a function of its document, and
        (vendor, article) names the document. So the training and previous roles
        are decided on narrow key columns (the merge and both category subsets prune
        to keys), joined once onto the documents, and each text is tokenized once
        with all its role flags -- instead of once per role.
        """
        roles = q.run(self.spark, """
            SELECT coalesce(t.vendor_short_name, p.vendor_short_name) AS vendor_short_name,
                   coalesce(t.article_id, p.article_id) AS article_id,
                   coalesce(t.pim_category_id, p.pim_category_id) AS pim_category_id,
                   CASE WHEN t.article_id IS NOT NULL THEN 1 ELSE 0 END AS in_training,
                   CASE WHEN p.article_id IS NOT NULL THEN 1 ELSE 0 END AS in_previous
            FROM (SELECT DISTINCT vendor_short_name, article_id, pim_category_id FROM {t}) t
            FULL OUTER JOIN (SELECT DISTINCT vendor_short_name, article_id, pim_category_id FROM {p}) p
              ON t.vendor_short_name = p.vendor_short_name AND t.article_id = p.article_id
             AND t.pim_category_id = p.pim_category_id""", t=self.subset, p=self.previous)
        records = q.run(self.spark, f"""
            SELECT d.pim_category_id, split(d.text, {q.SPLIT}) AS keywords,
                   coalesce(r.in_training, 0) AS in_training,
                   CASE WHEN d.vendor_short_name = {q.lit(dt.RUN_VENDOR)} THEN 1 ELSE 0 END AS in_vendor,
                   coalesce(r.in_previous, 0) AS in_previous
            FROM {{d}} d LEFT JOIN {{r}} r
              ON d.vendor_short_name = r.vendor_short_name AND d.article_id = r.article_id
             AND d.pim_category_id = r.pim_category_id
            WHERE coalesce(r.in_training, 0) + coalesce(r.in_previous, 0) > 0
               OR d.vendor_short_name = {q.lit(dt.RUN_VENDOR)}""",
                        d=dt.bound_documents(self.spark, self.sf_dir), r=roles)
        return sc.pair_counts(records)

    def late(self, records: DataFrame) -> DataFrame:
        """``records`` with late-materialized keyword lists: membership from their (narrow)
        plan, keyword tokens straight from the documents (raw; consumers strip after
        exploding). Valid because a binding record's keywords are its document's.

        The documents are dealt out by the join's keys to as many tasks as their words need."""
        keys = q.run(self.spark, "SELECT DISTINCT vendor_short_name, article_id, pim_category_id FROM {t}",
                     t=records)
        docs = dt.bound_documents(self.spark, self.sf_dir).repartition(
            self.word_tasks(), "vendor_short_name", "article_id", "pim_category_id")
        return q.run(self.spark, f"""
            SELECT d.pim_category_id, d.article_id, split(d.text, {q.SPLIT}) AS keywords
            FROM {{d}} d LEFT SEMI JOIN {{k}} k
              ON d.vendor_short_name = k.vendor_short_name AND d.article_id = k.article_id
             AND d.pim_category_id = k.pim_category_id""",
                     d=docs, k=keys)

    @_memo
    def word_tasks(self) -> int:
        return word_tasks(dt.read_table(self.spark, self.sf_dir, "documents"))

    @_memo
    def subset_late(self) -> DataFrame:
        return self.late(self.subset)

    @_memo
    def scored_by_role(self) -> DataFrame:
        """The general form: each source's records stacked once per role."""
        return sc.pair_scores(sc.role_records(self.subset, self.products, self.previous), self.th)

    @_memo
    def pairs_cut(self) -> DataFrame:
        """The pair counts written to the shared checkpoint folder: the scoring and the
        reference steps after it read the written copy (shallow plans, one tokenization
        for current and previous statistics, and a lost executor does not send them
        back through it)."""
        return cut_lineage(self.pair_counts())

    @_memo
    def scored_cut(self) -> DataFrame:
        return sc.score_pairs(self.pairs_cut(), self.th)

    @_memo
    def dim(self) -> DataFrame:
        return tr.category_dim(self.subset)

    @_memo
    def dim_cut(self) -> DataFrame:
        return cut_lineage(self.dim())

    @_memo
    def proposals(self) -> DataFrame:
        return sc.rule_proposals(self.scored(), self.dim())

    @_memo
    def proposals_cut(self) -> DataFrame:
        """Written once: the categories, the rules and the diff of the reference read it."""
        return cut_lineage(sc.rule_proposals(self.scored_cut(), self.dim_cut()))

    @_memo
    def old_reference(self) -> tuple[DataFrame, DataFrame]:
        """Old reference of the binding: the global candidates of the previous subset alone."""
        cats = q.run(self.spark, f"""
            SELECT {q.strip('pim_category_id')} AS cat_key, pim_category_id, pim_category_name,
                   pim_category_path, cast(NULL AS string) AS vendor_mappings,
                   cast(NULL AS string) AS entry_json, cast(0 AS bigint) AS position
            FROM {{d}}""", d=tr.category_dim(self.previous))
        # the previous subset's own statistics come from the same pair counts
        stats = q.run(self.spark, """
            SELECT pim_category_id, keyword, inside_count,
                   sum(inside_count) OVER (PARTITION BY keyword) - inside_count AS hard_outside_count
            FROM (SELECT pim_category_id, keyword, previous_count AS inside_count FROM {p}
                  WHERE previous_count > 0)""", p=self.pairs_cut())
        rule = (f"named_struct('field_name', {q.lit(RULE_FIELD_NAME)}, 'values_include', array(keyword), "
                f"'values_exclude', cast(array() AS array<string>), 'operator', {q.lit(RULE_OPERATOR)})")
        rules = q.run(self.spark, f"""
            SELECT {q.strip('pim_category_id')} AS cat_key, cast(0 AS bigint) AS entry_position,
                   cast(0 AS bigint) AS rule_position, {q.lit(RULE_FIELD_NAME)} AS field_name,
                   {q.lit(RULE_OPERATOR)} AS operator, array(keyword) AS values_include,
                   cast(array() AS array<string>) AS values_exclude, to_json({rule}) AS rule_json
            FROM {{s}}
            WHERE inside_count >= {int(self.th.min_inside)}
              AND hard_outside_count <= {int(self.th.max_hard_outside)}""", s=stats)
        return cats, rules

    @_memo
    def new_reference(self) -> tuple[DataFrame, DataFrame]:
        old_cats, _ = self.old_reference()
        return ref.rebuild_reference(old_cats, self.proposals_cut(), self.dim_cut())


def _record_view(df: DataFrame) -> DataFrame:
    return q.run(df.sparkSession, f"""
        SELECT {q.cols(STRING_FIELDS)}, cast(size(keywords) AS bigint) AS n_keywords, ordinal
        FROM {{r}}""", r=df)


def _select(df: DataFrame, text: str) -> DataFrame:
    return q.run(df.sparkSession, f"SELECT {text} FROM {{x}}", x=df)


# ---- driver queries -------------------------------------------------------------

def q_vendor_match_products(spark, sf_dir):
    """Match-document ingest: the vendor's JSON fragments (rendered from documents) flattened."""
    from ..sources.match import match_products
    prods = match_products(dt.match_document_lines(spark, sf_dir))
    return _select(prods, """
        vendor_short_name, vendor_category_id, vendor_category_name, vendor_category_path,
        pim_category_id, pim_category_name, pim_category_path, assignment_source, article_id,
        description_short, cast(size(keywords) AS bigint) AS n_keywords,
        cast(size(class_codes) AS bigint) AS n_class_codes""")


def q_accepted_training(spark, sf_dir):
    run = BindingRun.build(spark, sf_dir)
    return _record_view(run.new)


def q_stable_merge(spark, sf_dir):
    products = dt.vendor_products(spark, sf_dir)
    merged = tr.merge_stable(dt.merge_existing(spark, sf_dir), tr.extract_training(products))
    return _record_view(merged)


def q_category_counts(spark, sf_dir):  # noqa: D103
    return tr.category_counts(BindingRun.build(spark, sf_dir).merged)


def q_usable_categories(spark, sf_dir):
    return tr.usable_categories(BindingRun.build(spark, sf_dir).merged, 100)


def q_training_subset(spark, sf_dir):
    return _record_view(BindingRun.build(spark, sf_dir).subset)


def q_keyword_occurrences(spark, sf_dir):
    run = BindingRun.build(spark, sf_dir)
    occ = kw.keyword_occurrences(run.subset_late())
    # nearly every (record, keyword) is another one: counted where they meet, in tasks of bounded size
    dealt = occ.repartition(run.word_tasks(), "pim_category_id", "article_id", "keyword")
    return q.run(spark, """
        SELECT pim_category_id, article_id, sum(n) AS n_occurrences, count(1) AS n_distinct_keywords
        FROM (SELECT pim_category_id, article_id, keyword, count(1) AS n
              FROM {o} GROUP BY pim_category_id, article_id, keyword)
        GROUP BY pim_category_id, article_id""", o=dealt)


def q_keyword_stats(spark, sf_dir):
    return kw.keyword_stats(kw.keyword_occurrences(BindingRun.build(spark, sf_dir).subset_late()))


def q_keyword_totals(spark, sf_dir):
    return kw.keyword_totals(kw.keyword_occurrences(BindingRun.build(spark, sf_dir).subset_late()))


def q_vendor_inside(spark, sf_dir):
    return kw.vendor_keyword_stats(dt.vendor_products(spark, sf_dir))[0]


def q_vendor_totals(spark, sf_dir):
    return kw.vendor_keyword_stats(dt.vendor_products(spark, sf_dir))[1]


def q_previous_pairs(spark, sf_dir):
    run = BindingRun.build(spark, sf_dir)
    return kw.keyword_pairs(run.late(run.previous))


def q_previous_pairs_min60(spark, sf_dir):
    """Previous pairs with a raised category minimum (the threshold branch at sf0.01)."""
    run = BindingRun.build(spark, sf_dir)
    return kw.keyword_pairs(run.late(tr.training_subset(run.existing, 60)))


def q_scored_candidates(spark, sf_dir):
    return BindingRun.build(spark, sf_dir).scored()


def q_scored_candidates_joins(spark, sf_dir):
    """The same scoring through the join form (separately computed statistics)."""
    run = BindingRun.build(spark, sf_dir)
    stats = kw.keyword_stats(kw.keyword_occurrences(run.subset))
    v_in, v_tot = kw.vendor_keyword_stats(run.products)
    return sc.score_rules(stats, v_in, v_tot, kw.keyword_pairs(run.previous), run.th)


def q_scored_candidates_by_role(spark, sf_dir):
    """The same scoring with every source stacked per role (no late materialization)."""
    return BindingRun.build(spark, sf_dir).scored_by_role()


def q_strict_candidates(spark, sf_dir):
    return sc.strict_candidates(BindingRun.build(spark, sf_dir).scored())


def q_rule_proposals(spark, sf_dir):
    p = BindingRun.build(spark, sf_dir).proposals()
    return _select(p, """pim_category_id, pim_category_name, field_name, operator,
        array_join(values_include, ',') AS values_include,
        array_join(values_exclude, ',') AS values_exclude, stats.*""")


def q_status_summary(spark, sf_dir):
    return sc.status_summary(BindingRun.build(spark, sf_dir).proposals())


def q_accepted_rules(spark, sf_dir):
    r = ref.accepted_rules(BindingRun.build(spark, sf_dir).proposals())
    return _select(r, """cat_key AS pim_category_id, field_name, operator,
        array_join(values_include, ',') AS values_include,
        array_join(values_exclude, ',') AS values_exclude""")


def q_category_dim(spark, sf_dir):
    return BindingRun.build(spark, sf_dir).dim()


def q_reference_rule_counts(spark, sf_dir):
    cats, rules = BindingRun.build(spark, sf_dir).new_reference()
    return ref.reference_rule_counts(cats, rules)


def q_rule_changes(spark, sf_dir):
    run = BindingRun.build(spark, sf_dir)
    old_cats, old_rules = run.old_reference()
    new_cats, new_rules = run.new_reference()
    ch = ref.rule_changes(old_cats, old_rules, new_cats, new_rules)
    return _select(ch, "pim_category_id, pim_category_name, change, signature AS rule")


QUERIES = {
    "vendor_match_products": q_vendor_match_products,
    "accepted_training": q_accepted_training,
    "stable_merge": q_stable_merge,
    "category_counts": q_category_counts,
    "usable_categories": q_usable_categories,
    "training_subset": q_training_subset,
    "keyword_occurrences": q_keyword_occurrences,
    "keyword_stats": q_keyword_stats,
    "keyword_totals": q_keyword_totals,
    "vendor_inside": q_vendor_inside,
    "vendor_totals": q_vendor_totals,
    "previous_pairs": q_previous_pairs,
    "previous_pairs_min60": q_previous_pairs_min60,
    "scored_candidates": q_scored_candidates,
    "scored_candidates_joins": q_scored_candidates_joins,
    "scored_candidates_by_role": q_scored_candidates_by_role,
    "strict_candidates": q_strict_candidates,
    "rule_proposals": q_rule_proposals,
    "status_summary": q_status_summary,
    "accepted_rules": q_accepted_rules,
    "category_dim": q_category_dim,
    "reference_rule_counts": q_reference_rule_counts,
    "rule_changes": q_rule_changes,
}
