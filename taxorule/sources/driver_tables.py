"""Binding of the shared test tables to the rule-mining model.

``documents(doc_id, text, lang, source, n_chars)`` stands in for product data:

* ``source = 'src<n>'``: n < 10 is vendor ``vendorA`` (the run's vendor), else ``vendorB``;
* ``article_id = doc_id``; ``description_short`` = the text;
* keywords = the text split on ASCII whitespace ``[ \\t\\n\\r\\f]+``;
* vendorA rows with ``doc_id % 10 = 0`` are untrusted ``ai_suggestion`` matches whose
  category is rotated (en->fr, fr->de, de->es, else->en); all others are trusted
  ``existing_category_match`` with category = ``lang``;
* the existing stable dataset is every vendorB row, ordered by ``doc_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import TRUSTED_SOURCE
from ..functions import sqltext as q
from ..session import spread

# Fixed values of the binding.
RUN_VENDOR = "vendorA"
OTHER_VENDOR = "vendorB"
UNTRUSTED_SOURCE = "ai_suggestion"
STALE_DESCRIPTION = "stale"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_ROTATED = ("(CASE WHEN lang = 'en' THEN 'fr' WHEN lang = 'fr' THEN 'de' "
            "WHEN lang = 'de' THEN 'es' ELSE 'en' END)")


def bound_documents(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """One row per document with every model attribute except the keyword list."""
    text = ", text" if with_text else ""
    vendor = (f"CASE WHEN cast(substring(source, 4) AS int) < 10 THEN {q.lit(RUN_VENDOR)} "
              f"ELSE {q.lit(OTHER_VENDOR)} END")
    return q.run(spark, f"""
        WITH d AS (
          SELECT doc_id, lang, source{text}, {vendor} AS vendor_short_name FROM {{docs}}),
        r AS (
          SELECT *, (vendor_short_name = {q.lit(RUN_VENDOR)} AND doc_id % 10 = 0) AS _untrusted FROM d),
        c AS (
          SELECT *, CASE WHEN _untrusted THEN {_ROTATED} ELSE lang END AS pim_category_id FROM r)
        SELECT doc_id, lang, source{text}, vendor_short_name,
               CASE WHEN _untrusted THEN {q.lit(UNTRUSTED_SOURCE)} ELSE {q.lit(TRUSTED_SOURCE)} END
                 AS assignment_source,
               pim_category_id, upper(pim_category_id) AS pim_category_name,
               concat('Products/', upper(pim_category_id)) AS pim_category_path,
               source AS vendor_category_id, upper(source) AS vendor_category_name,
               concat(vendor_short_name, '/', source) AS vendor_category_path,
               cast(doc_id AS string) AS article_id, doc_id AS ordinal
        FROM c""", docs=spread(read_table(spark, sf_dir, "documents"), "doc_id"))


def _record_sql(where: str, extra: str = "", description: str = "text") -> str:
    return f"""
        SELECT pim_category_id, pim_category_name, pim_category_path, vendor_short_name,
               vendor_category_id, vendor_category_name, vendor_category_path, article_id,
               {description} AS description_short, {q.split_keywords('text')} AS keywords,
               array(named_struct('system', 'LANG', 'code', lang)) AS class_codes, ordinal,
               false AS article_id_falsy, false AS pim_category_id_falsy{extra}
        FROM {{docs}} WHERE {where}"""


def vendor_products(spark: SparkSession, sf_dir: str, vendor: str = RUN_VENDOR) -> DataFrame:
    """The run vendor's flat match products (trusted and untrusted)."""
    text = _record_sql(f"vendor_short_name = {q.lit(vendor)}",
                       ", assignment_source, 0 AS vcat_pos, 0 AS match_pos, 0 AS product_pos")
    return q.run(spark, text, docs=bound_documents(spark, sf_dir))


def existing_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stable training dataset before this run: every vendorB record."""
    return q.run(spark, _record_sql(f"vendor_short_name = {q.lit(OTHER_VENDOR)}"),
                 docs=bound_documents(spark, sf_dir))


def merge_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing set of the merge check: vendorB plus stale copies of vendorA's src0/src1 rows."""
    stale = f"(vendor_short_name = {q.lit(RUN_VENDOR)} AND doc_id % 20 <= 1)"
    text = _record_sql(f"vendor_short_name = {q.lit(OTHER_VENDOR)} OR {stale}", "",
                       f"CASE WHEN {stale} THEN {q.lit(STALE_DESCRIPTION)} ELSE text END")
    return q.run(spark, text, docs=bound_documents(spark, sf_dir))


def earlier_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing set of the incremental checks: vendorB plus earlier versions of vendorA's src0/src1
    rows, under categories of their own."""
    docs = q.run(spark, f"""
        SELECT * EXCEPT (pim_category_id, pim_category_name, pim_category_path), _cat AS pim_category_id,
               upper(_cat) AS pim_category_name, concat('Products/', upper(_cat)) AS pim_category_path
        FROM (SELECT *, CASE WHEN vendor_short_name = {q.lit(RUN_VENDOR)}
                             THEN concat('earlier ', lang, doc_id % 3) ELSE pim_category_id END AS _cat
              FROM {{docs}} WHERE vendor_short_name = {q.lit(OTHER_VENDOR)} OR doc_id % 20 <= 1)""",
                 docs=bound_documents(spark, sf_dir))
    return q.run(spark, _record_sql("true"), docs=docs)


def match_document_lines(spark: SparkSession, sf_dir: str, vendor: str = RUN_VENDOR) -> DataFrame:
    """The vendor's match document as JSON Lines fragments (one product per line),
    rendered by Spark from the documents table: ``vendor_short_name, value, source``.

    Ids are JSON numbers and keyword lists keep raw split tokens (incl. the empty
    token a leading separator gives), so ingest coercion has real work to do.
    """
    return q.run(spark, f"""
        SELECT vendor_short_name,
               to_json(map(vendor_category_id, named_struct(
                 'vendor_category_name', vendor_category_name,
                 'vendor_category_path', vendor_category_path,
                 'pim_matches', array(named_struct(
                   'pim_category_id', pim_category_id, 'pim_category_name', pim_category_name,
                   'pim_category_path', pim_category_path, 'assignment_source', assignment_source,
                   'products', array(named_struct(
                     'article_id', doc_id, 'description_short', text,
                     'keywords', split(text, {q.SPLIT}),
                     'class_codes', array(named_struct('system', 'LANG', 'code', lang))))))))) AS value,
               concat('documents#', doc_id) AS source
        FROM {{docs}} WHERE vendor_short_name = {q.lit(vendor)}""", docs=bound_documents(spark, sf_dir))
