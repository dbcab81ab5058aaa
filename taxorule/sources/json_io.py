"""JSON import / export in the job's original file formats.

* stable dataset: one JSON array of training records;
* mapping reference: one JSON array of category entries with nested
  ``mapping_methods``;
* proposals / change log: JSON Lines export with null fields kept.

Imports parse with VARIANT (schemaless) and explode the root array in parallel
after the parse; a root of the wrong type fails (or, for a lenient reference read,
yields nothing). A file too large to be one text is read in byte ranges, by many tasks,
and parsed element by element.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqltext as q
from ..schemas import STRING_FIELDS, TRAINING_COLUMNS
from .json_scan import BadRoot, oversized, root_members
from .match import json_dict_semantics


def _root_array(spark: SparkSession, path: str, what: str, lenient: bool, in_ranges: bool, copied: bool = True) -> DataFrame:
    """``position, item`` of the array that is the whole text of each file; of a large one, its
    elements are ``copied`` into a table if they are read more than once."""
    json_dict_semantics(spark)
    if in_ranges or oversized(spark, path):
        return _elements(spark, path, what, lenient, copied)
    raw = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("file_path"))
    if not lenient and raw.isEmpty():
        raise ValueError(f"{what} must be a JSON array and all of the text, not an empty file: {path}")
    # braces as escapes: the statement's own braces name its inputs
    wrapped = r"""try_parse_json(concat('\u007B"root":', value, ',"end_of_root":1\u007D'))"""
    wrong = (f"raise_error(concat({q.lit(what + ' must be a JSON array and all of the text: ')}, file_path))")
    return q.run(spark, f"""
        SELECT posexplode(CASE
                 WHEN items IS NOT NULL AND ended IS NOT NULL THEN items
                 {'' if lenient else f'ELSE {wrong}'} END) AS (position, item)
        FROM (SELECT value, file_path, w, {q.as_list("try_variant_get(w, '$.root', 'variant')")} AS items,
                     try_variant_get(w, '$.end_of_root', 'int') AS ended
              FROM (SELECT value, file_path, {wrapped} AS w FROM {{raw}}))""", raw=raw)


def _elements(spark: SparkSession, path: str, what: str, lenient: bool, copied: bool) -> DataFrame:
    """``_root_array`` of files whose elements are cut out by many tasks. Element numbers come from
    the counts of the byte ranges before, so first- and last-wins rules hold. For a lenient read
    every element is parsed once more beforehand: one that is malformed empties the whole file."""
    message = f"{what} must be a JSON array"
    nothing = "SELECT cast(NULL AS int) AS position, cast(NULL AS variant) AS item WHERE false"
    try:
        members = root_members(spark, path, "[", message, copied)
        rows = q.run(spark, f"""
            SELECT member AS position, CASE WHEN w IS NULL AND text IS NOT NULL {'' if lenient else f"""THEN raise_error(concat(
                     {q.lit(message + ' and all of the text: ')}, file_path)) WHEN false"""} THEN NULL
                   ELSE variant_get(w, '$.item', 'variant') END AS item
            -- a generator: a filter on the item would be evaluated with a parse of its own
            FROM {{m}} LATERAL VIEW OUTER explode(array(try_parse_json(concat('\\u007B"item":', text, '\\u007D')))) p AS w""",
                     m=members)
        if lenient and not rows.where("item IS NULL").isEmpty():
            return spark.sql(nothing)
        return rows
    except Exception as e:
        if lenient and ("BadRoot" in str(e) or isinstance(e, BadRoot) or "without empty members" in str(e)):
            return spark.sql(nothing)
        raise


def read_stable_json(spark: SparkSession, path: str, in_ranges: bool = False) -> DataFrame:
    """Stable dataset from its JSON array file into typed training records; ``in_ranges`` reads a
    small file the way of a large one."""
    rows = _root_array(spark, path, "stable training dataset", False, in_ranges, copied=False)
    fields = ", ".join(f"{q.as_text(f'r[{q.lit(c)}]')} AS {c}" for c in STRING_FIELDS)
    return q.run(spark, f"""
        SELECT {fields}, {q.extraction_keywords("r['keywords']")} AS keywords,
               {q.class_codes("r['class_codes']")} AS class_codes, cast(position AS bigint) AS ordinal,
               {q.is_falsy("r['article_id']")} AS article_id_falsy,
               {q.is_falsy("r['pim_category_id']")} AS pim_category_id_falsy
        FROM {{rows}} LATERAL VIEW OUTER explode(array({q.as_dict('item')})) d AS r WHERE r IS NOT NULL""",
                 rows=rows).select(*TRAINING_COLUMNS)


def _structured(v: str) -> str:
    return f"coalesce(schema_of_variant({v}) LIKE 'ARRAY%' OR schema_of_variant({v}) LIKE 'OBJECT%', false)"


def _values(v: str) -> str:
    """A rule's value list as the job iterated it: list -> str of each element (null: "None"),
    string -> its characters, object -> its keys, other falsy -> []; else NULL (rule ignored)."""
    return (f"(CASE WHEN {q.is_missing(v)} THEN cast(array() AS array<string>) "
            f"WHEN {q.as_list(v)} IS NOT NULL THEN transform({q.as_list(v)}, e -> coalesce({q.as_text('e')}, 'None')) "
            f"WHEN schema_of_variant({v}) = 'STRING' THEN "
            f"CASE WHEN {q.as_text(v)} = '' THEN cast(array() AS array<string>) ELSE split({q.as_text(v)}, '') END "
            f"WHEN {q.as_dict(v)} IS NOT NULL THEN map_keys({q.as_dict(v)}) "
            f"WHEN {q.is_falsy(v)} THEN cast(array() AS array<string>) END)")


def read_reference_json(spark: SparkSession, path: str, lenient: bool = False,
                        in_ranges: bool = False) -> tuple[DataFrame, DataFrame]:
    """Mapping reference file -> (categories, rules), flat.

    Entries that are not objects or lack a non-blank id are skipped. A rule is left out as
    malformed if it is not an object, if its field or operator is a list or an object, or if a
    value list cannot be iterated: it has no identity, so no change log may name it.
    ``lenient`` turns an unreadable file into an empty reference.
    """
    rows = _root_array(spark, path, "mapping reference", lenient, in_ranges)
    entries = q.run(spark, f"""
        SELECT {q.strip(q.as_text("e['pim_category_id']"))} AS cat_key, e, entry_json,
               cast(position AS bigint) AS position
        FROM (SELECT position, {q.as_dict('item')} AS e, to_json(item) AS entry_json FROM {{rows}})
        WHERE e IS NOT NULL""", rows=rows)
    cats = q.run(spark, f"""
        SELECT cat_key, {q.as_text("e['pim_category_id']")} AS pim_category_id,
               {q.as_text("e['pim_category_name']")} AS pim_category_name,
               {q.as_text("e['pim_category_path']")} AS pim_category_path,
               to_json(e['vendor_mappings']) AS vendor_mappings, entry_json, position
        FROM {{e}} WHERE cat_key IS NOT NULL AND cat_key <> ''""", e=entries)
    rules = q.run(spark, f"""
        SELECT * FROM (
          SELECT cat_key, entry_position, rule_position, {q.as_text("r['field_name']")} AS field_name,
                 {q.as_text("r['operator']")} AS operator, {_values("r['values_include']")} AS values_include,
                 {_values("r['values_exclude']")} AS values_exclude, rule_json
          FROM (SELECT cat_key, position AS entry_position, cast(i AS bigint) AS rule_position,
                       {q.as_dict('m')} AS r, to_json(m) AS rule_json
                FROM (SELECT cat_key, position, posexplode({q.as_list("e['mapping_methods']")}) AS (i, m) FROM {{e}}))
          WHERE r IS NOT NULL AND NOT {_structured("r['field_name']")} AND NOT {_structured("r['operator']")})
        WHERE values_include IS NOT NULL AND values_exclude IS NOT NULL""", e=entries)
    return cats, rules


_METHODS = ("array<struct<field_name:string,values_include:array<string>,"
            "values_exclude:array<string>,operator:string>>")


def reference_entries(categories: DataFrame, rules: DataFrame) -> DataFrame:
    """Nested export view: ``pim_category_id, entry`` per category, sorted by id text.

    ``entry`` is the JSON text of the whole old entry, fields unknown here included, with the
    category's current fields and its ``mapping_methods`` in place of the old ones. Only for
    writing the file format: a category's list is one value there, so its rules meet in one
    task; the flat rules table is what scales.
    """
    return q.run(categories.sparkSession, f"""
        SELECT c.pim_category_id,
               to_json(map_concat(
                 coalesce(map_filter(from_json(c.entry_json, 'map<string,variant>'), (k, v) -> k NOT IN (
                   'pim_category_id', 'pim_category_name', 'pim_category_path', 'vendor_mappings',
                   'mapping_methods')), cast(map() AS map<string,variant>)),
                 map('pim_category_id', coalesce(parse_json(to_json(
                         from_json(c.entry_json, 'map<string,variant>')['pim_category_id'])), cast(c.pim_category_id AS variant)),
                     'pim_category_name', cast(c.pim_category_name AS variant),
                     'pim_category_path', cast(c.pim_category_path AS variant),
                     'vendor_mappings', parse_json(coalesce(c.vendor_mappings, '[]')),
                     'mapping_methods', parse_json(to_json(coalesce(m.methods, cast(array() AS {_METHODS}))))))) AS entry
        FROM {{c}} c LEFT JOIN (
          SELECT cat_key, array_sort(collect_list(named_struct(
                   'field_name', field_name, 'values_include', values_include,
                   'values_exclude', values_exclude, 'operator', operator))) AS methods
          FROM {{r}} GROUP BY cat_key) m ON c.cat_key = m.cat_key
        ORDER BY coalesce(c.pim_category_id, '')""", c=categories, r=rules)


def change_log_entry(header: DataFrame, changes: DataFrame) -> DataFrame:
    """The change log as the one JSON object of the file format: the run header and, per
    category with changes, its added and removed rules. Export only, as ``reference_entries``."""
    return q.run(header.sparkSession, """
        SELECT to_json(named_struct(
                 'vendor_name', h.vendor_name, 'timestamp', h.timestamp,
                 'old_reference_key', h.old_reference_key, 'new_reference_key', h.new_reference_key,
                 'changes', coalesce(c.changes, cast(array() AS array<struct<pim_category_id:string,
                   pim_category_name:string,added_rules:array<variant>,removed_rules:array<variant>>>))),
               map('ignoreNullFields', 'false')) AS entry
        FROM {h} h LEFT JOIN (
          SELECT array_agg(named_struct('pim_category_id', pim_category_id, 'pim_category_name', pim_category_name,
                   'added_rules', transform(added, x -> parse_json(x)),
                   'removed_rules', transform(removed, x -> parse_json(x)))) AS changes
          FROM (SELECT * FROM (
                  SELECT pim_category_id, max(pim_category_name) AS pim_category_name,
                         array_sort(collect_list(CASE WHEN change = 'added' THEN rule_json END)) AS added,
                         array_sort(collect_list(CASE WHEN change = 'removed' THEN rule_json END)) AS removed
                  FROM {c} GROUP BY pim_category_id) ORDER BY pim_category_id)) c ON true""",
                 h=header, c=changes)


# The job's reference file names, Category_Mapping_Reference_<yyyyMMdd-HHmmss>.json
REFERENCE_FILE_PREFIX = "Category_Mapping_Reference_"
REFERENCE_FILE_PATTERN = r"^Category_Mapping_Reference_\d{8}-\d{6}\.json$"


def latest_reference_file(spark: SparkSession, folder: str, strict_names: bool = True) -> str | None:
    """Newest reference file in ``folder``: the largest name, as the job chose it.

    Only names are listed (no data read). ``strict_names`` keeps stamped names only, so
    a stray ``..._v2.json`` cannot outrank every stamp; ``False`` takes any ``.json``
    with the prefix, as the job did.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = [st.getPath().getName() for st in fs.listStatus(path) if st.isFile()]
    if strict_names:
        keep = [n for n in names if re.match(REFERENCE_FILE_PATTERN, n)]
    else:
        keep = [n for n in names if n.startswith(REFERENCE_FILE_PREFIX) and n.endswith(".json")]
    return f"{folder.rstrip('/')}/{max(keep)}" if keep else None


def write_json_lines(df: DataFrame, path: str) -> None:
    """JSON Lines with null fields kept (Spark drops them by default)."""
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def write_entries(df: DataFrame, path: str) -> None:
    """JSON Lines of the column ``entry``, which is JSON text already."""
    df.select("entry").write.mode("errorifexists").text(path)
