"""Training-set operators: extraction, normalization, merge, subset, category lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import TRUSTED_SOURCE
from ..functions import sqltext as q
from ..schemas import TRAINING_COLUMNS

_COLS = q.cols(TRAINING_COLUMNS)
_TRUSTED = f"coalesce(assignment_source = {q.lit(TRUSTED_SOURCE)}, false)"


def extract_training(products: DataFrame) -> DataFrame:
    """New training records: trusted matches whose product has a non-blank article id."""
    return q.run(products.sparkSession,
                 f"SELECT {_COLS} FROM {{p}} WHERE {_TRUSTED} AND NOT {q.blank('article_id')}",
                 p=products)


def extraction_rejects(products: DataFrame) -> DataFrame:
    """Trusted products skipped for a missing / blank article id, per vendor category."""
    return q.run(products.sparkSession, f"""
        SELECT vendor_short_name, vendor_category_id, count(1) AS rejected_products
        FROM {{p}} WHERE {_TRUSTED} AND {q.blank('article_id')}
        GROUP BY vendor_short_name, vendor_category_id""", p=products)


def normalize_training(records: DataFrame) -> DataFrame:
    """Record normalization for training: keywords stripped, blank ones dropped.

    Ids and text fields are strings and class codes are typed from ingest on, so the
    only value change left is keyword trimming.
    """
    sel = ", ".join(q.clean_keywords("keywords") + " AS keywords" if c == "keywords" else c
                    for c in records.columns)
    return q.run(records.sparkSession, f"SELECT {sel} FROM {{r}}", r=records)


# Position in the stable dataset: source (existing 0 < new 1) above the record ordinal,
# packed into one long so winners are picked by a hash aggregate on primitive buffers.
_SOURCE_BIT = 1 << 62


def merge_stable(existing: DataFrame, new: DataFrame, first_new: int | None = None) -> DataFrame:
    """Upsert new records into the stable dataset, keyed by (vendor, article).

    Both key parts are stripped, and keyless rows (blank or falsy key) are dropped.
    Existing records come first. A later record with the same key replaces the whole
    row, but the key keeps its first position. Ordinals are non-negative, < 2^62 and
    unique within each input.

    Plan: winners are picked on narrow columns (key, position) by a hash aggregate
    with a map-side partial step. The full records then meet their winner in an
    equi-join on (key, position): the payload is shuffled once, a hot key is spread
    over its positions, and consumers that only need a few columns (category counts)
    never move the keyword lists. Whether the winners are broadcast is left to AQE,
    which knows their measured size. ``first_new`` is the ordinal of the first new record
    where ``existing`` is one partition of a larger set; by default it follows ``existing``.
    """
    spark = existing.sparkSession
    both = q.run(spark, f"""
        SELECT * FROM (
          SELECT *, {q.falsy_key('vendor_short_name', None)} AS _k_vendor,
                 {q.falsy_key('article_id', 'article_id_falsy')} AS _k_article,
                 ordinal + _src * {_SOURCE_BIT} AS _pos
          FROM (SELECT {_COLS}, 0 AS _src FROM {{e}}
                UNION ALL
                SELECT {_COLS}, 1 AS _src FROM {{n}}) u) k
        WHERE _k_vendor <> '' AND _k_article <> ''""", e=existing, n=new)
    winners = q.run(spark, """
        SELECT _k_vendor, _k_article, max(_pos) AS _pos, min(_pos) AS _first
        FROM {b} GROUP BY _k_vendor, _k_article""", b=both)
    # new records are numbered after every existing one: a scalar subquery, no join
    after = "(SELECT coalesce(max(ordinal) + 1, 0) FROM {e})" if first_new is None else f"{int(first_new)}L"
    ordinal = (f"CASE WHEN w._first >= {_SOURCE_BIT} "
               f"THEN {after} + (w._first - {_SOURCE_BIT}) "
               f"ELSE w._first END AS ordinal")
    sel = ", ".join(ordinal if c == "ordinal" else f"b.{c}" for c in TRAINING_COLUMNS)
    return q.run(spark, f"""
        SELECT {sel}
        FROM {{b}} b JOIN {{w}} w
          ON b._k_vendor = w._k_vendor AND b._k_article = w._k_article AND b._pos = w._pos""",
                 b=both, w=winners, e=existing)


def category_counts(records: DataFrame) -> DataFrame:
    """Products per category (stripped id; NULL / blank ids skipped)."""
    key = q.strip("pim_category_id")
    return q.run(records.sparkSession, f"""
        SELECT {key} AS cat_key, count(1) AS n_products FROM {{r}}
        WHERE {key} IS NOT NULL AND {key} <> '' GROUP BY 1""", r=records)


def usable_categories(records: DataFrame, min_products: int = 10) -> DataFrame:
    """Categories with at least ``min_products`` products (the HAVING step)."""
    return q.run(records.sparkSession,
                 f"SELECT cat_key FROM {{c}} WHERE n_products >= {int(min_products)}",
                 c=category_counts(records))


#: Parts that the records of one category are dealt out in.
_PARTS = 256


def training_subset(records: DataFrame, min_products: int = 10,
                    normalize: bool = True) -> DataFrame:
    """Records of usable categories, normalized for training.

    Only the category decides, but a category may hold most records, so it is not what the records
    are dealt out by: each category is cut into up to ``_PARTS`` parts by record, its products are
    summed over the parts, and records meet the part they are in. A part of the usable side is a
    narrow row that some record stands behind, so that side never outgrows the records.
    """
    spark = records.sparkSession
    cat = q.strip("pim_category_id")
    keys = [c for c in ("article_id", "ordinal") if c in records.columns]
    part = f"pmod(xxhash64({q.cols(keys)}), {_PARTS})" if keys else "0L"
    usable = q.run(spark, f"""
        SELECT cat_key, part FROM (
          SELECT cat_key, part, sum(n) OVER (PARTITION BY cat_key) AS n_products FROM (
            SELECT cat_key, part, count(1) AS n FROM (SELECT {cat} AS cat_key, {part} AS part FROM {{r}})
            WHERE cat_key IS NOT NULL AND cat_key <> '' GROUP BY cat_key, part))
        WHERE n_products >= {int(min_products)}""", r=records)
    sel = ", ".join((q.clean_keywords("r.keywords") + " AS keywords") if (c == "keywords" and normalize)
                    else f"r.{c}" for c in records.columns)
    return q.run(spark, f"""
        SELECT {sel} FROM (SELECT *, {part} AS _part FROM {{r}}) r
        LEFT SEMI JOIN {{u}} u ON {q.strip('r.pim_category_id')} = u.cat_key AND r._part = u.part
        WHERE NOT coalesce(r.pim_category_id_falsy, false)""", r=records, u=usable)


def category_dim(records: DataFrame) -> DataFrame:
    """First non-null name and path per raw category id, in dataset order.

    The first positions are minima of longs, a hash aggregate with a partial step; only the
    (at most two) records at those positions then give up their strings.
    """
    spark = records.sparkSession
    first = q.run(spark, """
        SELECT pim_category_id AS _cat, min(ordinal) FILTER (WHERE pim_category_name IS NOT NULL) AS _name_at,
               min(ordinal) FILTER (WHERE pim_category_path IS NOT NULL) AS _path_at
        FROM {r} WHERE pim_category_id IS NOT NULL GROUP BY pim_category_id""", r=records)
    return q.run(spark, """
        SELECT _cat AS pim_category_id,
               max(CASE WHEN ordinal = _name_at THEN pim_category_name END) AS pim_category_name,
               max(CASE WHEN ordinal = _path_at THEN pim_category_path END) AS pim_category_path
        FROM (SELECT f._cat, f._name_at, f._path_at, r.ordinal, r.pim_category_name, r.pim_category_path
              FROM {f} f LEFT JOIN {r} r
                ON r.pim_category_id = f._cat AND (r.ordinal = f._name_at OR r.ordinal = f._path_at)) j
        GROUP BY _cat""", f=first, r=records)
