"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the total proportional to its weight, but no more than
``max_epochs`` times its own size; what a capped source cannot take is reshared among the
others by weight until no source is above its cap. Repetitions are whole copies plus a
seeded fraction of the source's documents.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, keep, table

#: Hash bins per source: a source's documents are ordered by (bin, hash), so a hot source is
#: spread over this many window groups.
BINS_HEX_DIGITS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3,
                   share: float = 1.0) -> DataFrame:
    """``source, source_size, target`` from rows ``_source, _size``.

    Sources take the weights in turn, in code point order, the null source last. Sorted by
    cap / weight, a source is capped exactly if its cap is at most its proportional part of
    what is left after the caps before it; all comparisons are in whole numbers. The windows
    without a partition run over one row per source.
    """
    spark = sizes.sparkSession
    base = math.lcm(*weights)
    wanted = "cast(total AS decimal(38,0))" if share == 1.0 else f"cast(total * {share} AS decimal(38,0))"
    ws = ", ".join(map(str, weights))
    return spark.sql(f"""
        SELECT source, source_size,
               CASE WHEN capped THEN cast(cap AS double)
                    ELSE cast(w * ({wanted} - coalesce(cap_sum, 0)) AS double) / cast(w_sum AS double) END AS target
        FROM (SELECT *, sum(CASE WHEN capped THEN cap END) OVER () AS cap_sum,
                     sum(CASE WHEN NOT capped THEN w END) OVER () AS w_sum
              FROM (SELECT *, cap * w_left <= w * ({wanted} - cap_before) AS capped
                    FROM (SELECT *, coalesce(sum(cap) OVER prior, 0) AS cap_before,
                                 sum(w) OVER () - coalesce(sum(w) OVER prior, 0) AS w_left
                          FROM (SELECT source, source_size, total, rn,
                                       cast(source_size AS decimal(20,0)) * {max_epochs} AS cap,
                                       element_at(array({ws}), cast((rn - 1) % {len(weights)} + 1 AS int)) AS w
                                FROM (SELECT _source AS source, source_size,
                                             sum(source_size) OVER () AS total,
                                             row_number() OVER (ORDER BY _source NULLS LAST) AS rn
                                      FROM (SELECT _source, sum(_size) AS source_size
                                            FROM {{sizes}} GROUP BY _source)))
                          WINDOW prior AS (ORDER BY source_size * ({base} / w), rn
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))))
        """, sizes=sizes)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix-1",
        columns: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of ``columns``) with ``size, source_size, target, copies, taken``.

    ``size`` is the number of words (null text: 0). A document of a source with repetition
    rate r is taken floor(r) times; the remaining words of the target come from whole extra
    copies, in the order of a seeded hash of the id, up to the document that the target cuts
    in half. Sums are kept per (source, hash bin), so no task holds a source. Reruns agree:
    ties of the hash are broken by id, size and text. A source without words has target 0 and
    its documents are taken as often as a source at the cap. A null source is a source.
    Original columns travel inside ``row``, so no name can clash. Empty tables stay empty.
    """
    spark = docs.sparkSession
    cols = docs.columns if columns is None else columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint").alias("_size"),
        F.substring(F.md5(F.concat(F.lit(seed + "/"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))),
                    1, 16).alias("_u"),
        F.xxhash64(text_col).alias("_tie"))
    narrow = len(cols) <= 1
    sized = keep(rows, "mix") if narrow else rows
    stats = keep(sized.groupBy("_source", F.substring("_u", 1, BINS_HEX_DIGITS).alias("_bin"))
                 .agg(F.sum("_size").alias("_size")), "mix-bins")
    targets = source_targets(stats, weights, max_epochs)
    return spark.sql(f"""
        SELECT row, _size AS size, source_size, target, whole + extra AS copies,
               _size * (whole + extra) AS taken
        FROM (SELECT row, _size, source_size, target, cast(whole AS bigint) AS whole,
                     CASE WHEN whole < {max_epochs} AND
                               bin_before + in_bin + _size / 2.0D <= target - whole * source_size
                          THEN 1L ELSE 0L END AS extra
              FROM (SELECT r.row, r._size, r.in_bin, b.bin_before, b.source_size, b.target,
                           CASE WHEN b.source_size = 0 THEN {max_epochs}
                                ELSE floor(b.target / b.source_size) END AS whole
                    FROM (SELECT *, coalesce(sum(_size) OVER (
                                 PARTITION BY _source, _bin ORDER BY _u, _id, _size, _tie
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS in_bin
                          FROM (SELECT *, substring(_u, 1, {BINS_HEX_DIGITS}) AS _bin FROM {{sized}})) r
                    JOIN (SELECT s._source, s._bin, t.source_size, t.target,
                                 coalesce(sum(s._size) OVER (
                                   PARTITION BY s._source ORDER BY s._bin
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bin_before
                          FROM {{stats}} s JOIN {{targets}} t ON s._source <=> t.source) b
                    ON r._source <=> b._source AND r._bin = b._bin))
        """, sized=sized, stats=stats, targets=targets)


def repeat(mixed: DataFrame) -> DataFrame:
    """The mixture itself: each original row as often as it is taken."""
    return (mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("row.*"))


def q_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, columns=["doc_id"]).select("row.doc_id", "size", "source_size", "target", "taken")


MIXING_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         substr(md5('mix-1/' || doc_id), 1, 16) AS u FROM documents),
s AS (
  SELECT source, source_size, sum(source_size) OVER () AS total,
         row_number() OVER (ORDER BY source NULLS LAST) AS rn
  FROM (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source)),
w AS (SELECT *, 3 * source_size AS cap, ([5, 2, 1])[(rn - 1) % 3 + 1] AS w FROM s),
o AS (
  SELECT *, coalesce(sum(cap) OVER p, 0) AS cap_before,
         sum(w) OVER () - coalesce(sum(w) OVER p, 0) AS w_left
  FROM w WINDOW p AS (ORDER BY source_size * (10 // w), rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap * w_left <= w * (total - cap_before) AS capped FROM o),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE (w * (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0)))::DOUBLE
                   / (sum(CASE WHEN NOT capped THEN w END) OVER ())::DOUBLE END AS target FROM c),
r AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 3 ELSE floor(t.target / t.source_size::DOUBLE) END AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN whole < 3 AND before::DOUBLE + size / 2.0::DOUBLE
                                  <= target - whole * source_size::DOUBLE THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
