"""Filter interaction audit: what every order of five document filters keeps and removes.

The files of the table are processed as available-now micro-batches. The keyed text state holds, for
each text's digest, the rows with the smallest id so far. A batch counts each document under the
mask of the filters that it fails; when a smaller id arrives for a text, the earlier holder's rows
are retracted from the mask without the duplicate filter and counted under the mask with it. The
sums of all batches' signed counts are the part counters, from which all orders follow.

The state is a table in the shared folder to which every batch adds the rows that now hold their
text's smallest id; a text's holders are its rows with the least id of them. A batch meets only the
state of its own texts, in joins that AQE splits where very many documents share one. A batch that is
replayed overwrites what it wrote.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path
from .common import keep, table

LETTERS = "ABCDE"
DUPLICATE = 16
#: Micro-batches that the files of a table are dealt out to.
BATCHES = 4

_CAPITALS = bytes(range(65, 91))
_SIGNS = re.compile(rb"[#$%&*|]")

#: A document: its text's digest (128 bits), the filters A to D that it fails, id and part.
_FACTS = "t long, s long, mask int, id long, part string"
_STATE = "t long, s long, mask int, id long, part string, n long"
_COUNTS = "id long, part string, mask int, n long"


def text_mask(text: str | None) -> tuple[int, bytes]:
    """Bits of the filters A to D that a text fails, and its digest. Null is the empty text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    mask = ((len(words) < 100) + 2 * (100 * len(set(words)) < 80 * len(words))
            + 4 * (100 * capitals > 10 * len(text or "")) + 8 * (_SIGNS.search(data) is not None))
    return mask, hashlib.sha256(data).digest()


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_mask(x.as_py()) for x in batch.column(1)]
        halves = [[int.from_bytes(d[k:k + 8], "little", signed=True) for _, d in found] for k in (0, 8)]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(h, pa.int64()) for h in halves), pa.array([m for m, _ in found], pa.int32()), batch.column(0),
             batch.column(2).fill_null("")], names=["t", "s", "mask", "id", "part"])


def _advance(facts: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A batch's documents on the state before it: the state rows to add, and the signed counts.

    A null id is larger than all others, as ``min`` has it."""
    mine = keep(facts.groupBy("t", "s").agg(F.min("id").alias("here")), "audit-texts")
    earlier = state.join(mine, ["t", "s"])
    before = earlier.groupBy("t", "s").agg(F.min("id").alias("old"), F.lit(True).alias("known"))
    texts = keep(mine.join(before, ["t", "s"], "left").select(
        "t", "s", "old", F.coalesce("known", F.lit(False)).alias("known"), F.least("here", "old").alias("least")),
        "audit-texts")
    placed = facts.join(texts, ["t", "s"]).withColumn("holds", F.col("id").eqNullSafe(F.col("least")))
    holders = placed.filter("holds").groupBy("t", "s", "mask", "id", "part").agg(F.count("*").alias("n"))
    counted = placed.select("id", "part", F.when(F.col("holds"), F.col("mask"))
                            .otherwise(F.col("mask") + DUPLICATE).alias("mask"), F.lit(1).alias("n"))
    retracted = (state.join(texts.filter("known AND NOT old <=> least"), ["t", "s"])
                 .filter("id <=> old")
                 .select("id", "part", F.inline(F.array(
                     F.struct(F.col("mask"), (-F.col("n")).alias("n")),
                     F.struct((F.col("mask") + DUPLICATE).alias("mask"), F.col("n"))))))
    return holders, (counted.unionByName(retracted).groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
                     .filter("n <> 0"))


def counters(spark: SparkSession, path: str, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "lang", batches: int = BATCHES, home: str | None = None) -> DataFrame:
    """``part, mask, good, toxic, n``: documents of each part that fail exactly the filters of mask.

    ``path`` is a Parquet file or folder. ``home`` is a folder that all nodes share; a run that
    was broken off goes on there, and files that came since are added to its counts. Without
    it the run has a folder of its own.
    """
    home = home or table_path(spark, "filter-audit")
    docs, path = spark.read.parquet(path), path.rstrip("/")
    files = docs.inputFiles()
    each = max(1, -(-len(files) // batches))
    if [f.rpartition("/")[2] for f in files] == [path.rpartition("/")[2]]:
        path = f"{path[:-1]}[{path[-1]}]"  # a stream takes a single file as a pattern only
    state, changes = f"{home}/state", f"{home}/changes"
    for folder, ddl in ((state, _STATE), (changes, _COUNTS)):  # so that there always is a table to read
        spark.createDataFrame([], ddl).write.mode("overwrite").parquet(f"{folder}/batch=-1")

    def advance(batch: DataFrame, number: int) -> None:
        facts = keep(batch, "audit-facts")
        before = (batch.sparkSession.read.schema(f"{_STATE}, batch long").parquet(state)
                  .filter(F.col("batch") < number).drop("batch"))
        for df, folder in zip(_advance(facts, before), (state, changes)):
            df.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    (spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", each).parquet(path)
     .select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"),
             F.col(f"`{part_col}`").cast("string").alias("part"))
     .mapInArrow(_facts, _FACTS)
     .writeStream.foreachBatch(advance).trigger(availableNow=True)
     .option("checkpointLocation", f"{home}/progress").start().awaitTermination())
    total = (spark.read.schema(_COUNTS).parquet(changes).groupBy("id", "part", "mask")
             .agg(F.sum("n").alias("n")).filter("n <> 0"))
    known = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return (total.join(known, "id", "left")
            .groupBy("part", "mask", F.coalesce("good", F.lit(False)).alias("good"),
                     F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(F.sum("n").alias("n")))


def _steps(spark: SparkSession) -> DataFrame:
    """filter_order, step, filter, its bit, the bits before it: 600 rows, for each of 32 masks."""
    rows = []
    for order in itertools.permutations(LETTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            rows.append(("".join(order), step, letter, bit, before))
            before |= bit
    steps = spark.createDataFrame(rows, "filter_order string, step int, letter string, bit int, prior int")
    return steps.withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit(31))))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``counters``.

    Parts without documents do not occur; a part's 600 rows are always whole, zeros included.
    An empty table gives no rows."""
    fails = "(mask & bit) <> 0"
    here = f"{fails} AND (mask & prior) = 0"

    def number(condition: str):
        return F.sum(F.when(F.expr(condition), F.col("n")).otherwise(0))

    rows = (counts.join(_steps(counts.sparkSession), "mask").groupBy("part", "filter_order", "step", "letter").agg(
        number("(mask & (prior | bit)) = 0").alias("kept"), number(here).alias("removed"),
        number(f"{fails} AND (mask & prior) <> 0").alias("redundant"), number("mask = bit").alias("unique_fails"),
        number(f"good AND {here}").alias("good_lost"), number(f"toxic AND {here}").alias("toxic_lost")))
    return rows.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                       "toxic_lost", F.expr("sum(removed) OVER (PARTITION BY part, letter)").alias("shapley"))


def audit_table(spark: SparkSession, path: str, labels: DataFrame, **how) -> DataFrame:
    """The audit of a stored table. A null text is empty, a null part is the empty string.

    A null id counts as larger than every id, so it fails the duplicate filter if an id has the
    text, and equal ids (repeated rows) do not fail each other. A document is good or toxic if
    any of its labels says so; null labels and null label ids say nothing. Other columns, whatever their
    names, are not read."""
    return audit(counters(spark, path, labels, **how))


def q_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit_table(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))


AUDIT_SQL = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id),
c AS (
  SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic, count(*) AS n,
         (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * (least IS NOT NULL AND (w.doc_id IS NULL OR w.doc_id > least))::INT AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id GROUP BY ALL),
o AS (
  SELECT a || b || c || d || e AS filter_order
  FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v1(a), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v2(b),
       (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v3(c), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v4(d),
       (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v5(e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5),
p AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INT AS step FROM o),
s AS (
  SELECT *, substr(filter_order, step, 1) AS letter,
         (1 << (instr('ABCDE', substr(filter_order, step, 1)) - 1))::INT AS bit,
         coalesce(list_sum([(1 << (instr('ABCDE', substr(filter_order, i, 1)) - 1))::INT FOR i IN range(1, step)]),
                  0)::INT AS prior FROM p),
r AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (mask & (prior | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & prior = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & prior <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (good AND mask & bit <> 0 AND mask & prior = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (toxic AND mask & bit <> 0 AND mask & prior = 0), 0)::BIGINT AS toxic_lost
  FROM c CROSS JOIN s GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r
"""
