"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

#: Characters that separate words: space and U+0009..U+000D. ``bytes.split()`` of Python
#: splits on exactly these.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder, with writer ``options``, and read it back.

    Later steps start from the written table: nothing is computed twice, and a lost
    executor never sends a job back further than this table.
    """
    spark = df.sparkSession
    path = table_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows: workers live on between tasks and keep
    what they once allocated, so the Python objects of a whole batch should not be alive at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def row_key(df: DataFrame) -> Column:
    """Hash of all columns of a row: tells rows with equal ids apart."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
