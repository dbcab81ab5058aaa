"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``; its output is written and read back as the next
one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxorule.llm import columnbwt, mixing, ordinal, packing, simhash
from taxorule.llm.common import keep, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tail probability of the top grade is too low go: poor or toxic ones."""
    model = ordinal.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(ordinal.rating(spark, model, F.col("text"))["tail_top"] >= ordinal.SELECT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates (3-word shingles, 3 bits) the smallest id stays."""
    return simhash.drop_near_duplicates(docs, width=3, max_bits=3, seed=42)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes under repeated 200-byte strings leave the texts; ``n_chars`` follows."""
    left = columnbwt.remove_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it; a document taken n times is n rows."""
    return mixing.repeat(mixing.mix(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", repeats),
    ("source mixing", mixture),
    ("best-fit packing", sequences),
]

#: A fitted classifier and a tokenizer take part: no SQL states the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
