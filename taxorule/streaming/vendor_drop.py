"""Structured Streaming entry: every match document dropped into a folder triggers
one vendor run.

A micro-batch takes up to ``files_per_batch`` files, of one vendor or of many. All of them are
flattened by one plan into one table, partitioned by delivery; then the runs follow in the order of
arrival (modification time, then name), so each vendor's deliveries queue up in their order and
every run's merge is the next one's "previous", as with a batch per file. Files are whole documents,
or JSON Lines whose lines are fragments of one. The checkpoint records which files were processed,
so a restart resumes after the last batch.

A delivery's run stamp is noted under the store before the run starts, keyed by the stream, the
epoch and the delivery's number in it. A replayed batch finds it: a run that was done is left alone,
one that failed is retried under its own stamp, and the flattened table is not written again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_THRESHOLDS, Thresholds
from ..plans.pipeline import next_run_ts, run_vendor
from ..sources.match import FILE_OFFSET_BITS, FILE_RANK_BITS, match_products, vendor_of
from ..sources.store import SnapshotStore

#: Files of a micro-batch.
FILES_PER_BATCH = 64


def epoch_stamp(store: SnapshotStore, stream: str, epoch_id: int, delivery: int = 0) -> str:
    """The run stamp of a micro-batch's delivery, the same on every replay."""
    folder = f"{store.root}/streams/{stream}"
    prefix = f"epoch={epoch_id}-{delivery}." if delivery else f"epoch={epoch_id}."
    for name in store.children(folder, files=True):
        if name.startswith(prefix):
            return name[len(prefix):]
    stamp = next_run_ts(store.spark, store.root)
    store.touch(f"{folder}/{prefix}{stamp}")
    return stamp


def _deliveries(batch: DataFrame) -> list[tuple[str, str]]:
    """(path, vendor) of the batch's files in the order of arrival: a row per file."""
    rows = batch.groupBy("source", "vendor_short_name").agg(F.min("_arrived").alias("at")).collect()
    if len(rows) >> FILE_RANK_BITS:
        raise ValueError(f"a micro-batch of more than {1 << FILE_RANK_BITS} files")
    return [(r.source, r.vendor_short_name) for r in sorted(rows, key=lambda r: (r["at"], r.source))]


def _flat_products(batch: DataFrame, deliveries: list[tuple[str, str]]) -> DataFrame:
    """All deliveries' products with ``delivery``, a file's number, which is the top of its ordinals."""
    ranks = batch.sparkSession.createDataFrame([(path, k) for k, (path, _) in enumerate(deliveries)],
                                               "source string, _rank bigint")
    docs = batch.join(F.broadcast(ranks), "source").select(
        "vendor_short_name", "value", "source",
        (F.col("_rank") * (1 << FILE_OFFSET_BITS) + F.col("_start")).alias("_order"))
    return match_products(docs).select("*", F.shiftright("ordinal", FILE_OFFSET_BITS).alias("delivery")).withColumn(
        "ordinal", F.col("ordinal").bitwiseAND((1 << FILE_OFFSET_BITS) - 1))


def start_vendor_drop_stream(spark: SparkSession, drop_dir: str, store_root: str,
                             checkpoint: str, th: Thresholds = DEFAULT_THRESHOLDS,
                             available_now: bool = True, results: list | None = None,
                             files_per_batch: int = FILES_PER_BATCH, json_lines: bool = False):
    docs = (spark.readStream.format("text").option("wholetext", not json_lines)
            .option("maxFilesPerTrigger", files_per_batch).load(drop_dir)
            .select(vendor_of(F.col("_metadata.file_name")).alias("vendor_short_name"), "value",
                    F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("_start"),
                    F.col("_metadata.file_modification_time").alias("_arrived")))
    if json_lines:
        docs = docs.where(F.trim("value") != "")
    store = SnapshotStore(spark, store_root)
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        deliveries = _deliveries(batch)
        if not deliveries:
            return
        flat = store.once(f"{store.root}/streams/{stream}/products/epoch={epoch_id}",
                          lambda: _flat_products(batch, deliveries), partition="delivery")
        for k, (_, vendor) in enumerate(deliveries):
            stamp = epoch_stamp(store, stream, epoch_id, k)
            if store.done(stamp):
                continue
            mine = flat.where(F.col("delivery") == k).drop("delivery")
            res = run_vendor(spark, store_root, None, vendor, th, run_ts=stamp, products=mine)
            if results is not None:
                results.append(res)

    writer = docs.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
