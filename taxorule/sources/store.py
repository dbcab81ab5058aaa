"""Versioned snapshot store for the job's datasets (stable set, proposals, reference,
change log) under one shared root, in Parquet.

Layout (``<ts>`` = run stamp ``yyyyMMdd-HHmmss``)::

    commits/<number>                                         what each committed run left behind
    runs/run_ts=<ts>/OPEN, BASE-<number>, CLAIM-<number>, DONE   run markers
    counts/snapshot=<ts>/categories|pairs|names/             statistics over the snapshot's records
    base_counts/vendor=<v>/run_ts=<ts>/                      the same of a run's base that came without
    stable/records/snapshot=<ts>/vendor_key=<v>/             training records a run wrote
    stable/manifest/snapshot=<ts>/                           the partitions that make up a snapshot
    products/vendor=<v>/run_ts=<ts>/                         flattened match products of a run
    proposals/vendor=<v>/run_ts=<ts>/                        rule proposals
    reference/snapshot=<ts>/categories|rules/                mapping reference (flat)
    changes/vendor=<v>/run_ts=<ts>/header|rules/             change log

A table is complete when Spark's ``_SUCCESS`` marker is present, and a snapshot counts for
later runs when its run is committed. Commits are numbered; a run builds on the last one (its
base) and commits the next number, which only one run can create. A run that died half-way is
therefore invisible to every other run; retried under its own stamp it reuses the tables it
completed, if its base is still the last commit. If another run has committed meanwhile, the tables
are left behind and the run builds anew on that commit, so no delivery's records are lost. Every
run writes fresh directories (Spark cannot overwrite a path it is reading). Before the first commit
"previous" is the latest snapshot of a done run, or of none (an import), before the run.

Creating a commit needs a file system whose rename does not replace a file, as HDFS's, or a local
one with hard links; an object store whose rename replaces cannot hold ``commits``.

The stable set is partitioned by vendor. A delivery rewrites its own vendor's partition; the
manifest (a row per vendor) carries the others over from the snapshots that wrote them.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import RUN_TS_PATTERN
from ..functions import sqltext as q
from ..schemas import (REFERENCE_CATEGORY_DDL, REFERENCE_RULE_DDL, TRAINING_COLUMNS,
                       TRAINING_DDL)
from ..session import write_table

_TS = re.compile(RUN_TS_PATTERN)
#: Beside a table's files; readers skip names with an underscore.
METRICS = "_metrics.json"
MANIFEST_DDL = "vendor_key string, written string, next_ordinal bigint"


class Head(NamedTuple):
    """The last commit: its number (0: none yet), and the stamps whose tables are current."""

    number: int
    stable: str | None
    reference: str | None
    run_ts: str | None = None


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---- file system (names only; no data goes through the driver) ----
    def _fs_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        p, fs = self._fs_path(path)
        return bool(fs.exists(p))

    def children(self, path: str, files: bool = False) -> list[str]:
        p, fs = self._fs_path(path)
        if not fs.exists(p):
            return []
        return [st.getPath().getName() for st in fs.listStatus(p) if st.isFile() == files]

    def touch(self, path: str) -> None:
        p, fs = self._fs_path(path)
        fs.create(p, True).close()

    def put(self, path: str, text: str) -> None:
        p, fs = self._fs_path(path)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()

    def get(self, path: str) -> str:
        """A small file of this store's own (a commit, a table's metrics)."""
        p, fs = self._fs_path(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create_exclusive(self, path: str, text: str) -> bool:
        """Create a file with its content at once; False if somebody else has created it."""
        p, fs = self._fs_path(path)
        draft = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        self.put(draft, text)
        d, _ = self._fs_path(draft)
        if fs.getScheme() != "file":
            if not fs.exists(p) and fs.rename(d, p):
                return True
            fs.delete(d, False)
            return False
        jvm = self.spark.sparkContext._jvm
        local = [jvm.java.io.File(fs.makeQualified(x).toUri().getPath()).toPath() for x in (p, d)]
        try:
            jvm.java.nio.file.Files.createLink(*local)
            return True
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        finally:
            fs.delete(d, False)

    def complete(self, path: str) -> bool:
        return self.exists(f"{path}/_SUCCESS")

    # ---- runs ----
    def _run(self, run_ts: str) -> str:
        return f"{self.root}/runs/run_ts={run_ts}"

    def open_run(self, run_ts: str) -> None:
        """Start a run, or take up one that did not get done."""
        if self.done(run_ts):
            raise FileExistsError(f"run already done: {run_ts}")
        self.touch(f"{self._run(run_ts)}/OPEN")

    def finish_run(self, run_ts: str) -> None:
        self.touch(f"{self._run(run_ts)}/DONE")

    def opened(self, run_ts: str) -> bool:
        return self.exists(f"{self._run(run_ts)}/OPEN")

    def done(self, run_ts: str) -> bool:
        return self.exists(f"{self._run(run_ts)}/DONE")

    def _marked(self, run_ts: str, what: str) -> list[int]:
        return sorted(int(n[len(what) + 1:]) for n in self.children(self._run(run_ts), files=True)
                      if n.startswith(what + "-"))

    def head(self, before: str | None = None, number: int | None = None) -> Head:
        """The last commit, or the one with ``number``. Without commits, what ``latest`` finds."""
        numbers = [int(n) for n in self.children(f"{self.root}/commits", files=True) if n.isdigit()]
        number = max(numbers, default=0) if number is None else number
        if number:
            return Head(number, **json.loads(self.get(self._commit(number))))
        return Head(0, self.latest_stable(before),
                    self.latest(f"{self.root}/reference", "snapshot", before, marker="/rules"))

    def _commit(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}"

    def base(self, run_ts: str) -> Head | None:
        """The commit a run builds on: the last one, or the one that its tables are built on and
        that it was committed after. None if its tables are built on an older one."""
        for number in self._marked(run_ts, "CLAIM"):
            if self.exists(self._commit(number)) and self.head(number=number).run_ts == run_ts:
                return self.head(run_ts, number - 1)
        head, begun = self.head(run_ts), self._marked(run_ts, "BASE")
        if begun and begun != [head.number]:
            return None
        self.touch(f"{self._run(run_ts)}/BASE-{head.number}")
        return head

    def commit(self, base: Head, run_ts: str, stable: str, reference: str | None) -> bool:
        """Make a run's snapshots the current ones, if ``base`` still is the last commit."""
        number = base.number + 1
        self.touch(f"{self._run(run_ts)}/CLAIM-{number}")
        entry = {"run_ts": run_ts, "stable": stable, "reference": reference}
        return (self.create_exclusive(self._commit(number), json.dumps(entry))
                or self.head(number=number).run_ts == run_ts)

    def stamps(self, base: str, prefix: str) -> list[str]:
        """All run stamps with a directory under ``base``, complete or not, sorted."""
        names = [n.split("=", 1)[1] for n in self.children(base) if n.startswith(prefix + "=")]
        return sorted(ts for ts in names if _TS.match(ts))

    def last_stamp(self) -> str | None:
        """The latest stamp that any run or snapshot has used."""
        used = [*self.stamps(f"{self.root}/runs", "run_ts"), *self.stamps(f"{self.root}/stable/manifest", "snapshot"),
                *self.stamps(f"{self.root}/reference", "snapshot")]
        return max(used, default=None)

    def latest(self, base: str, prefix: str, before: str | None = None, marker: str = "") -> str | None:
        """Latest stamp (string order, as the job used) strictly before ``before`` whose
        snapshot is complete and whose run, if it has markers, is done. Looks from the newest
        back. Directories of which none is usable and none belongs to an unfinished run were
        written by a committer without ``_SUCCESS``; that raises, lest history be lost."""
        unexplained = None
        for ts in reversed(self.stamps(base, prefix)):
            if before is not None and ts >= before:
                continue
            if self.opened(ts) and not self.done(ts):
                continue
            if self.complete(f"{base}/{prefix}={ts}{marker}"):
                return ts
            unexplained = unexplained or ts
        if unexplained:
            raise RuntimeError(f"no usable snapshot under {base}, but {prefix}={unexplained} exists without _SUCCESS")
        return None

    def write(self, df: DataFrame, path: str, partition: str | None = None) -> None:
        """Write a table. A complete one is never replaced; an incomplete one (no reader
        trusts it) is overwritten."""
        if self.complete(path):
            raise FileExistsError(f"already complete: {path}")
        write_table(df, path, partition, "overwrite" if self.exists(path) else "errorifexists")

    def once(self, path: str, build, partition: str | None = None, measure: dict[str, str] | None = None) -> DataFrame:
        """The table at ``path``, written from ``build()`` unless an earlier attempt of the run
        completed it. ``measure`` (name: SQL aggregate) is taken while it is written, without a
        job of its own, and kept beside the table, where a retry finds it."""
        if not self.complete(path):
            df, seen = build(), Observation()
            if measure:
                df = df.observe(seen, *[F.expr(e).cast("bigint").alias(k) for k, e in measure.items()])
            self.write(df, path, partition)
            if measure:
                self.put(f"{path}/{METRICS}", json.dumps(seen.get))
        return self.spark.read.parquet(path)

    def measured(self, path: str, measure: dict[str, str]) -> dict[str, int]:
        """What ``once`` measured. If the run died before it was noted, or the plan turned out
        empty before it ran, it is counted on the written table."""
        note = f"{path}/{METRICS}"
        found = json.loads(self.get(note)) if self.exists(note) else {}
        if set(found) != set(measure):
            found = self.spark.read.parquet(path).agg(
                *[F.expr(e).cast("bigint").alias(k) for k, e in measure.items()]).first().asDict()
        return found

    # ---- stable training dataset ----
    def manifest_path(self, run_ts: str) -> str:
        return f"{self.root}/stable/manifest/snapshot={run_ts}"

    def records_path(self, run_ts: str) -> str:
        return f"{self.root}/stable/records/snapshot={run_ts}"

    def latest_stable(self, before: str | None = None) -> str | None:
        return self.latest(f"{self.root}/stable/manifest", "snapshot", before)

    def manifest(self, ts: str | None) -> list:
        """(vendor_key, written, next_ordinal) of a snapshot: a row per vendor."""
        return [] if ts is None else self.spark.read.parquet(self.manifest_path(ts)).collect()

    def read_records(self, entries: list) -> DataFrame:
        """Records of the named partitions; no other directory is listed or read."""
        if not entries:
            return self.spark.createDataFrame([], TRAINING_DDL)
        records = f"{self.root}/stable/records"
        paths = sorted({self.records_path(e.written) for e in entries})
        # one scan whatever the number of vendors; partitions are pruned by a hash set
        return (self.spark.read.option("basePath", records)
                .schema(f"{TRAINING_DDL}, snapshot string, vendor_key string").parquet(*paths)
                .where(F.concat("snapshot", F.lit("/"), "vendor_key").isin([f"{e.written}/{e.vendor_key}" for e in entries]))
                .select(*TRAINING_COLUMNS))

    def read_stable(self, before: str | None = None) -> tuple[DataFrame, str | None]:
        ts = self.latest_stable(before)
        return self.read_records(self.manifest(ts)), ts

    def read_stable_at(self, run_ts: str) -> DataFrame:
        return self.read_records(self.manifest(run_ts))

    def write_stable(self, records: DataFrame, run_ts: str, carried: list | None = None) -> None:
        """Write the records, partitioned by vendor, as a snapshot that also holds the
        ``carried`` manifest rows of other vendors. Rows without a vendor have no key and could
        never be merged; they are left out, as the merge leaves them out."""
        key = q.falsy_key("vendor_short_name", None)
        path = self.records_path(run_ts)
        keyed = q.run(self.spark, f"SELECT * FROM (SELECT {q.cols(TRAINING_COLUMNS)}, {key} AS vendor_key "
                                  f"FROM {{r}}) WHERE vendor_key <> ''", r=records)
        self.once(path, lambda: keyed, partition="vendor_key")

        def manifest() -> DataFrame:
            own = (self.spark.read.schema(f"{TRAINING_DDL}, vendor_key string").parquet(path)
                   .groupBy("vendor_key").agg((F.max("ordinal") + 1).alias("next_ordinal"))
                   .select("vendor_key", F.lit(run_ts).alias("written"), "next_ordinal"))
            rows = self.spark.createDataFrame([tuple(e) for e in carried or []], MANIFEST_DDL)
            return own.unionByName(rows).coalesce(1)

        self.once(self.manifest_path(run_ts), manifest)

    # ---- statistics over a stable snapshot ----
    def counts_path(self, run_ts: str) -> str:
        return f"{self.root}/counts/snapshot={run_ts}"

    def read_counts(self, ts: str | None) -> tuple[DataFrame, DataFrame, DataFrame] | None:
        """``categories, pairs, names`` of a snapshot; None if it was written without them."""
        path = self.counts_path(ts or "")
        if ts is None or not self.complete(f"{path}/names"):
            return None
        return tuple(self.spark.read.parquet(f"{path}/{t}") for t in ("categories", "pairs", "names"))

    # ---- per-run tables ----
    def run_path(self, kind: str, vendor: str, run_ts: str) -> str:
        return f"{self.root}/{kind}/vendor={vendor}/run_ts={run_ts}"

    # ---- mapping reference ----
    def reference_path(self, run_ts: str) -> str:
        return f"{self.root}/reference/snapshot={run_ts}"

    def empty_reference(self) -> tuple[DataFrame, DataFrame]:
        return (self.spark.createDataFrame([], REFERENCE_CATEGORY_DDL),
                self.spark.createDataFrame([], REFERENCE_RULE_DDL))

    def read_reference(self, before: str | None = None) -> tuple[DataFrame, DataFrame, str | None]:
        return self.read_reference_at(self.latest(f"{self.root}/reference", "snapshot", before, marker="/rules"))

    def read_reference_at(self, ts: str | None) -> tuple[DataFrame, DataFrame, str | None]:
        if ts is None:
            return (*self.empty_reference(), None)
        base = self.reference_path(ts)
        return (self.spark.read.parquet(f"{base}/categories"),
                self.spark.read.parquet(f"{base}/rules"), ts)

    def write_reference(self, categories: DataFrame, rules: DataFrame,
                        run_ts: str) -> tuple[DataFrame, DataFrame]:
        base = self.reference_path(run_ts)
        # rules last: their _SUCCESS marks the snapshot complete
        return (self.once(f"{base}/categories", lambda: categories),
                self.once(f"{base}/rules", lambda: rules))
