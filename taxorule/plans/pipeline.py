"""One vendor run: match document -> stable snapshot -> proposals -> reference -> change log.

Every step is a DataFrame plan; each sink is a Parquet snapshot in the shared store
that the next step reads back, so lineage is cut at every hand-off (a lost executor
recomputes at most one step) and no data passes through the driver. Metrics are taken while a
table is written and kept beside it, so a retry reports the same ones.

Statistics over the stable dataset are incremental: a delivery reads its own vendor's partition and
adds signed changes to the counts of the snapshot before. Runs commit in turn: two that overlap
end as if one had come after the other, whichever vendors they are of.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_THRESHOLDS, TRUSTED_SOURCE, Thresholds
from ..functions import sqltext as q
from ..operators import incremental as inc
from ..operators import reference as ref
from ..operators import scoring as sc
from ..operators import training as tr
from ..sources.array_file import (write_change_file, write_proposals_file, write_reference_file,
                                  write_stable_file)
from ..sources.json_io import (REFERENCE_FILE_PREFIX, change_log_entry, read_reference_json, read_stable_json, reference_entries,
                               write_entries, write_json_lines)
from ..sources.match import read_match_products
from ..sources.store import Head, SnapshotStore


#: Stamp of imported files: before every run.
IMPORT_TS = "00000000-000000"


@dataclass
class RunResult:
    vendor: str
    run_ts: str
    stable_snapshot: str | None = None
    proposals_path: str | None = None
    reference_snapshot: str | None = None
    previous_stable: str | None = None
    previous_reference: str | None = None
    changes_path: str | None = None
    metrics: dict = field(default_factory=dict)
    skipped: str | None = None


def new_run_ts(after: str | None = None) -> str:
    """UTC run stamp, strictly later than ``after`` (runs of one store stay ordered)."""
    now = datetime.now(timezone.utc)
    if after is not None:
        floor = datetime.strptime(after, "%Y%m%d-%H%M%S").replace(tzinfo=timezone.utc)
        now = max(now, floor + timedelta(seconds=1))
    return now.strftime("%Y%m%d-%H%M%S")


def next_run_ts(spark: SparkSession, store_root: str) -> str:
    used = SnapshotStore(spark, store_root).last_stamp()
    return new_run_ts(None if used in (None, IMPORT_TS) else used)


def import_files(spark: SparkSession, store_root: str, stable: str | None = None,
                 reference: str | None = None, lenient: bool = False) -> None:
    """Take over the original job's files as the store's oldest snapshots, under the stamp
    ``IMPORT_TS``. A store that already has a snapshot of the kind refuses."""
    store = SnapshotStore(spark, store_root)
    if stable:
        if store.latest_stable():
            raise FileExistsError(f"{store_root} already has a stable dataset")
        store.write_stable(read_stable_json(spark, stable), IMPORT_TS)
    if reference:
        if store.latest(f"{store.root}/reference", "snapshot", marker="/rules"):
            raise FileExistsError(f"{store_root} already has a mapping reference")
        store.write_reference(*read_reference_json(spark, reference, lenient), IMPORT_TS)


def run_vendor(spark: SparkSession, store_root: str, match_paths, vendor: str,
               th: Thresholds = DEFAULT_THRESHOLDS, run_ts: str | None = None,
               json_lines: bool = False, allow_empty: bool = True,
               products: DataFrame | None = None, export_json: bool = False) -> RunResult:
    """Run the whole job for one vendor delivery (``products`` may be given instead of
    ``match_paths``, e.g. by the streaming entry). ``export_json`` also writes the
    proposals, the nested reference and the change log in the original formats under
    ``<store>/export/``.

    A run that failed is retried by calling it again with its ``run_ts``: tables it completed
    are reused, and its results are those of an undisturbed run. Under a new stamp it starts
    over, and the failed run does not count as history. A run that finds another one committed
    since it began (or since it failed) builds on that, under a later stamp (``run_ts`` of the
    result); only the flat products are kept.
    """
    if not vendor or not vendor.strip():
        raise ValueError("a run needs the vendor's name")
    store = SnapshotStore(spark, store_root)
    first = run_ts = run_ts or next_run_ts(spark, store_root)
    store.open_run(run_ts)

    # A: flatten the match document once; everything else reads the flat copy
    trusted, blank = f"assignment_source = {q.lit(TRUSTED_SOURCE)}", q.blank("article_id")
    measures = {"products": {"products": "count(1)", "new_records": f"count_if({trusted} AND NOT {blank})",
                             "rejected": f"count_if({trusted} AND {blank})"},
                "rejects": {"rejecting_categories": "count(1)"}}
    paths = {kind: store.run_path(kind, vendor, first) for kind in measures}
    products = store.once(paths["products"], lambda: products if products is not None
                          else read_match_products(spark, match_paths, vendor, json_lines),
                          measure=measures["products"])
    store.once(paths["rejects"], lambda: tr.extraction_rejects(products), measure=measures["rejects"])
    metrics = {k: v for kind, what in measures.items() for k, v in store.measured(paths[kind], what).items()}

    # B-E on the last commit; if another run commits first, once more on that one
    while True:
        base = store.base(run_ts)
        if base is not None:
            res = RunResult(vendor=vendor, run_ts=run_ts, metrics=dict(metrics))
            new_reference = _build(store, base, res, products, th, allow_empty)
            if store.commit(base, run_ts, run_ts, new_reference):
                break
        run_ts = next_run_ts(spark, store_root)
        store.open_run(run_ts)
    if export_json and not res.skipped:
        _export(store, res)
    store.finish_run(run_ts)
    if run_ts != first:
        store.finish_run(first)
    return res


def _build(store: SnapshotStore, base: Head, res: RunResult, products: DataFrame, th: Thresholds,
           allow_empty: bool) -> str | None:
    """Steps B to E of a run on ``base``; the stamp of the reference that is current after it."""
    spark, vendor, run_ts = store.spark, res.vendor, res.run_ts

    def once(path: str, build, **measure: str) -> DataFrame:
        df = store.once(path, build, measure=measure)
        res.metrics.update(store.measured(path, measure) if measure else {})
        return df

    # B: merge into the vendor's partition of the stable dataset; others are carried over
    res.previous_stable = base.stable
    manifest = store.manifest(base.stable)
    mine = store.read_records([e for e in manifest if e.vendor_key == vendor.strip()])
    new = tr.extract_training(products)
    others = [e for e in manifest if e.vendor_key != vendor.strip()]
    store.write_stable(tr.merge_stable(mine, new, max((e.next_ordinal for e in manifest), default=0)), run_ts, others)
    res.stable_snapshot = store.manifest_path(run_ts)
    merged = store.read_records([e for e in store.manifest(run_ts) if e.written == run_ts])

    # C: the statistics over all records follow the merge by signed changes; a base without
    # statistics (an import) is counted in full, once
    known = store.read_counts(base.stable)
    if known is None:
        existing = store.read_records(manifest)
        full = dict(zip(("categories", "pairs"), inc.full_counts(existing)), names=inc.vendor_names(existing))
        # written: the new counts and the previous pairs of step D both read them
        known = tuple(store.once(f"{store.run_path('base_counts', vendor, run_ts)}/{t}", lambda df=df: df)
                      for t, df in full.items())
    categories, pairs, names = known
    changes = inc.record_changes(mine, merged, new)
    at = store.counts_path(run_ts)
    usable = f"count_if(n_products >= {int(th.min_products)})"
    now = once(f"{at}/categories", lambda: inc.updated_categories(categories, changes),
               merged_records="coalesce(sum(n_products), 0)", categories="count(1)", usable_categories=usable)
    now_pairs = once(f"{at}/pairs", lambda: inc.updated_pairs(pairs, changes))
    now_names = once(f"{at}/names", lambda: inc.vendor_names(merged).unionByName(
        names.where(F.col("vendor_key") != vendor.strip())))
    if not res.metrics["usable_categories"]:
        res.skipped = "no category reaches the minimum number of products"
        return base.reference

    # D: score and publish proposals; the three roles' pair counts meet in one aggregation
    roles = once(store.run_path("pairs", vendor, run_ts), lambda: sc.role_pair_counts(
        inc.usable_pairs(now_pairs, now, th.min_products), sc.pair_counts(sc.role_records(vendor=products)),
        inc.usable_pairs(pairs, categories, th.min_products)),
        training_pairs="count_if(inside_count > 0)", previous_pairs="count_if(previous_count > 0)")
    dim = once(store.run_path("categories", vendor, run_ts),
               lambda: inc.category_lookup(now_names, now, th.min_products))
    res.proposals_path = store.run_path("proposals", vendor, run_ts)
    # the strict probe (all four thresholds) = new + supported
    proposals = once(res.proposals_path, lambda: sc.rule_proposals(sc.score_pairs(roles, th), dim),
                     proposals="count(1)", strict_candidates="count_if(stats.vendor_status IN ('new', 'supported'))")

    # E: rebuild the reference from this run's accepted rules, then diff
    old_cats, old_rules, res.previous_reference = store.read_reference_at(base.reference)
    new_cats, new_rules = ref.rebuild_reference(old_cats, proposals, dim, allow_empty)
    new_cats, new_rules = store.write_reference(new_cats, new_rules, run_ts)
    res.reference_snapshot = store.reference_path(run_ts)
    res.changes_path = store.run_path("changes", vendor, run_ts)
    once(f"{res.changes_path}/header", lambda: spark.range(1).select(
        F.lit(vendor).alias("vendor_name"), F.lit(run_ts).alias("timestamp"),
        F.lit(res.previous_reference).cast("string").alias("old_reference_key"),
        F.lit(run_ts).alias("new_reference_key")))
    once(f"{res.changes_path}/rules", lambda: ref.rule_changes(old_cats, old_rules, new_cats, new_rules),
         rule_changes="count(1)")
    return run_ts


def _export(store: SnapshotStore, res: RunResult) -> None:
    """The proposals, the nested reference and the change log in the original formats."""
    read = store.spark.read.parquet
    base, by_run = f"{store.root}/export", f"vendor={res.vendor}/run_ts={res.run_ts}"
    cats, rules, _ = store.read_reference_at(res.run_ts)
    header, changes = read(f"{res.changes_path}/header"), read(f"{res.changes_path}/rules")
    for path, write in ((f"proposals/{by_run}", lambda p: write_json_lines(read(res.proposals_path), p)),
                        (f"reference/snapshot={res.run_ts}", lambda p: write_entries(reference_entries(cats, rules), p)),
                        (f"changes/{by_run}", lambda p: write_entries(change_log_entry(header, changes), p))):
        if not store.complete(f"{base}/{path}"):
            write(f"{base}/{path}")
    # and as the single files that readers of the original job expect
    stamp = res.run_ts
    for name, write in ((f"stable_{stamp}.json", lambda p: write_stable_file(store.read_stable_at(stamp), p)),
                        (f"Category_Mapping_RuleProposals_{res.vendor}_{stamp}.json",
                         lambda p: write_proposals_file(read(res.proposals_path), p)),
                        (f"{REFERENCE_FILE_PREFIX}{stamp}.json", lambda p: write_reference_file(cats, rules, p)),
                        (f"Category_Mapping_RuleChanges_{res.vendor}_{stamp}.json",
                         lambda p: write_change_file(header, changes, p))):
        if not store.exists(f"{base}/files/{name}"):
            write(f"{base}/files/{name}")
