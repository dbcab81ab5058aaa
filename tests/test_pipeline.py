"""End to end: the vendor run over a real match document equals the binding queries;
a re-run sees its own snapshot as history; the streaming entry runs one delivery."""

import json
import os

import pytest

from pyspark.sql import functions as F

from taxorule.plans import binding_plan as bp
from taxorule.plans.pipeline import import_files, run_vendor
from taxorule.sources import driver_tables as dt
from taxorule.sources.store import SnapshotStore
from taxorule.streaming.vendor_drop import epoch_stamp, start_vendor_drop_stream

from .conftest import SF0001

T0, T1, T2 = "20260101-000000", "20260102-000000", "20260103-000000"


def _prop_key(df):
    return sorted((r.pim_category_id, r.values_include[0], r.stats.vendor_status, r.stats.inside_count,
                   r.stats.vendor_total_count) for r in df.collect())


def test_run_vendor_matches_binding(spark, scratch):
    root = os.path.join(scratch, "store")
    store = SnapshotStore(spark, root)
    run = bp.BindingRun.build(spark, SF0001)
    store.write_stable(dt.existing_training(spark, SF0001), T0)
    old_cats, old_rules = run.old_reference()
    store.write_reference(old_cats, old_rules, T0)
    match = os.path.join(scratch, "vendorA_match.jsonl")
    dt.match_document_lines(spark, SF0001).select("value").write.text(match)

    res = run_vendor(spark, root, match, "vendorA", run_ts=T1, json_lines=True, export_json=True)
    assert res.previous_stable == T0 and res.previous_reference == T0 and res.skipped is None
    assert res.metrics["products"] == 100 and res.metrics["new_records"] == 90
    proposals = spark.read.parquet(res.proposals_path)
    assert _prop_key(proposals) == _prop_key(run.proposals())
    assert res.metrics["proposals"] == 642 and res.metrics["strict_candidates"] == 406
    changes = spark.read.parquet(res.changes_path + "/rules")
    want = sorted((r.pim_category_id, r.change, r.rule) for r in bp.q_rule_changes(spark, SF0001).collect())
    got = sorted((r.pim_category_id, r.change, r.signature) for r in changes.collect())
    assert got == want
    header = spark.read.parquet(res.changes_path + "/header").first()
    assert (header.vendor_name, header.old_reference_key, header.new_reference_key) == ("vendorA", T0, T1)
    assert store.read_stable_at(T1).count() == 190
    # only the delivered vendor's partition was written; the other one is carried over
    assert store.children(store.records_path(T1)) == ["vendor_key=vendorA"]
    assert {(e.vendor_key, e.written) for e in store.manifest(T1)} == {("vendorA", T1), ("vendorB", T0)}
    assert res.metrics["merged_records"] == 190 and res.metrics["previous_pairs"] == 15082
    ref_json = spark.read.json(f"{root}/export/reference/snapshot={T1}").orderBy("pim_category_id").collect()
    assert [r.pim_category_id for r in ref_json] == ["de", "en", "es", "fr"]
    assert all(r.vendor_mappings == [] or r.vendor_mappings is None for r in ref_json)
    log = json.loads(spark.read.text(f"{root}/export/changes/vendor=vendorA/run_ts={T1}").first()[0])
    assert (log["vendor_name"], log["old_reference_key"], log["new_reference_key"]) == ("vendorA", T0, T1)
    assert sum(len(c["added_rules"]) for c in log["changes"]) == 284
    assert sum(len(c["removed_rules"]) for c in log["changes"]) == 181
    n_methods = sum(len(r.mapping_methods) for r in ref_json)
    assert n_methods == spark.read.parquet(f"{res.reference_snapshot}/rules").count()

    # re-run: history is now the first run's snapshot, so nothing is "new" any more
    res2 = run_vendor(spark, root, match, "vendorA", run_ts=T2, json_lines=True)
    assert res2.previous_stable == T1 and res2.previous_reference == T1
    p2 = spark.read.parquet(res2.proposals_path)
    assert p2.where(F.col("stats.vendor_status") == "new").count() == 0
    assert p2.count() == proposals.count()
    assert store.read_stable_at(T2).count() == 190
    # the reference rebuilt from the same accepted rules does not change again
    assert spark.read.parquet(res2.changes_path + "/rules").count() == 0


def test_empty_subset_stops_early(spark, scratch):
    root = os.path.join(scratch, "store")
    doc = {"vc": {"pim_matches": [{"pim_category_id": "A", "assignment_source": "existing_category_match",
                                   "products": [{"article_id": 1, "keywords": ["x"]}]}]}}
    path = os.path.join(scratch, "tiny_categoryMatchingProposals_oneVendor_to_onePim_match.json")
    with open(path, "w") as f:
        json.dump(doc, f)
    res = run_vendor(spark, root, path, "tiny", run_ts=T1)
    assert res.skipped and res.stable_snapshot and res.proposals_path is None
    assert SnapshotStore(spark, root).read_stable_at(T1).count() == 1


def test_streaming_drop_folder(spark, scratch):
    drop = os.path.join(scratch, "drop")
    os.makedirs(drop)
    products = [{"article_id": i, "keywords": ["shared", f"p{i}"]} for i in range(12)]
    doc = {"vc": {"pim_matches": [{"pim_category_id": "A", "assignment_source": "existing_category_match",
                                   "products": products}]}}
    with open(os.path.join(drop, "acme_categoryMatchingProposals_oneVendor_to_onePim_match.json"), "w") as f:
        json.dump(doc, f)
    results = []
    q = start_vendor_drop_stream(spark, drop, os.path.join(scratch, "store"),
                                 os.path.join(scratch, "ckpt"), results=results)
    q.awaitTermination(300)
    assert len(results) == 1 and results[0].vendor == "acme"
    props = spark.read.parquet(results[0].proposals_path).collect()
    assert [(p.pim_category_id, p.values_include, p.stats.vendor_status) for p in props] == [("A", ["shared"], "new")]
    # a replay of the same batch keeps its stamp, finds the run done and leaves it alone
    store = SnapshotStore(spark, os.path.join(scratch, "store"))
    [note] = [n for s in store.children(f"{store.root}/streams") for n in store.children(f"{store.root}/streams/{s}", files=True)]
    assert note == f"epoch=0.{results[0].run_ts}" and store.done(results[0].run_ts)
    [stream] = store.children(f"{store.root}/streams")
    assert epoch_stamp(store, stream, 0) == results[0].run_ts != epoch_stamp(store, stream, 1)


def _delivery(scratch, name="acme"):
    products = [{"article_id": i, "keywords": ["shared", f"p{i}"]} for i in range(12)]
    doc = {"vc": {"pim_matches": [{"pim_category_id": "A", "assignment_source": "existing_category_match",
                                   "products": products}]}}
    path = os.path.join(scratch, f"{name}_categoryMatchingProposals_oneVendor_to_onePim_match.json")
    with open(path, "w") as f:
        json.dump(doc, f)
    return path


@pytest.mark.parametrize("step", ["extract_training", "merge_stable", "pair_scores", "category_lookup", "rebuild_reference",
                                  "rule_changes"])
def test_a_failed_run_can_be_retried(spark, scratch, monkeypatch, step):
    from taxorule.plans import pipeline
    path, root = _delivery(scratch), os.path.join(scratch, "store")
    module = next((m for m in (pipeline.tr, pipeline.inc, pipeline.sc, pipeline.ref) if hasattr(m, step)))
    if step == "pair_scores":
        module, step = pipeline.sc, "role_records"

    def fail(*_, **__):
        raise RuntimeError("injected")

    with monkeypatch.context() as m:
        m.setattr(module, step, fail)
        with pytest.raises(RuntimeError, match="injected"):
            run_vendor(spark, root, path, "acme", run_ts=T1)
    # under a fresh stamp the failed run is no history; under its own it is completed
    stamp = T2 if step in ("merge_stable", "rule_changes") else T1
    res = run_vendor(spark, root, path, "acme", run_ts=stamp)
    [p] = spark.read.parquet(res.proposals_path).collect()
    assert (p.pim_category_id, p.values_include, p.stats.vendor_status) == ("A", ["shared"], "new")
    assert res.previous_stable is None and res.metrics["products"] == 12 and res.metrics["rule_changes"] == 1
    with pytest.raises(FileExistsError):
        run_vendor(spark, root, path, "acme", run_ts=stamp)
    if stamp == T2:  # the failed run, retried after another one: it builds on that, and nothing is lost
        res = run_vendor(spark, root, path, "acme", run_ts=T1)
        assert res.previous_stable == T2 and res.run_ts > T2 and res.metrics["rule_changes"] == 0
        with pytest.raises(FileExistsError):
            run_vendor(spark, root, path, "acme", run_ts=T1)


def test_import_then_run_then_export(spark, scratch):
    root = os.path.join(scratch, "store")
    stable = [{"vendor_short_name": "acme", "article_id": i, "pim_category_id": "A", "pim_category_name": "Alpha",
               "keywords": ["shared"]} for i in range(12)]
    rule = lambda k: {"field_name": "KEYWORD", "values_include": [k], "values_exclude": [], "operator": "contains_any"}
    reference = [{"pim_category_id": "B", "pim_category_name": "Beta", "vendor_mappings": [{"v": 1}], "note": {"x": [1]},
                  "mapping_methods": [rule("gone")]}]
    for name, what in (("stable.json", stable), ("ref.json", reference)):
        with open(os.path.join(scratch, name), "w") as f:
            json.dump(what, f)
    import_files(spark, root, os.path.join(scratch, "stable.json"), os.path.join(scratch, "ref.json"))
    with pytest.raises(FileExistsError):
        import_files(spark, root, os.path.join(scratch, "stable.json"))
    res = run_vendor(spark, root, _delivery(scratch), "acme", run_ts=T1, export_json=True)
    [p] = spark.read.parquet(res.proposals_path).collect()
    assert p.stats.vendor_status == "supported"  # known from the imported dataset
    got = [json.loads(r[0]) for r in spark.read.text(f"{root}/export/reference/snapshot={T1}").collect()]
    assert {e["pim_category_id"]: e for e in got} == {
        "A": {"pim_category_id": "A", "pim_category_name": None, "pim_category_path": None, "vendor_mappings": [],
              "mapping_methods": [rule("shared")]},
        "B": {"pim_category_id": "B", "pim_category_name": "Beta", "pim_category_path": None,
              "vendor_mappings": [{"v": 1}], "note": {"x": [1]}, "mapping_methods": []}}
    log = json.loads(spark.read.text(f"{root}/export/changes/vendor=acme/run_ts={T1}").first()[0])
    assert [(c["pim_category_id"], [r["values_include"] for r in c["added_rules"]],
             [r["values_include"] for r in c["removed_rules"]]) for c in log["changes"]] == [
        ("A", [["shared"]], []), ("B", [], [["gone"]])]


def test_a_run_needs_a_vendor(spark, scratch):
    with pytest.raises(ValueError):
        run_vendor(spark, os.path.join(scratch, "store"), _delivery(scratch), "", run_ts=T1)
