"""Status truth table (FIXTURES 2a) in both scoring forms, and the reference
rebuild / change log golden (FIXTURES 2g)."""

import json
import os

from pyspark.sql import functions as F

from taxorule.config import Thresholds
from taxorule.operators import keywords as kw
from taxorule.operators import reference as ref
from taxorule.operators import scoring as sc
from taxorule.schemas import SCORED_COLUMNS
from taxorule.sources.json_io import read_reference_json, reference_entries

# keyword -> (training rows [(cat, n)], vendor rows [(cat, n)], previous cats, expected)
CASES = {
    "k_new": ([("A", 10)], [("A", 3)], [], "new"),
    "k_sup": ([("A", 10)], [("A", 3)], ["A"], "supported"),
    "k_ni_new": ([("A", 10)], [], [], "not_impacted"),
    "k_ni_known": ([("A", 10)], [], ["A"], "not_impacted"),
    "k_vio": ([("A", 10)], [("A", 3), ("B", 1)], [], "violated"),
    "k_vio_null": ([("A", 10)], [(None, 1)], ["A"], "violated"),
    "k_null": ([("A", 10)], [("A", 2)], [], None),
    "k_nc_inside": ([("A", 9)], [("A", 3)], [], "absent"),
    "k_nc_outside": ([("A", 10), ("B", 1)], [("A", 3)], [], "absent"),
}


def _inputs(spark):
    train, vendor, prev = [], [], []
    for k, (t, v, p, _) in CASES.items():
        train += [(c, [k] * n) for c, n in t]
        vendor += [(c, [f" {k}\t"] * n) for c, n in v]     # vendor keywords get stripped
        prev += [(c, [k]) for c in p]
    ddl = "pim_category_id string, keywords array<string>"
    return (spark.createDataFrame(train, ddl), spark.createDataFrame(vendor, ddl),
            spark.createDataFrame(prev, ddl))


def _check(rows):
    got = {r.keyword: r for r in rows}
    for k, (_, _, _, want) in CASES.items():
        if want == "absent":
            assert k not in got, k
        else:
            assert got[k].vendor_status == want, (k, got[k])
            r = got[k]
            assert r.inside_count + r.hard_outside_count == r.train_total_count
            assert r.vendor_inside_count + r.vendor_outside_count == r.vendor_total_count


def test_truth_table_union_form(spark):
    t, v, p = _inputs(spark)
    rows = sc.pair_scores(sc.role_records(t, v, p)).collect()
    _check(rows)
    assert len(rows) == 7


def test_truth_table_join_form(spark):
    t, v, p = _inputs(spark)
    t = t.withColumn("article_id", F.lit("x"))
    stats = kw.keyword_stats(kw.keyword_occurrences(t))
    v_in, v_tot = kw.vendor_keyword_stats(v)
    rows = sc.score_rules(stats, v_in, v_tot, kw.keyword_pairs(p)).collect()
    _check(rows)
    assert tuple(sc.pair_scores(sc.role_records(t, v, p)).columns) == SCORED_COLUMNS


def test_relaxed_thresholds(spark):
    t, v, p = _inputs(spark)
    rows = sc.pair_scores(sc.role_records(t, v, p), Thresholds(min_inside=9, max_hard_outside=1)).collect()
    assert {r.keyword for r in rows} >= {"k_nc_inside", "k_nc_outside"}


OLD_REF = [
    {"pim_category_id": "A", "pim_category_name": "Alpha", "pim_category_path": "P/A", "vendor_mappings": None,
     "extra": 1, "mapping_methods": [
         {"field_name": "KEYWORD", "values_include": ["k1"], "values_exclude": [], "operator": "contains_any"},
         {"field_name": "KEYWORD", "values_include": ["k2"], "values_exclude": [], "operator": "contains_any"}]},
    {"pim_category_id": "B", "pim_category_name": "Beta", "vendor_mappings": [{"v": 1}], "mapping_methods": [
        {"field_name": "KEYWORD", "values_include": ["k3"], "values_exclude": [], "operator": "contains_any"}]},
    {"pim_category_id": "A", "pim_category_name": "Second A", "mapping_methods": [
        {"field_name": "KEYWORD", "values_include": ["k9"], "values_exclude": [], "operator": "contains_any"}]},
    {"pim_category_id": "  ", "mapping_methods": []},
    "not an entry",
]


def _proposals(spark):
    rows = [("A", "k1", "supported"), ("A", "k4", "new"), ("A", "k2", "violated"), ("C", "k5", "not_impacted")]
    scored = spark.createDataFrame(
        [(c, k, 10, 10, 0, 3, 3, 0, False, True, True, True, False, True, s) for c, k, s in rows],
        ", ".join(f"{c} {'string' if c in ('pim_category_id', 'keyword', 'vendor_status') else 'boolean' if c in ('known_in_previous_training', 'has_vendor_usage', 'global_candidate', 'vendor_supports', 'vendor_violates', 'is_new_rule') else 'bigint'}" for c in SCORED_COLUMNS))
    dim = spark.createDataFrame([("A", "Alpha", "P/A"), ("C", "Gamma", "P/C")],
                                "pim_category_id string, pim_category_name string, pim_category_path string")
    return sc.rule_proposals(scored, dim), dim


def test_reference_rebuild_and_changes(spark, scratch):
    path = os.path.join(scratch, "ref.json")
    with open(path, "w") as f:
        json.dump(OLD_REF, f, indent=2)
    old_cats, old_rules = read_reference_json(spark, path)
    proposals, dim = _proposals(spark)
    cats, rules = ref.rebuild_reference(old_cats, proposals, dim)
    by_cat = {}
    for r in rules.collect():
        by_cat.setdefault(r.cat_key, set()).update(r.values_include)
    assert by_cat == {"A": {"k1", "k4"}, "C": {"k5"}}
    got = {r.cat_key: r for r in cats.collect()}
    assert set(got) == {"A", "B", "C"}
    assert got["A"].pim_category_name == "Alpha" and got["A"].vendor_mappings == "[]"
    assert json.loads(got["B"].vendor_mappings) == [{"v": 1}]
    assert got["C"].pim_category_name == "Gamma" and got["C"].pim_category_path == "P/C"
    changes = ref.rule_changes(old_cats, old_rules, cats, rules).collect()
    flat = sorted((c.pim_category_id, c.change, json.loads(c.rule_json)["values_include"][0]) for c in changes)
    assert flat == [("A", "added", "k4"), ("A", "removed", "k2"), ("B", "removed", "k3"), ("C", "added", "k5")]
    counts = {r.pim_category_id: r.n_rules for r in ref.reference_rule_counts(cats, rules).collect()}
    assert counts == {"A": 2, "B": 0, "C": 1}
    entries = reference_entries(cats, rules).collect()
    assert [e.pim_category_id for e in entries] == ["A", "B", "C"]
    first = json.loads(entries[0].entry)
    assert [m["values_include"] for m in first["mapping_methods"]] == [["k1"], ["k4"]]
    assert first["extra"] == 1 and first["pim_category_path"] == "P/A" and first["vendor_mappings"] == []
    assert json.loads(entries[1].entry)["vendor_mappings"] == [{"v": 1}]


def test_malformed_old_rules_are_no_changes(spark, scratch):
    good = {"field_name": "KEYWORD", "values_include": ["a", None], "values_exclude": None, "operator": "contains_any"}
    bad = [dict(good, field_name=["KEYWORD"]), dict(good, operator={"x": 1}), dict(good, values_include=5), "rule", None]
    path = os.path.join(scratch, "ref.json")
    with open(path, "w") as f:
        json.dump([{"pim_category_id": "A", "mapping_methods": [*bad, good]}], f)
    cats, rules = read_reference_json(spark, path)
    assert [(r.values_include, r.values_exclude) for r in rules.collect()] == [(["a", "None"], [])]
    empty = rules.limit(0)
    changes = ref.rule_changes(cats, rules, cats, empty).collect()
    assert [(c.change, json.loads(c.rule_json)) for c in changes] == [("removed", good)]


def test_lenient_reference(spark, scratch):
    path = os.path.join(scratch, "bad.json")
    with open(path, "w") as f:
        f.write('{"not": "a list"}')
    cats, rules = read_reference_json(spark, path, lenient=True)
    assert cats.count() == 0 and rules.count() == 0
    try:
        read_reference_json(spark, path)[0].collect()
        raise AssertionError("strict read must fail")
    except Exception as e:  # noqa: BLE001
        assert "JSON array" in str(e)


def test_rule_dedup_by_signature(spark):
    # " C" and "C" are two raw ids of one stripped category: their rules collapse (A12)
    rows = [(" C", "k"), ("C", "k"), ("C", " k ")]
    scored = spark.createDataFrame(
        [(c, k, 10, 10, 0, 3, 3, 0, True, True, True, True, False, False, "supported") for c, k in rows],
        ", ".join(f"{c} {'string' if c in ('pim_category_id', 'keyword', 'vendor_status') else 'boolean' if c in ('known_in_previous_training', 'has_vendor_usage', 'global_candidate', 'vendor_supports', 'vendor_violates', 'is_new_rule') else 'bigint'}" for c in SCORED_COLUMNS))
    dim = spark.createDataFrame([("C", "Gamma", None)], "pim_category_id string, pim_category_name string, pim_category_path string")
    empty = spark.createDataFrame([], "cat_key string, pim_category_id string, pim_category_name string, pim_category_path string, vendor_mappings string, entry_json string, position bigint")
    cats, rules = ref.rebuild_reference(empty, sc.rule_proposals(scored, dim), dim)
    assert [(r.cat_key, r.values_include) for r in rules.collect()] == [("C", ["k"])]
    assert [(c.cat_key, c.pim_category_name) for c in cats.collect()] == [("C", "Gamma")]
