"""Incremental statistics equal a full recount; overlapping runs lose nothing."""

import json
import os
import random

import pytest

from taxorule.operators import incremental as inc
from taxorule.operators import training as tr
from taxorule.config import Thresholds
from taxorule.plans import pipeline
from taxorule.plans.pipeline import run_vendor
from taxorule.schemas import TRAINING_DDL
from taxorule.sources.store import SnapshotStore

T = [f"202601{d:02d}-000000" for d in range(1, 28)]
VALUES = ["A", " A", "B", "C", "0", "", None]


def _product(rng, articles):
    kws = [rng.choice(["k1", "k2", " k3 ", "", None, f"w{rng.randrange(9)}"]) for _ in range(rng.randrange(5))]
    return {"article_id": rng.choice(articles), "keywords": kws}


def _document(rng, n):
    articles = [*range(12), 0, "", None, " 3", "x"]
    return {f"vc{k}": {"pim_matches": [{
        "pim_category_id": rng.choice(["A", " A", "B", "C", 0, "", None]), "pim_category_name": rng.choice(["N", "M", None]),
        "pim_category_path": rng.choice(["p", None]),
        "assignment_source": rng.choice(["existing_category_match"] * 4 + ["ai_suggestion"]),
        "products": [_product(rng, articles) for _ in range(rng.randrange(1, 6))]}]} for k in range(n)}


def _write(folder, vendor, doc, at):
    path = os.path.join(folder, f"{at}-{vendor}.json")
    with open(path, "w") as f:
        json.dump(doc, f)
    return path


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def _recount(store, ts):
    records = store.read_stable_at(ts)
    categories, pairs = inc.full_counts(records)
    return records, categories, pairs


@pytest.mark.parametrize("seed", [1])
def test_counts_follow_random_deliveries(spark, scratch, seed):
    rng = random.Random(seed)
    root, th = os.path.join(scratch, "store"), Thresholds(min_products=4, min_inside=2, min_vendor_inside=1)
    store = SnapshotStore(spark, root)
    crossed = set()
    before = set()
    for k in range(4):
        vendor = rng.choice(["v1", "v2"])
        res = run_vendor(spark, root, _write(scratch, vendor, _document(rng, rng.randrange(2, 7)), k), vendor, th, run_ts=T[k])
        records, categories, pairs = _recount(store, T[k])
        got = store.read_counts(T[k])
        assert _rows(got[0], "cat_key", "n_products") == _rows(categories, "cat_key", "n_products")
        assert _rows(got[1], "pim_category_id", "keyword", "n") == _rows(pairs, "pim_category_id", "keyword", "n")
        columns = ("pim_category_id", "pim_category_name", "pim_category_path")
        lookup = inc.category_lookup(got[2], got[0], th.min_products)
        assert _rows(lookup, *columns) == _rows(tr.category_dim(tr.training_subset(records, th.min_products)), *columns)
        now = {r.cat_key for r in categories.collect() if r.n_products >= th.min_products}
        crossed |= {(c, "in") for c in now - before} | {(c, "out") for c in before - now}
        before = now
        assert res.metrics["usable_categories"] == len(now)
        if not res.skipped:
            # proposals of a run over the same history, counted in full
            previous = store.read_stable_at(res.previous_stable) if res.previous_stable else store.read_records([])
            from taxorule.operators import scoring as sc
            products = spark.read.parquet(store.run_path("products", vendor, T[k]))
            subset = tr.training_subset(records, th.min_products)
            want = sc.rule_proposals(sc.pair_scores(sc.role_records(subset, products, tr.training_subset(previous, th.min_products)), th),
                                     tr.category_dim(subset))
            assert _rows(spark.read.parquet(res.proposals_path), *want.columns) == _rows(want, *want.columns)
    assert crossed


def _records(spark, rows):
    """(vendor, article, category, keywords, ordinal)"""
    full = [(c, f"n{c}", None, v, None, None, None, a, None, k, None, o, False, False) for v, a, c, k, o in rows]
    return spark.createDataFrame(full, TRAINING_DDL)


def test_thresholds_are_crossed_both_ways_without_a_recount(spark):
    old = _records(spark, [("v", f"a{i}", "A", ["x"], i) for i in range(3)] + [("v", "b", "B", ["y", "y"], 9)])
    new = _records(spark, [("v", "a0", "B", ["y"], 0), ("v", "c", "B", ["z"], 1)])
    categories, pairs = inc.full_counts(old)
    changes = inc.record_changes(old, tr.merge_stable(old, new), new)
    assert sorted((r.article_id, r.sign) for r in changes.collect()) == [("a0", -1), ("a0", 1), ("c", 1)]
    now, now_pairs = inc.updated_categories(categories, changes), inc.updated_pairs(pairs, changes)
    assert _rows(inc.usable_pairs(pairs, categories, 3), "keyword", "n") == [("x", 3)]
    assert _rows(inc.usable_pairs(now_pairs, now, 3), "keyword", "n") == [("y", 3), ("z", 1)]


def test_a_delivery_reads_only_its_own_partition(spark, scratch, monkeypatch):
    rng = random.Random(3)
    root, th = os.path.join(scratch, "store"), Thresholds(min_products=1)
    for k, vendor in enumerate(["v1", "v2"]):
        run_vendor(spark, root, _write(scratch, vendor, _document(rng, 6), k), vendor, th, run_ts=T[k])
    read, asked = SnapshotStore.read_records, []
    monkeypatch.setattr(SnapshotStore, "read_records", lambda self, entries: asked.extend(entries) or read(self, entries))
    run_vendor(spark, root, _write(scratch, "v1", _document(rng, 6), 3), "v1", th, run_ts=T[3])
    assert {e.vendor_key for e in asked} == {"v1"}


def test_metrics_take_no_count_job(spark, scratch):
    root = os.path.join(scratch, "store")
    path = _write(scratch, "v1", _document(random.Random(4), 8), 0)
    res = run_vendor(spark, root, path, "v1", Thresholds(min_products=2), run_ts=T[0])
    store = SnapshotStore(spark, root)
    for kind, names in (("products", ["products", "new_records", "rejected"]), ("proposals", ["proposals", "strict_candidates"])):
        noted = json.loads(store.get(f"{store.run_path(kind, 'v1', T[0])}/_metrics.json"))
        assert list(noted) == names and all(res.metrics[n] == noted[n] for n in names)
    assert res.metrics["products"] == spark.read.parquet(store.run_path("products", "v1", T[0])).count() > 0
    assert res.metrics["merged_records"] == sum(r.n_products for r in store.read_counts(T[0])[0].collect())


def _doc(articles, keyword):
    return {"vc": {"pim_matches": [{"pim_category_id": "A", "assignment_source": "existing_category_match",
                                    "products": [{"article_id": str(a), "keywords": [keyword]} for a in articles]}]}}


@pytest.mark.parametrize("other", ["v2", "v1"])
def test_overlapping_runs_keep_both_updates(spark, scratch, monkeypatch, other):
    """v1's second delivery is open while another one runs to its end."""
    root, th = os.path.join(scratch, "store"), Thresholds(min_products=1, min_inside=1, min_vendor_inside=1)
    for k, vendor in enumerate(["v1", "v2"]):
        run_vendor(spark, root, _write(scratch, vendor, _doc(range(3), "old"), k), vendor, th, run_ts=T[k])
    rebuild, calls = pipeline.ref.rebuild_reference, []

    def meanwhile(*args):
        if not calls:
            calls.append(1)
            run_vendor(spark, root, _write(scratch, other, _doc(range(2, 5), "theirs"), 9), other, th, run_ts=T[5])
        return rebuild(*args)

    with monkeypatch.context() as m:
        m.setattr(pipeline.ref, "rebuild_reference", meanwhile)
        res = run_vendor(spark, root, _write(scratch, "v1", _doc(range(2), "mine"), 8), "v1", th, run_ts=T[4])
    store = SnapshotStore(spark, root)
    assert res.run_ts > T[5] and res.previous_stable == T[5] and store.done(T[4]) and store.done(res.run_ts)
    head = store.head()
    assert (head.number, head.stable, head.reference) == (4, res.run_ts, res.run_ts)
    got = {(r.vendor_short_name, r.article_id): r.keywords[0] for r in store.read_stable_at(head.stable).collect()}
    want = {(v, str(a)): "old" for v in ("v1", "v2") for a in range(3)}
    want.update({(other, str(a)): "theirs" for a in range(2, 5)})
    want.update({("v1", str(a)): "mine" for a in range(2)})
    assert got == want
    records, categories, pairs = _recount(store, head.stable)
    assert _rows(store.read_counts(head.stable)[1], "keyword", "n") == _rows(pairs, "keyword", "n")


def test_a_run_that_died_after_its_commit_is_finished(spark, scratch, monkeypatch):
    root, path = os.path.join(scratch, "store"), _write(scratch, "v1", _doc(range(12), "k"), 0)
    with monkeypatch.context() as m:
        m.setattr(SnapshotStore, "finish_run", lambda *_: (_ for _ in ()).throw(RuntimeError("injected")))
        with pytest.raises(RuntimeError, match="injected"):
            run_vendor(spark, root, path, "v1", run_ts=T[0])
    res = run_vendor(spark, root, path, "v1", run_ts=T[0])
    store = SnapshotStore(spark, root)
    assert res.run_ts == T[0] and res.previous_stable is None and store.head().number == 1 and store.done(T[0])


def test_only_one_can_create_a_commit(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    store = SnapshotStore(spark, os.path.join(scratch, "store"))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: store.create_exclusive(f"{store.root}/commits/000000000001", str(k)), range(16)))
    assert sum(won) == 1 and store.get(f"{store.root}/commits/000000000001") == str(won.index(True))
    assert store.children(f"{store.root}/commits", files=True) == ["000000000001"]
