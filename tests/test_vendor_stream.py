"""Many deliveries in one micro-batch end as a batch per file does; a replay repeats nothing."""

import json
import os
import random

import pytest

from taxorule.config import Thresholds
from taxorule.sources.store import SnapshotStore
from taxorule.streaming import vendor_drop as V

SUFFIX = "_categoryMatchingProposals_oneVendor_to_onePim_match.json"
TH = Thresholds(min_products=2, min_inside=2, min_vendor_inside=1)


def _drop(folder, lines=False):
    """Three deliveries of v1 and two of v2, in an order of arrival that is not that of the names."""
    rng = random.Random(1)
    os.makedirs(folder)
    for at, (name, vendor) in enumerate([("c", "v1"), ("a", "v2"), ("b", "v1"), ("e", "v2"), ("d", "v1")]):
        doc = {f"vc{k}": {"pim_matches": [{"pim_category_id": rng.choice("AB"), "assignment_source": "existing_category_match",
                                           "products": [{"article_id": rng.randrange(6), "keywords": [f"k{at}", rng.choice("xy")]}
                                                        for _ in range(4)]}]} for k in range(3)}
        os.makedirs(os.path.join(folder, name))
        path = os.path.join(folder, name, vendor + SUFFIX)
        with open(path, "w") as f:
            f.write("\n".join(json.dumps({k: v}) for k, v in doc.items()) if lines else json.dumps(doc))
        os.utime(path, (1_700_000_000 + 10 * at,) * 2)
    return f"{folder}/*"


def _end(spark, root):
    store = SnapshotStore(spark, root)
    head = store.head()
    rows = [(r.vendor_short_name, r.article_id, r.pim_category_id, tuple(r.keywords)) for r in store.read_stable_at(head.stable).collect()]
    rules = store.read_reference_at(head.reference)[1]
    return head.number, sorted(rows), sorted((r.cat_key, tuple(r.values_include)) for r in rules.collect())


def _run(spark, scratch, name, drop, **how):
    results, root = [], os.path.join(scratch, name)
    V.start_vendor_drop_stream(spark, drop, root, os.path.join(scratch, name + "-ckpt"), TH, results=results, **how).awaitTermination(600)
    return root, results


@pytest.mark.parametrize("lines", [True])
def test_one_batch_equals_a_batch_per_file(spark, scratch, lines):
    drop = _drop(os.path.join(scratch, "drop"), lines)
    root, results = _run(spark, scratch, "one", drop, json_lines=lines)
    assert [r.vendor for r in results] == ["v1", "v2", "v1", "v2", "v1"]
    assert [r.run_ts for r in results] == sorted(r.run_ts for r in results)
    root2, results2 = _run(spark, scratch, "each", drop, json_lines=lines, files_per_batch=1)
    assert _end(spark, root) == _end(spark, root2) and _end(spark, root)[0] == 5
    assert [r.metrics for r in results] == [r.metrics for r in results2]


def test_a_broken_batch_is_taken_up_again(spark, scratch, monkeypatch):
    drop = _drop(os.path.join(scratch, "drop"))
    run, seen = V.run_vendor, []

    def third_fails(*args, **how):
        seen.append(how["run_ts"])
        if len(seen) == 3:
            raise RuntimeError("injected")
        return run(*args, **how)

    with monkeypatch.context() as m:
        m.setattr(V, "run_vendor", third_fails)
        with pytest.raises(Exception, match="injected"):
            _run(spark, scratch, "s", drop)
    root, results = _run(spark, scratch, "s", drop)
    assert [r.vendor for r in results] == ["v1", "v2", "v1"] and results[0].run_ts == seen[2]
    plain, _ = _run(spark, scratch, "plain", drop)
    assert _end(spark, root) == _end(spark, plain)
