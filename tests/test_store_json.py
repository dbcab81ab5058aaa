"""Snapshot discovery, stable-dataset JSON import, reference file discovery, JSON export."""

import json
import os

import pytest

from taxorule.operators import training as tr
from taxorule.plans.pipeline import new_run_ts
from taxorule.sources.json_io import latest_reference_file, read_stable_json, write_json_lines
from taxorule.sources.store import SnapshotStore


def test_latest_snapshot_ignores_incomplete_and_later(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "s"))
    df = spark.createDataFrame([(1,)], "x int")
    for ts in ("20260101-000000", "20260102-000000", "20260104-000000"):
        df.write.parquet(f"{store.root}/stable/snapshot={ts}")
    os.makedirs(f"{store.root}/stable/snapshot=20260103-000000")          # no _SUCCESS: a dead run
    os.makedirs(f"{store.root}/stable/snapshot=latest")                  # not a stamp
    assert store.latest(f"{store.root}/stable", "snapshot") == "20260104-000000"
    assert store.latest(f"{store.root}/stable", "snapshot", before="20260104-000000") == "20260102-000000"
    assert store.latest(f"{store.root}/stable", "snapshot", before="20260101-000000") is None
    store.open_run("20260102-000000")                                    # opened, never done
    with pytest.raises(RuntimeError, match="without _SUCCESS"):          # 0101 stays; hide it to see the rest
        SnapshotStore(spark, store.root).latest(f"{store.root}/other", "snapshot") or os.makedirs(
            f"{store.root}/other/snapshot=20260101-000000")
        store.latest(f"{store.root}/other", "snapshot")
    assert store.latest(f"{store.root}/stable", "snapshot", before="20260104-000000") == "20260101-000000"
    empty, ts = SnapshotStore(spark, os.path.join(scratch, "none")).read_stable()
    assert ts is None and empty.count() == 0 and "keywords" in empty.columns


def test_run_stamps_strictly_increase():
    assert new_run_ts("29991231-235959") == "30000101-000000"


def test_read_stable_json(spark, scratch):
    path = os.path.join(scratch, "stable.json")
    recs = [{"vendor_short_name": "V", "article_id": 5, "pim_category_id": "A", "keywords": [" x ", None, ""],
             "class_codes": [None]},
            "not a record",
            {"vendor_short_name": "V", "article_id": 0, "pim_category_id": 0, "keywords": "y"}]
    with open(path, "w") as f:
        json.dump(recs, f, indent=2)
    rows = read_stable_json(spark, path).orderBy("ordinal").collect()
    assert [(r.article_id, r.keywords, r.article_id_falsy, r.pim_category_id_falsy) for r in rows] == [
        ("5", [" x "], False, False), ("0", ["y"], True, True)]
    assert rows[0].ordinal == 0 and rows[1].ordinal == 2
    # falsy article ids never survive a merge; a falsy category is counted but never usable
    merged = tr.merge_stable(read_stable_json(spark, path).limit(0), read_stable_json(spark, path))
    assert [r.article_id for r in merged.collect()] == ["5"]


def test_latest_reference_file(spark, scratch):
    for n in ("Category_Mapping_Reference_20260101-000000.json", "Category_Mapping_Reference_20260301-000000.json",
              "Category_Mapping_Reference_v2.json", "other.json"):
        open(os.path.join(scratch, n), "w").write("[]")
    assert latest_reference_file(spark, scratch).endswith("20260301-000000.json")
    assert latest_reference_file(spark, scratch, strict_names=False).endswith("_v2.json")
    assert latest_reference_file(spark, os.path.join(scratch, "missing")) is None


def test_json_lines_keep_nulls(spark, scratch):
    out = os.path.join(scratch, "out")
    write_json_lines(spark.createDataFrame([("a", None)], "k string, v string"), out)
    line = [ln for f in os.listdir(out) if f.endswith(".json") for ln in open(os.path.join(out, f))][0]
    assert json.loads(line) == {"k": "a", "v": None}


def test_retry_overwrites_only_incomplete_tables(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "s"))
    path = f"{store.root}/stable/snapshot=20260101-000000"
    os.makedirs(path)
    open(os.path.join(path, "part-garbage.parquet"), "w").write("half written")   # a dead attempt
    df = spark.createDataFrame([(1,)], "x int")
    assert store.once(path, lambda: df).count() == 1
    assert store.once(path, lambda: df.unionAll(df)).count() == 1                   # complete: reused
    with pytest.raises(FileExistsError):
        store.write(df, path)


def test_stable_json_takes_the_whole_text(spark, scratch):
    path = os.path.join(scratch, "stable.json")
    for text in ("[] []", "[{}] x", "{}", "", "[1"):
        open(path, "w").write(text)
        with pytest.raises(Exception, match="JSON array"):
            read_stable_json(spark, path).collect()


def test_a_vendor_with_a_number_for_a_name(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "s"))
    path = os.path.join(scratch, "stable.json")
    recs = [{"vendor_short_name": v, "article_id": 1, "pim_category_id": "A"} for v in ("007", "a/b=c d", " ", None)]
    json.dump(recs, open(path, "w"))
    store.write_stable(read_stable_json(spark, path), "20260101-000000")
    assert sorted(e.vendor_key for e in store.manifest("20260101-000000")) == ["007", "a/b=c d"]
    assert sorted(r.vendor_short_name for r in store.read_stable()[0].collect()) == ["007", "a/b=c d"]
