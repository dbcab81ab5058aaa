"""What a task holds does not grow with the tables, and costly steps run once."""

import json
import os

from taxorule import session
from taxorule.functions import sqltext as q
from taxorule.functions.text import PY_WHITESPACE
from taxorule.operators import training as tr
from taxorule.plans import binding_plan
from taxorule.plans.pipeline import IMPORT_TS, run_vendor
from taxorule.schemas import TRAINING_DDL
from taxorule.sources import array_file
from taxorule.sources.json_scan import root_members
from taxorule.sources.store import SnapshotStore


def _record(i, category, keywords=("k",)):
    return (category, "N", "P", "v", "vc", "VC", "VP", str(i), "d", list(keywords), [], i, False, category == "falsy")


def _records(spark, rows):
    return spark.createDataFrame(rows, TRAINING_DDL)


def test_subset_deals_out_the_records_of_one_category(spark):
    """F2, F8, F9: all records of a category met in one task."""
    rows = ([_record(i, "A") for i in range(400)] + [_record(400 + i, " A ") for i in range(3)] + [_record(500, "B"), _record(501, None),
            _record(502, " ")] + [_record(600 + i, "falsy") for i in range(20)])
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = tr.training_subset(_records(spark, rows), 402)
        found = out.selectExpr("ordinal", "spark_partition_id() AS p").collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert sorted(r.ordinal for r in found) == list(range(403))
    assert len({r.p for r in found}) > 3
    assert tr.training_subset(_records(spark, rows), 404).count() == 0


def test_occurrences_are_dealt_out_by_the_size_of_the_table(spark, scratch, monkeypatch):
    """the number of tasks was that of the shuffle, whatever the table."""
    rows = [(i, f"a b a  w{i % 7}\tx{i}", "en" if i % 3 else "fr", f"src{i % 20}", 9) for i in range(200)]
    path = f"{scratch}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    want = sorted((r.article_id, r.n_occurrences, r.n_distinct_keywords)
                  for r in binding_plan.q_keyword_occurrences(spark, scratch).collect())
    assert len(want) == 190 and ("7", 5, 4) in want
    monkeypatch.setattr(session, "WORD_TASK_BYTES", 100)
    tasks = session.word_tasks(spark.read.parquet(path))
    df = binding_plan.q_keyword_occurrences(spark, scratch)
    assert tasks > 20
    assert df._jdf.queryExecution().toString().count(f"{tasks}), REPARTITION_BY_NUM") == 2
    assert sorted((r.article_id, r.n_occurrences, r.n_distinct_keywords) for r in df.collect()) == want


def test_lines_are_laid_out_in_order(spark, scratch):
    """a line's SQL runs behind the range partitioning, whose sample runs what stands before it."""
    path = os.path.join(scratch, "out.txt")
    array_file.write_text_file(spark.range(50).selectExpr("49 - id AS k", "id AS x"), path, ["k"], 3, line="concat(k, ':', x)")
    with open(path) as f:
        assert f.read() == "\n".join(f"{k}:{49 - k}" for k in range(50))


def test_blank_members_are_told_without_counting_characters(spark, scratch):
    """every character of every member was counted."""
    path = os.path.join(scratch, "doc.json")
    with open(path, "w") as f:
        json.dump({"a": 1, "b": {"c": [" ", "}"]}}, f)
    members = root_members(spark, path, "{", "an object")
    assert "regexp_count" not in members._jdf.queryExecution().toString()
    assert [r.text.strip() for r in members.orderBy("member").collect()] == ['"a": 1', '"b": {"c": [" ", "}"]}']


def test_lists_of_strings_read_like_any_other(spark):
    """a list of strings is taken in one piece; all others come out as before."""
    lists = ['["a", " ", "", null, " b "]', '[1, "a"]', '[true, 1.5, null]', '[1, 2]', '[]', '[null]', '"x"', 'null', '[["a"], {"b": 1}]',
             '["\\u00a0", "\\u00a0z", "é"]']
    d = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x string")
    df = q.run(spark, f"SELECT i, {q.extraction_keywords('v')} AS k FROM (SELECT i, parse_json(x) AS v FROM {{d}}) ORDER BY i", d=d)
    assert "ARRAY<STRING>" in df._jdf.queryExecution().toString()
    assert [r.k for r in df.collect()] == [["a", " b "], ["1", "a"], ["True", "1.5"], ["1", "2"], [], [], ["x"], [], ['["a"]', '{"b":1}'],
                                           [" z", "é"]]


def test_words_are_stripped_as_python_does(spark):
    """the short way round btrim gives what btrim gives."""
    ends = ["", *PY_WHITESPACE, "!", "~", "\x7f", "é", "a", "​", "𝄞"]
    words = [a + m + b for a in ends for m in ("", "x", "x y", "~") for b in ends]
    d = spark.createDataFrame([(i, w) for i, w in enumerate(words)] + [(-1, None)], "i int, w string")
    got = {r.i: (r.s, r.v) for r in d.selectExpr("i", f"{q.strip_word('w')} AS s", f"{q.visible_word('w')} AS v").collect()}
    assert got == {-1: (None, None), **{i: (w.strip(), w.strip() != "") for i, w in enumerate(words)}}
    texts = ["a b", "a\x0bb", " a 　 b\t", "　", "", "a b c"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    same = d.selectExpr("i", f"{q.split_keywords('t')} AS a", f"array_remove(split(t, {q.SPLIT_EXACT}), '') AS b").collect()
    assert [r.a for r in same] == [r.b for r in same]


def test_counts_of_an_imported_base_are_written_once(spark, scratch):
    """the new counts and the previous pairs both read them."""
    root = os.path.join(scratch, "store")
    store = SnapshotStore(spark, root)
    store.write_stable(_records(spark, [_record(i, "A", ["k1", " k2 "]) for i in range(12)]), IMPORT_TS)
    products = _records(spark, [_record(100 + i, "A", ["k1"]) for i in range(3)]).selectExpr(
        "* EXCEPT (vendor_short_name)", "'w' AS vendor_short_name", "'existing_category_match' AS assignment_source")
    res = run_vendor(spark, root, None, "w", run_ts="20260101-000000", products=products)
    at = store.run_path("base_counts", "w", "20260101-000000")
    assert all(store.complete(f"{at}/{t}") for t in ("categories", "pairs", "names"))
    assert sorted(map(tuple, spark.read.parquet(f"{at}/pairs").collect())) == [("A", "k1", 12), ("A", "k2", 12)]
    assert res.metrics["merged_records"] == 15 and res.metrics["previous_pairs"] == 2
