"""Match-document ingest and training-set operators (FIXTURES 1a, 2d, 2e, 2f, 2h)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from taxorule.operators import training as tr
from taxorule.schemas import TRAINING_DDL
from taxorule.sources.match import match_products, read_match_documents, read_match_products

DOC = {
    "vc2": {"vendor_category_name": "Second", "pim_matches": [
        {"pim_category_id": "A", "pim_category_name": "Alpha", "assignment_source": "existing_category_match",
         "products": [{"article_id": 7, "keywords": [" k1 ", None, "", 3], "class_codes": {"system": "S", "code": 1}},
                      {"article_id": " ", "keywords": "k2"},
                      "not a product",
                      {"article_id": 0, "keywords": None}]},
        {"pim_category_id": None, "assignment_source": "ai_suggestion",
         "products": [{"keywords": ["k9"]}]},
        "not a match"]},
    "vc1": {"pim_matches": "not a list"},
    "vc0": "not an object",
}


def _docs(spark, text, vendor="V"):
    return spark.createDataFrame([(vendor, text)], "vendor_short_name string, value string")


def test_match_products_flatten_in_document_order(spark):
    rows = match_products(_docs(spark, json.dumps(DOC))).orderBy("ordinal").collect()
    assert [(r.vendor_category_id, r.match_pos, r.product_pos) for r in rows] == [
        ("vc2", 0, 0), ("vc2", 0, 1), ("vc2", 0, 3), ("vc2", 1, 0)]
    first = rows[0]
    assert first.article_id == "7" and first.keywords == [" k1 ", "3"]
    assert [tuple(c) for c in first.class_codes] == [("S", "1")]
    assert rows[1].keywords == ["k2"]
    assert rows[2].article_id == "0" and rows[2].article_id_falsy is True
    assert rows[3].pim_category_id is None and rows[3].article_id is None


def test_extract_training_and_rejects(spark):
    prods = match_products(_docs(spark, json.dumps(DOC)))
    got = tr.extract_training(prods).select("article_id").collect()
    assert sorted(r[0] for r in got) == ["0", "7"]
    rej = tr.extraction_rejects(prods).collect()
    assert [(r.vendor_category_id, r.rejected_products) for r in rej] == [("vc2", 1)]


@pytest.mark.parametrize("text", ["[1, 2]", "not json", "3"])
def test_bad_root_raises(spark, text):
    with pytest.raises(Exception, match="JSON object"):
        match_products(_docs(spark, text)).collect()


def test_duplicate_keys_last_value_wins(spark):
    # the repeated key keeps its last value (its position becomes the last one: README)
    text = '{"a": {"pim_matches": []}, "b": {"pim_matches": [{"products": [{"article_id": 1}]}]}, "a": {"pim_matches": [{"products": [{"article_id": 2}]}]}}'
    rows = match_products(_docs(spark, text)).collect()
    assert sorted((r.vendor_category_id, r.article_id) for r in rows) == [("a", "2"), ("b", "1")]


def test_read_match_file_vendor_from_name(spark, scratch):
    path = os.path.join(scratch, "acme_categoryMatchingProposals_oneVendor_to_onePim_match.json")
    with open(path, "w") as f:
        json.dump(DOC, f, indent=2)
    rows = read_match_products(spark, path).collect()
    assert {r.vendor_short_name for r in rows} == {"acme"} and len(rows) == 4


def _records(spark, rows):
    full = []
    for i, (v, a, cat, desc) in enumerate(rows):
        full.append((cat, None, None, v, None, None, None, a, desc, ["kw"], [], i, False, False))
    return spark.createDataFrame(full, TRAINING_DDL)


def test_merge_golden(spark):
    existing = _records(spark, [("V", "1", "c", "old"), ("V", "2", "c", "old"), ("W", "1", "c", "old"),
                                ("V", "", "c", "x"), (None, "3", "c", "x"), ("V", "1", "c", "older-dup")])
    new = _records(spark, [("V", " 1 ", "c", "n1"), ("V", "4", "c", "a"), ("V", "4", "c", "b")])
    got = tr.merge_stable(existing, new).orderBy("ordinal").collect()
    assert [(r.vendor_short_name, r.article_id, r.description_short) for r in got] == [
        ("V", " 1 ", "n1"), ("V", "2", "old"), ("W", "1", "old"), ("V", "4", "b")]
    # idempotent: merging the same new records again changes nothing
    again = tr.merge_stable(tr.merge_stable(existing, new), new)
    assert sorted(map(tuple, again.drop("ordinal").collect())) == sorted(map(tuple, tr.merge_stable(existing, new).drop("ordinal").collect()))


def test_merge_drops_falsy_article(spark):
    new = _records(spark, [("V", "0", "c", "zero-number")]).withColumn("article_id_falsy", F.lit(True))
    assert tr.merge_stable(_records(spark, []), new).count() == 0


def test_threshold_golden(spark):
    rows = [("V", str(i), "A", "") for i in range(10)] + [("V", str(100 + i), "B", "") for i in range(9)]
    rows += [("V", str(200 + i), " C", "") for i in range(5)] + [("V", str(300 + i), "C", "") for i in range(5)]
    rows += [("V", "400", None, ""), ("V", "401", "  ", "")]
    recs = _records(spark, rows)
    counts = {r.cat_key: r.n_products for r in tr.category_counts(recs).collect()}
    assert counts == {"A": 10, "B": 9, "C": 10}
    sub = tr.training_subset(recs, 10)
    assert {r[0] for r in sub.select("pim_category_id").distinct().collect()} == {"A", " C", "C"}
    assert sub.count() == 20


def test_category_dim_first_non_null(spark):
    full = [("A", None, "P1", "V", None, None, None, "1", None, [], [], 0, False, False),
            ("A", "N2", None, "V", None, None, None, "2", None, [], [], 1, False, False),
            ("A", "N3", "P3", "V", None, None, None, "3", None, [], [], 2, False, False)]
    dim = tr.category_dim(spark.createDataFrame(full, TRAINING_DDL)).collect()
    assert [(r.pim_category_id, r.pim_category_name, r.pim_category_path) for r in dim] == [("A", "N2", "P1")]


@pytest.mark.parametrize("text", ['{"a": {}} trailing', '{"a": {}}\n{"b": {}}', '{"a": {}}}', '{"a": {}},{"b": {}}'])
def test_text_after_the_root_raises(spark, text):
    with pytest.raises(Exception, match="all of the text"):
        match_products(_docs(spark, text)).collect()


def test_a_file_without_a_vendor_raises(spark, scratch):
    path = os.path.join(scratch, "other.json")
    open(path, "w").write("{}")
    with pytest.raises(Exception, match="no vendor"):
        read_match_documents(spark, path).collect()


@pytest.mark.parametrize("split", ["64", "300", "100000"])
def test_last_wins_follows_file_and_line(spark, scratch, split):
    def line(article, name):
        return json.dumps({"vc": {"pim_matches": [{"pim_category_id": "A", "assignment_source": "existing_category_match",
                                                   "products": [{"article_id": article, "description_short": name}]}]}})
    # the larger files come first in Spark's packing, whatever their names
    for n, (part, size) in enumerate((("part-00000", 3), ("part-00001", 40), ("part 00002", 1), ("part-00003", 15))):
        with open(os.path.join(scratch, part), "w") as f:
            f.writelines(line(i % 5, f"{part}/{i:03d}") + "\n" for i in range(size))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = read_match_products(spark, scratch, "V", json_lines=True).orderBy("ordinal").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    names = [r.description_short for r in rows]
    assert names == sorted(names) and len(names) == 59
