"""What a run keeps on disk: no shuffle of a written query, no bytes of a single file twice."""

import json
import os
import time

import pytest

from taxorule.plans import run_plan
from taxorule.schemas import STRING_FIELDS, TRAINING_DDL
from taxorule.session import cut_lineage, fixed_splits
from taxorule.sources import array_file as A
from taxorule.sources import json_io, json_scan, match


def _shuffle_bytes(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def test_a_written_query_gives_up_its_shuffle_files(spark):
    """shuffle files of every step were there until the driver collected garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(key, None), _shuffle_bytes(spark)
    rows = spark.range(200_000).selectExpr("id", "sha2(cast(id AS string), 256) AS x")
    kept = cut_lineage(rows.repartition(4, "x"))
    until = time.time() + 20
    while _shuffle_bytes(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_bytes(spark) <= before and kept.count() == 200_000
    assert spark.conf.get(key, None) == was


def test_parts_go_as_they_are_joined(spark, scratch):
    """the file was there twice, as parts and whole."""
    folder = f"file://{scratch}/parts"
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").selectExpr(
        "concat(id, repeat(' 0', 40))").write.option("compression", "lz4").text(folder)
    spark.range(3).where("id > 5").coalesce(1).selectExpr("cast(id AS string)").write.option("compression", "lz4").text(f"{folder}/none")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted(n for n in os.listdir(f"{scratch}/parts") if n.startswith("part-"))
    empty = [f"none/{n}" for n in os.listdir(f"{scratch}/parts/none") if n.startswith("part-")]
    assert len(parts) == 5 and len(empty) <= 1
    whole = A._joined(spark, fs, [path(f"{folder}/{n}") for n in (*empty, *parts)])
    with open(whole.toUri().getPath()) as f:
        assert f.read() == "\n".join(f"{i}{' 0' * 40}" for i in range(1000))
    assert not [n for n in os.listdir(f"{scratch}/parts") if n.startswith("part-")]


KEYWORDS = [None, [], [""], ["", ""], ["a", None], [None], ["line\nend", "b"], ["\n"], ['q"', "back\\", "tab\t", "cr\r", "é😀", "/"],
            ["\x01", "b", "\x0b\x1f\x7f", "\x08\x0c"], ["a"] * 300, [" a ", "\\n", '"']]


@pytest.mark.parametrize("partitions", [3])
def test_keywords_of_any_kind_keep_their_layout(spark, scratch, partitions):
    """keywords travel as one text where that can hold them."""
    rows = [("A", None, "P", "v", "vc", "V", "VP", str(i), "d", k, None if k is None else [], i, False, False) for i, k in enumerate(KEYWORDS)]
    path = f"{scratch}/s.json"
    A.write_stable_file(spark.createDataFrame(rows, TRAINING_DDL), path, partitions)
    with open(path, encoding="utf-8", newline="") as f:
        got = f.read()
    want = [dict(zip(STRING_FIELDS, r)) | {"keywords": r[9], "class_codes": r[10]} for r in rows]
    assert got == json.dumps(want, indent=2, ensure_ascii=False)


def test_keywords_move_as_one_text(spark, scratch, monkeypatch):
    """every keyword was a field of a moved row."""
    seen = {}
    monkeypatch.setattr(A, "write_text_file", lambda lines, *a, **k: seen.update(lines=lines, line=k["line"]))
    rows = [("A", None, "P", "v", "vc", "V", "VP", str(i), "d", k, [], i, False, False) for i, k in enumerate([["a", "b"], ["a\n"], []])]
    A.write_stable_file(spark.createDataFrame(rows, TRAINING_DDL), f"{scratch}/s.json")
    moved = {r.ordinal: (r.words, r.keywords) for r in seen["lines"].where("section = 1").collect()}
    assert moved == {0: ("a\nb", None), 1: (None, ["a\n"]), 2: (None, [])}


def test_elements_are_cut_out_of_the_file_not_copied(spark, scratch, monkeypatch):
    """a table of all elements was written beside the file."""
    monkeypatch.setattr(json_scan, "BLOCK", 4000)
    records = [{"vendor_short_name": "v", "article_id": str(i), "keywords": [f"k{i}}}", "x,y"] * (1 + i % 9)} for i in range(3000)]
    path = f"{scratch}/s.json"
    with open(path, "w") as f:
        json.dump(records, f)
    written = []
    keep = lambda df: written.append(cut_lineage(df)) or written[-1]
    monkeypatch.setattr(json_scan, "cut_lineage", keep)
    conf = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = json_io.read_stable_json(spark, path, in_ranges=True)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    copied = sum(t.selectExpr("sum(length(piece))").first()[0] for t in written)
    assert 0 < copied < os.path.getsize(path) / 3
    # other splits by now
    got = sorted((r.ordinal, r.article_id, r.keywords) for r in rows.collect())
    assert got == [(i, r["article_id"], r["keywords"]) for i, r in enumerate(records)]


def test_splits_stay_as_planned(spark, scratch):
    with open(f"{scratch}/t.txt", "w") as f:
        f.write("line\n" * 5000)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    fixed = fixed_splits(spark.read.text(f"{scratch}/t.txt"))
    before = fixed._jdf.queryExecution().toRdd().getNumPartitions()
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert spark.read.text(f"{scratch}/t.txt").rdd.getNumPartitions() > before
        again = fixed.where("value = 'line'")
        assert again._jdf.queryExecution().toRdd().getNumPartitions() == before and again.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_members_do_not_move_to_drop_a_few_of_them(spark, scratch, monkeypatch):
    """all texts went through a shuffle to meet the members that a later one replaces."""
    monkeypatch.setattr(json_scan, "BLOCK", 2000)
    members = [f'"k{i}": {{"pim_matches": [{{"products": [{{"article_id": {i}}}, 3, {{"article_id": "x"}}]}}]}}' for i in range(300)]
    path = f"{scratch}/d.json"
    for again in ([], ['"k7": {"pim_matches": [{"products": [{"article_id": "new"}]}]}']):
        with open(path, "w") as f:
            f.write("{" + ",\n".join(members + again) + "}")
        docs = match.read_match_members(spark, path, "v")
        plan = docs._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
        got = sorted((r.vendor_category_id, r.article_id) for r in match.match_products(docs).collect())
        kept = [i for i in range(300) if not again or i != 7]
        assert got == sorted([(f"k{i}", a) for i in kept for a in (str(i), "x")] + [("k7", "new")] * len(again))


def test_a_giant_document_moves_each_text_once(spark, scratch, monkeypatch):
    """whole lines, with a text and its reverse, went through the range partitioning."""
    rows = [(i, f'text {i} "q" }}', "en", f"src{i % 20}", 9) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{scratch}/documents.parquet")
    seen, write = [], A.write_text_file
    monkeypatch.setattr(A, "write_text_file", lambda lines, *a, **k: seen.append(lines) or write(lines, *a, **k))
    got = sorted((r.article_id, r.description_short, r.vendor_category_id, r.place) for r in run_plan.q_giant_match_products(spark, scratch).collect())
    want = [(str(i), t, f"{s}#{i}", 1) for i, t, _, s, _ in rows] + [(str(-i), t[::-1], f"{s}#{i}", 2) for i, t, _, s, _ in rows]
    assert got == sorted(want)
    longest = seen[0].selectExpr(*[f"max(length({c})) AS {c}" for c, t in seen[0].dtypes if t == "string"]).first().asDict()
    assert longest.pop("text") == max(len(t) for _, t, *_ in rows) and max(longest.values()) < 30
