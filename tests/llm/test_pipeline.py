from collections import defaultdict

import duckdb
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from taxorule.llm.common import keep

from . import test_columnbwt, test_mixing, test_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(keep(stage(spark, out[-1], SF), "test-stage"))
    return out


def by_id(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_names(steps):
    assert [n for n, _ in C.STAGES] == ["quality classifier", "SimHash near-dedup", "suffix-array dedup",
                                        "source mixing", "best-fit packing"]
    for df in steps[1:-1]:
        assert df.schema.names == steps[0].schema.names and df.dtypes == steps[0].dtypes


def test_quality_keeps_clean_documents(steps):
    kept = by_id(steps[1])
    clean = duckdb.sql(f"select doc_id from '{SF}/labels.parquet' where quality = 1 and toxic = 0").fetchall()
    assert sum(d in kept for d, in clean) >= 0.95 * len(clean)
    junk = duckdb.sql(f"select doc_id from '{SF}/labels.parquet' where quality = 0").fetchall()
    assert sum(d in kept for d, in junk) <= 0.2 * len(junk)


def test_near_dedup_keeps_the_first_of_each_component(steps):
    rows = sorted(by_id(steps[1]).items())
    root = test_simhash.union([test_simhash.plain(t) for _, t in rows], 3)
    assert sorted(by_id(steps[2])) == sorted(rows[i][0] for i in set(root))


def test_repeats_are_removed(steps):
    import hashlib
    rows = sorted(by_id(steps[2]).items())
    left = by_id(steps[3])
    for (i, _), (_, gone, _, sha) in zip(rows, test_columnbwt.plain([t for _, t in rows])):
        if not gone:
            assert left[i] == dict(rows)[i]
        else:
            assert len(left[i].encode()) <= len(dict(rows)[i].encode()) - gone
            if hashlib.sha256(left[i].encode()).hexdigest() != sha:  # a character lost some of its bytes
                assert not dict(rows)[i].isascii()
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())


def test_mixture_is_near_its_targets(steps):
    size, source = {}, {}
    for r in steps[3].collect():
        size[r.doc_id], source[r.doc_id] = len((r.text or "").encode().split()), r.source
    total = defaultdict(int)
    for d, n in size.items():
        total[source[d]] += n
    want, taken, times = test_mixing.fill(dict(total)), defaultdict(int), defaultdict(int)
    for r in steps[4].collect():
        taken[r.source] += size[r.doc_id]
        times[r.doc_id] += 1
    assert max(times.values()) <= 3
    assert all(abs(taken[s] - want[s]) <= max(size.values()) for s in total)


def test_sequences_hold_every_piece(steps):
    hf = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    tokens = sum(len(hf.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in steps[4].collect())
    rows = steps[5].collect()
    assert sum(r.length for r in rows) == tokens
    used = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) <= 1.02 * tokens / 2048 + 2


def test_run_is_the_stages(spark, steps):
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(C.run(spark, SF)) == key(steps[5])
