import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from taxorule.llm import columnbwt as B


def plain(texts, width=200):
    """Per text: (bytes, removed, runs, sha256 of the rest), by a table of all strings."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - width + 1):
            s = d[i:i + width]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, bool)
        for i in range(len(d) - width + 1):
            if seen[d[i:i + width]] > 1:
                gone[i + 1:i + 1 + width] = True
        runs = int((gone[1:] & ~gone[:-1]).sum())
        left = bytes(b for b, g in zip(d, gone[1:]) if not g)
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(200)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    shared = [text(60) for _ in range(4)]
    out = [text(rng.choice([1, 20, 60, 300])) for _ in range(60)]
    out += [a + rng.choice(shared) + b for a, b in ((text(rng.randint(0, 40)), text(rng.randint(0, 40))) for _ in range(30))]
    for t in out[:10]:  # near copies
        at = rng.randrange(len(t))
        out.append(t[:at] + "#" + t[at:])
    long = text(400)
    return out + [out[3], out[3], long[:199], long[:200], long[50:250], long + text(5) + long[:400], "", None,
                  "ab" * 400, "x" * 1000, "x" * 199, "\0" * 300, "é" * 250]


def check(spark, texts, **how):
    rows = [(i, t, "v") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(5)
    found = B.with_spans(docs, **how).select("row.doc_id", "row.text", "spans").mapInArrow(B._digest, B.OUT).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}
    want = plain(texts, how.get("width", 200))
    assert len(found) == len(texts)
    for i in range(len(texts)):
        assert got[i] == want[i], (i, (texts[i] or "")[:40])


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_equal_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_hot_anchors_and_small_collections(spark):
    check(spark, corpus(3), collection=1)
    check(spark, corpus(4), collection=4)


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    texts = corpus(5)
    rows = [(i, B._bytes(t)) for i, t in enumerate(texts)]
    whole = sum(max(0, len(d) - 199) for _, d in rows)
    monkeypatch.setattr(B, "CHUNK", 700)
    pieces = [x for held in B._pieces(iter(rows), 200) for x in held]
    assert sum(max(0, len(p) - 199) for _, _, p in pieces) == whole
    assert all(p == dict(rows)[k][at:at + len(p)] for k, at, p in pieces)


def test_columns_equal_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        m, columns, width = int(rng.integers(1, 12)), 14, 4
        cells = rng.integers(0, 2, (m, columns)).astype(np.uint8)
        lo, hi = rng.integers(0, 6, m), rng.integers(8, 15, m)
        group = rng.integers(0, 3, m).astype(np.uint16)
        hit = B.repeated_columns(cells, lo, hi, group, width)
        for i in range(m):
            for c in range(columns):
                own = lo[i] <= c and c + width <= hi[i]
                want = own and any(
                    j != i and group[j] == group[i] and lo[j] <= c and c + width <= hi[j]
                    and (cells[i, c:c + width] == cells[j, c:c + width]).all() for j in range(m))
                assert hit[i, c] == want


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(1, "r" * 250), (1, "r" * 250), (None, "long text " * 40), (None, None), (5, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = B.with_spans(docs).select("row.doc_id", "row.text", "spans").mapInArrow(B._digest, B.OUT).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in out) == [(0, 0), (5, 0), (250, 250), (250, 250), (400, 400)]
    assert B.with_spans(docs.limit(0)).count() == 0
    left = B.remove_repeats(docs).collect()
    assert sorted("null" if r.text is None else r.text for r in left) == ["", "", "", "null", "short"]


def test_anchors_of_common_phrases_do_not_repeat():
    """Texts that share phrases of 48 bytes in different surroundings share next to no anchor."""
    rng = random.Random(9)
    letters = lambda n: bytes(rng.choices(range(97, 123), k=n))
    phrases = [letters(48) for _ in range(5)]
    texts = [b"".join(rng.choice(phrases) + letters(20) for _ in range(200)) for _ in range(20)]
    _, _, _, _, anchors, _ = B.Chunk(texts).segments(200)
    assert len(anchors) > 1000 and len(np.unique(anchors)) > 0.99 * len(anchors)


def test_packed_texts_come_back(spark):
    texts = ["", None, "é" * 300, "plain \0 text"]
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "`a.text` string, id long")
    got = B.with_spans(docs, "a.text").select("row.*").collect()
    assert sorted((r["id"], r["a.text"]) for r in got) == list(enumerate(texts))


def test_a_task_hashes_little_at_a_time():
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcdefgh ", k=4000)) for _ in range(500)]
    batch = pa.record_batch([pa.array(range(500)), pa.array(texts)], names=["k", "text"])
    tracemalloc.start()
    strings = sum(sum(b.column(2).to_pylist()) for b in B._segment_rows(200)(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert strings == 500 * 3801 and most < 32 << 20
