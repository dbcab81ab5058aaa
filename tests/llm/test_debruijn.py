import hashlib
import random
import re

import numpy as np
import pytest

from taxorule.llm import debruijn as D


def plain(rows, window):
    """Per row: (words, removed, words that stay), by a table of all windows."""
    least = {}
    inf = (1, 0)
    rank = lambda i: inf if i is None else (0, i)
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (i, _), ws in zip(rows, words):
        for k in range(len(ws) - window + 1):
            w = tuple(ws[k:k + window])
            least[w] = min(rank(i), least.get(w, inf))
    out = []
    for (i, _), ws in zip(rows, words):
        gone = [False] * len(ws)
        for k in range(len(ws) - window + 1):
            if least[tuple(ws[k:k + window])] < rank(i):
                gone[k:k + window] = [True] * window
        out.append((len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return out


def corpus(seed, window):
    rng = random.Random(seed)
    bag = [f"w{k}é" for k in range(300)]
    text = lambda n: " ".join(rng.choices(bag, k=n))
    shared = [text(window + rng.randint(-3, 2 * window)) for _ in range(5)]
    texts = [text(rng.choice([1, window - 1, window, 4 * window])) for _ in range(40)]
    texts += [f"{text(rng.randint(0, window))} {rng.choice(shared)} {text(rng.randint(0, window))}" for _ in range(40)]
    for t in texts[:25]:  # near copies: a word changed, added or gone
        ws = t.split()
        ws[rng.randrange(len(ws)):][:1] = rng.choice([[], ["new"], ["new", "one"]])
        texts.append(" \n".join(ws[:len(ws) // 2]) + "\t" + " ".join(ws[len(ws) // 2:]))
    long = text(9 * window)
    texts += [long, f"{long} {long}", long[: len(long) // 2] + " x " + long, "a b " * window, "z " * 5 * window,
              "a b " * window + "c", "", None, " \x1f \x0b", texts[7], texts[7]] + ["hot " + long] * 30
    rows = [(rng.randrange(10_000), t) for t in texts]
    rows += [(None, texts[3]), (None, texts[45]), (None, "only null " * window), (None, "only null " * window)]
    rows += rows[:6] + [(rows[50][0], f"other {shared[0]}"), (rows[51][0], f"more {shared[0]} end")]
    rng.shuffle(rows)
    return rows


def found(spark, rows, **how):
    df = spark.createDataFrame([(t, i, "u", 3, "k") for i, t in rows],
                               "text string, doc_id long, u string, g int, kept string").repartition(5)
    return [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in D.dedup(df, **how).collect()]


def by(x):
    return (x[0] is None, x[0] or 0, *x[1:])


@pytest.mark.parametrize("seed, window, key", [(1, 12, 4), (2, 50, 16), (3, 7, 7), (4, 12, 2)])
def test_words_equal_brute_force(spark, seed, window, key):
    rows = corpus(seed, window)
    want = sorted(((i, *p) for (i, _), p in zip(rows, plain(rows, window))), key=by)
    got = sorted(found(spark, rows, window=window, key=key), key=by)
    assert got == want
    assert any(0 < w[2] < w[1] for w in want)


def test_cut_long_text_and_digest(spark, monkeypatch):
    monkeypatch.setattr(D, "CHUNK", 64)
    rows = corpus(5, 12)
    want = sorted(((i, n, gone, hashlib.sha256(kept.encode()).hexdigest())
                   for (i, _), (n, gone, kept) in zip(rows, plain(rows, 12))), key=by)
    assert sorted(found(spark, rows, window=12, key=4, digest=True), key=by) == want


def test_empty_null_and_short(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None), (1, "a  b")]) in ([(None, 0, 0, ""), (1, 2, 0, "a b")],
                                                         [(1, 2, 0, "a b"), (None, 0, 0, "")])


def test_unverified_span_stays(spark):
    h = D._Hashes().of([b"a", b"b", b"c"])
    check = int(np.bitwise_xor.reduce(D.rolled(h, 2, D._BASES[1]).view(np.int64)))
    z = D.zstandard.ZstdCompressor().compress(b"a b c")
    span = "struct<start:int,n:int,check:long,v:long,w:long>"
    df = spark.createDataFrame([(1, 1, z, [(0, 2, check, None, None)]), (2, 2, z, [(0, 2, check + 1, None, None)])],
                               f"t long, s long, z binary, spans array<{span}>")
    out = df.mapInArrow(D._cut(2, False), "t long, s long, n_removed long, kept string").collect()
    assert sorted(map(tuple, out)) == [(1, 1, 3, ""), (2, 2, 0, "a b c")]


def test_paths_have_no_branches(spark):
    """Sequences 1 2 3 4 and 1 2 3 5: the path 1 2 3 ends where the two part."""
    rows = [(1, 1, 0, 2), (2, 2, 1, 3), (3, 3, 2, 4), (4, 4, 3, 0)]
    rows += [(e, e, 4096 + k, after) for k, (e, after) in enumerate([(1, 2), (2, 3), (3, 5), (5, 0)])]
    df = spark.createDataFrame(rows, "e long, f long, at long, after long")
    got = {(r.e, r.length) for r in D._paths(df).collect()}
    assert got == {(1, 3), (4, 1), (5, 1)}
