import math
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np

from taxorule.llm import ppm as M
from taxorule.session import checkpoint_dir

MARK = 255


def corpus(seed=1, n=80):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 5))) for _ in range(40)]
    out = [" ".join(rng.choices(words, k=rng.choice([1, 5, 30, 200]))) for _ in range(n)]
    return out + ["", None, "A a a \t b", "x" * 3000]


def tables(texts, order):
    seen = defaultdict(Counter)
    for t in texts:
        data = bytes([MARK]) * order + M.folded(t) + bytes([MARK])
        for i in range(order, len(data)):
            for k in range(order + 1):
                seen[data[i - k:i]][data[i]] += 1
    return seen


def plain(seen, text, order, least=1):
    """Escape and exclusion by the definition, context by context; pruned contexts are absent."""
    data, total = bytes([MARK]) * order + M.folded(text) + bytes([MARK]), 0.0
    for i in range(order, len(data)):
        out = set()
        for k in range(order, -2, -1):
            if k < 0:
                total -= math.log10(256 - len(out))
                break
            own = seen.get(data[i - k:i], {})
            if k and sum(own.values()) < least:
                continue
            live = {s: c for s, c in own.items() if s not in out}
            if not live:
                continue
            escape = 1 + sum(c == 1 for c in live.values())
            whole = sum(live.values()) + escape
            if data[i] in live:
                total += math.log10(live[data[i]] / whole)
                break
            if len(out) + len(live) < 256:
                total += math.log10(escape / whole)
            out |= set(live)
    return total


def test_adaptive_learns_within_a_document():
    once, thrice = M.adaptive_log10(b"the cat sat. "), M.adaptive_log10(b"the cat sat. " * 3)
    assert thrice > 2 * once
    assert abs(M.adaptive_log10(b"", 2) + math.log10(256)) < 1e-9
    # "b" then the end: 1/256, then the escape (2 of 3) from the one symbol seen once to 255 others
    assert abs(M.adaptive_log10(b"b", 2) + math.log10(256 * 1.5 * 255)) < 1e-9


def test_query_equals_brute_force(spark):
    texts = corpus(5, 120)
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s"), (None, "a b", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    count = Counter()
    for i, t, _ in rows:
        if not held(i):
            count.update([*M.folded(t).split(), "end"])
    n, v = sum(count.values()), len(count)
    want = {}
    for i, t, _ in rows:
        tokens = [*M.folded(t).split(), "end"]
        want[i] = (held(i), len(tokens), sum(count[w] > 0 for w in tokens), n,
                   sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens))
    seen = tables([t for i, t, _ in rows if not held(i)], 5)
    for frequent, block, block_texts in ((10, 700, 9), (10**6, M.BLOCK, M.BLOCK_TEXTS)):
        got = M.lm_scores(docs, frequent=frequent, block=block, block_texts=block_texts).collect()
        assert len(got) == len(rows)
        for r in got:
            w = want[r.doc_id]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
            assert abs(r.base_score - w[4]) < 1e-6 * max(1, abs(w[4]))
        by = {r.doc_id: r for r in got}
        for i in (0, 7, 50):
            assert abs(by[i].score - plain(seen, texts[i], 5)) < 1e-3 + 2e-5 * abs(by[i].score)
    assert M.lm_scores(docs.limit(0)).count() == 0


def test_held_out_beats_words(spark):
    texts = [(i, " ".join(random.Random(i).choices(["river", "stone", "cloud", "green", "walking"], k=50))) for i in range(150)]
    got = M.lm_scores(spark.createDataFrame(texts, "doc_id long, text string")).filter("held_out").collect()
    assert got and all(r.score > 1.3 * r.base_score for r in got)


def test_query_keeps_every_context(spark):
    texts = corpus(7, 150) + ["totally new ÿ bytes"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for order, block in ((5, 2000), (2, 1 << 20)):
        seen = tables([t for i, t in enumerate(texts) if not M.is_held_out(i)], order)
        got = M.lm_scores(docs, order=order, block=block).collect()
        assert len(got) == len(texts) and any(r.held_out for r in got)
        for r in got:
            want = plain(seen, texts[r.doc_id], order)
            assert abs(r.score - want) < 1e-6 * max(1, abs(want)), (order, r.doc_id)
    alone = M.lm_scores(docs.filter("crc32(cast(doc_id AS string)) % 7 = 2")).collect()
    assert alone and all(abs(r.score + 8 * math.log10(2) * (len(M.folded(texts[r.doc_id])) + 1)) < 1e-6 * abs(r.score) for r in alone)


def test_many_empty_texts_keep_their_own_counts(spark):
    """More empty texts than a block holds, among some that are not."""
    texts = {i: "" for i in range(3000)} | {k: f"word{k} word{k} again" for k in range(0, 3000, 700)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    got = M.lm_scores(docs, block_texts=500).collect()
    count = Counter(w for i, t in texts.items() if not M.is_held_out(i) for w in [*t.split(), "end"])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(texts)
    for r in got:
        tokens = [*texts[r.doc_id].split(), "end"]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert abs(r.base_score - sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens)) < 1e-9 * abs(r.base_score) + 1e-9


def test_written_tables_are_smaller_than_the_texts(spark):
    """Neither the texts nor a row for each word or gram of a text are written."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(4, 9))) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=700)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    folder = checkpoint_dir(spark).removeprefix("file:")
    written = lambda: sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))
    before = written()
    assert M.lm_scores(docs, block=100_000).count() == len(texts)
    assert written() - before < 0.3 * sum(map(len, texts))
