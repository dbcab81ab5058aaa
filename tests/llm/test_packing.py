import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as public
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from taxorule.llm import packing as P

HF = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
RANKS = P.encoder(public.path(P.RANKS), public.PATTERN)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_rank_form_gives_the_ids_of_the_json_vocabulary(text):
    for t in (text, f"a{text}<|endoftext|> {text}\n"):
        assert RANKS.encode(t, allowed_special="all", disallowed_special=()) == HF.encode(t, add_special_tokens=False).ids


def test_pieces():
    assert [p[:3] for p in P.pieces_of(list(range(5)), 2)] == [(0, 0, 1), (1, 1, 2), (2, 3, 2)]
    assert [p[:3] for p in P.pieces_of([7, 8], 2)] == [(0, 0, 2)]
    assert P.pieces_of([1], 2) == [(0, 0, 1, zlib.crc32(b"\x01\0\0\0"))]


def check_plan(counts, capacity, **how):
    bins = P.plan(counts, capacity, **how)
    seen = defaultdict(list)
    for length, lo, hi, _, _ in P.slots(bins):
        seen[length] += range(lo, hi + 1)
    for length in range(capacity + 1):
        assert sorted(seen[length]) == list(range(counts[length]))
    for b in bins:
        assert b.space == capacity - sum(x for x, _ in b.items) >= 0 and b.count > 0
    return sum(b.count for b in bins)


def test_plans_are_complete_and_tight():
    rng = np.random.default_rng(1)
    for capacity, n in ((10, 50), (100, 3000), (256, 20000)):
        counts = np.bincount(np.minimum(rng.gamma(2.0, capacity / 5, n).astype(int) + 1, capacity), minlength=capacity + 1)
        low = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
        for how in ({}, {"small": capacity // 8}, {"groups": 3}):
            assert check_plan(counts, capacity, **how) <= 1.03 * low + 2
    assert check_plan(np.zeros(11, int), 10) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 6))
def test_any_plan_is_complete(lengths, groups):
    check_plan(np.bincount(lengths, minlength=21), 20, groups=groups, small=5)


def test_query_against_the_tokenizer(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("abc é\n<|>", k=rng.choice([0, 5, 400, 9000]))) for _ in range(60)] + [None, "", "x"]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(3, texts[3], 5), (None, "null id", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id int")
    got = P.pack(docs).collect()
    want = sorted((str(i), p) for i, t, _ in rows for p in P.pieces_of(HF.encode(t or "", add_special_tokens=False).ids + [0], 2048))
    assert sorted((str(r.doc_id), (r.piece, r.start, r.length, r.ids_crc32)) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for runs in by.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= 2048
    low = -(-sum(r.length for r in got) // 2048)
    assert len(by) <= low + 2 and P.pack(docs.limit(0)).count() == 0


def test_the_plan_needs_no_python_workers_of_its_own(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert "ExistingRDD" not in P.pack(docs)._jdf.queryExecution().toString()
    assert P.pack(docs).count() == 2 and P.pack(docs.limit(0)).count() == 0
