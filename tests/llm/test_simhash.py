import random

import numpy as np
import xxhash

from taxorule.llm import simhash as S


def plain(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def union(values, limit):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= limit:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def test_fingerprint_is_the_contract(spark):
    rng = random.Random(1)
    words = ["A", "bé", "Ça", "x\u00a0y", "ÉT", "zz", "q"]
    texts = [" \t".join(rng.choices(words, k=rng.choice([1, 2, 3, 4, 40, 300]))) for _ in range(60)]
    for t in [*texts, "", None, " \n", "one", "\u2003"]:
        assert S.simhash(t, 3, 42) == plain(t), t
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(S.fingerprint_udf(3, 42)("t")).collect()
    assert [r[0] & (2**64 - 1) for r in got] == [plain(t) for t in texts]


def clusters(rng, n):
    out = {rng.getrandbits(64) for _ in range(n)}
    for base in list(out)[:12]:
        at = base
        for _ in range(12):
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4])):
                at ^= 1 << b
            out.add(at)
    return sorted(out | {0, 2**64 - 1, 1 << 63})


def roots(spark, values, **how):
    signed = [v - 2**64 if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.root for r in S.components(S.hamming_links(fps, 3, **how)).collect()}
    return [got.get(v, v) for v in signed]


def same_classes(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_blocks_find_the_brute_force_components(spark):
    values = clusters(random.Random(5), 150)
    want = union(values, 3)
    assert same_classes(roots(spark, values), want)


def test_hot_buckets_take_the_ball_join_with_the_same_result(spark):
    values = clusters(random.Random(6), 20)
    want = union(values, 3)
    assert same_classes(roots(spark, values, pairwise_bucket=1), want)
    assert same_classes(roots(spark, values, pairwise_bucket=4), want)


def test_a_dense_group_gives_fewer_links_than_members(spark):
    rng = np.random.default_rng(3)
    base = 0x0123456789ABCDEF
    values = sorted({base} | {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (300, 2))})
    signed = [v - 2**64 if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = S.hamming_links(fps, 3)
    assert links.count() <= 20 * len(values)
    assert same_classes(roots(spark, values), union(values, 3))


def test_rows_ties_nulls_and_clashing_columns(spark):
    rows = [(5, "a b c d", 1), (3, "a b c d", 1), (3, "a b c d", 1), (9, None, 0), (None, "", 0), (8, " ", 0),
            (None, "quite other words here now", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted(((r._id, r.component_id) for r in S.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (9, 8), (None, 8), (8, 8), (None, None)], key=str)
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    import duckdb
    from taxorule.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select doc_id, text from '{d}/documents.parquet' order by 1").fetchall()
    fps = [plain(t) for _, t in rows]
    want = {r[0]: (f"{f:016x}", rows[u][0]) for r, f, u in zip(rows, fps, union(fps, 3))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash_near_dedup"](spark, d).collect()}
    assert got == want
