import hashlib
import random

import numpy as np

from taxorule.llm import lzprint as Z


def phrases(data):
    seen, at, out = set(), b"", []
    for b in data:
        at += bytes([b])
        if at not in seen:
            seen.add(at)
            out.append(at)
            at = b""
    return out


def plain(text):
    """The fingerprint from the phrase strings."""
    sums = []
    for p in phrases((text or "").encode()):
        s = 7
        for b in p:
            s = (s * Z._STEP + b + 1) & Z._MASK
        sums.append(s)
    return Z.as_text(Z.digest(Z.least(sums)))


def texts():
    rng = random.Random(7)
    out = ["".join(rng.choices("abcd é\n", k=rng.choice([0, 1, 3, 4, 7, 300, 3000]))) for _ in range(70)]
    return out + [None, "", "x" * 5000]


def test_query_equals_brute_force_in_any_layout(spark):
    rows = [(i * 3, t, "f") for i, t in enumerate(texts())] + [(9, texts()[3], "f"), (None, "first of all", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(5)
    got = sorted(map(tuple, Z.phrase_fingerprints(docs).collect()), key=str)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want = []
    for (i, t, _), (_, nxt, _) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        q = len(t) // 4
        e = t[: len(t) - q] + nxt[:q]
        a, b, c = (np.frombuffer(bytes.fromhex(plain(x)), ">u2") for x in (t, e, nxt))
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), plain(t), plain(e),
                     Z.likeness(a, b), Z.likeness(a, c)))
    assert got == sorted(want, key=str)


def test_single_row_and_empty(spark):
    docs = spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")
    got = Z.phrase_fingerprints(docs).collect()
    assert [(r.doc_id, r.near_next) for r in got] == [(4, 1.0)]
    assert got[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert Z.phrase_fingerprints(docs.limit(0)).count() == 0


def test_likeness_orders_texts():
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    a = " ".join(rng.choices(words, k=500))
    near = a[:3000] + " ".join(rng.choices(words, k=20)) + a[3000:]
    far = "".join(rng.choices("klmnopqrst ", k=len(a)))
    print_of = lambda t: Z.Document(t).fingerprint
    assert Z.likeness(print_of(a), print_of(a)) == 1.0
    assert Z.likeness(print_of(a), print_of(near)) > 0.5 > 0.2 > Z.likeness(print_of(a), print_of(far))


def test_boundaries_take_one_small_task_a_partition(spark):
    """Four boundaries a partition, without four partitions (and their sort and aggregate memory) for them."""
    docs = spark.createDataFrame([(i * 7 % 4001, f"text {i}") for i in range(4001)], "doc_id long, text string")
    context, n = spark.sparkContext, int(spark.conf.get("spark.sql.shuffle.partitions"))
    context.setJobGroup("boundaries", "boundaries")
    try:
        found = Z.phrase_fingerprints(docs)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("boundaries") for s in tracker.getJobInfo(j).stageIds]
    assert stages and all(s.numTasks <= max(n, context.defaultParallelism) for s in stages if s)
    assert found.count() == 4001
    (batch,) = Z._quarters(iter([Z.pa.RecordBatch.from_pydict({"id": list(range(100, 0, -1))})]))
    assert batch.column(0).to_pylist() == [1, 26, 51, 76]
