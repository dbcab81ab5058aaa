from collections import defaultdict

from pyspark.sql import functions as F

from taxorule.llm import mixing as M


def fill(sizes, weights=(5, 2, 1)):
    """Water-filling by rounds: share by weight, clamp, reshare."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, target, live = sum(sizes.values()), {}, set(order)
    while live:
        unit = left / sum(w[s] for s in live)
        full = {s for s in live if w[s] * unit >= 3 * sizes[s]}
        for s in full:
            target[s] = 3 * sizes[s]
            left -= target[s]
        if not full:
            return target | {s: w[s] * unit for s in live}
        live -= full
    return target


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int")


def test_targets_and_taken(spark):
    rows = [(i, "w " * (i % 40), f"s{i % 7}" if i % 3 else ("hot" if i % 2 else None), 0) for i in range(1200)]
    got = M.mix(docs(spark, rows)).select("row.doc_id", "row.source", "size", "source_size", "target", "taken").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += r[0] % 40
    want, taken = fill(dict(sizes)), defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.size == r.doc_id % 40 and r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 20 for s in sizes)


def test_reruns_agree_in_any_layout(spark):
    df = docs(spark, [(i // 2, "a b " * (i % 5), "x" if i % 4 else "y", 0) for i in range(300)])
    one = sorted(map(tuple, M.mix(df, columns=["doc_id"]).select("row.doc_id", "taken").collect()))
    two = sorted(map(tuple, M.mix(df.repartition(5, F.rand(3)), columns=["doc_id"]).select("row.doc_id", "taken").collect()))
    assert one == two


def test_repeat_gives_rows_and_edges(spark):
    df = docs(spark, [(1, "a b", "x", 7), (1, "a b", "x", 7), (2, None, "y", 7), (None, "", None, 7), (3, "c", None, 7)])
    mixed = M.mix(df)
    assert M.repeat(mixed).columns == df.columns
    assert M.repeat(mixed).count() == mixed.agg(F.sum("copies")).first()[0]
    assert M.mix(df.limit(0)).count() == 0
    assert {r.target for r in M.mix(df.filter("text is null")).collect()} == {0.0}
