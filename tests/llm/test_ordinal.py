import random
import tracemalloc

import numpy as np
import pyarrow as pa

from taxorule.llm import ordinal as O


def corpus(n, seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randint(20, 90))
        grade = rng.choice([0, 1, 2, 2, 2])
        if grade == 1:
            words[rng.randrange(len(words))] = rng.choice(["Nasty!", "vile", "rotten,"])
        if grade == 0:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), 0.5))
        labels.append((i, int(grade > 0), int(grade == 1), "x"))
    return rows, labels


def test_held_out_accuracy_and_order(spark):
    rows, labels = corpus(1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string, tail_top double")
    labelled = spark.createDataFrame(labels[:1000], "doc_id long, quality int, toxic int, selected string")
    got = {r.doc_id: r for r in O.classify(docs, labelled).collect()}
    top = [q and not t for _, q, t, _ in labels]
    held = range(1000, 1500)
    assert np.mean([got[i].selected == bool(top[i]) for i in held]) > 0.95
    assert all(0 <= r.tail_top <= r.tail_1 <= 1 and abs(r.expected_grade - r.tail_1 - r.tail_top) < 1e-9 for r in got.values())
    mean = lambda g: np.mean([got[i].expected_grade for i in held if labels[i][1] + (labels[i][1] and not labels[i][2]) == g])
    assert mean(0) < mean(1) < mean(2)


def test_gradient_moves_the_likelihood_up():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(12) < 0.3) for _ in range(400)]
    score = np.array([r[r < 4].size - r[(r >= 4) & (r < 8)].size for r in rows])
    grades = np.digitize(score, [-0.5, 0.5])
    w, cuts = O.fit_ordinal(rows, grades)
    assert cuts[0] < cuts[1] and w[:4].min() > 0 > w[4:8].max() and np.abs(w[8:]).max() < w[:4].min()


def test_fit_is_the_same_in_any_layout(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, x double")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, y string")
    a, b = O.fit(docs, labelled), O.fit(docs.repartition(7), labelled.repartition(3))
    assert a.weights == b.weights and (a.cuts == b.cuts).all()


def test_edges(spark):
    rows = [(1, None, 0.0), (2, "", 0.0), (2, "", 0.0), (None, "a b c", 0.0), (4, "z" * 20000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, expected_grade double")
    none = spark.createDataFrame([(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = O.classify(docs, none).collect()
    assert len(got) == 5 and all(r.selected for r in got)
    rows_, labels = corpus(120)
    labelled = spark.createDataFrame([x[:3] for x in labels] + [(0, 0, 1), (0, None, None)], "doc_id long, quality int, toxic int")
    model = O.fit(spark.createDataFrame(rows_, "doc_id long, text string, t double"), labelled)
    rated = docs.select(O.rating(spark, model, docs.text).alias("r")).collect()
    assert len(rated) == 5 and rated[1].r == rated[2].r
    assert O.classify(docs.limit(0), labelled).count() == 0


def peak(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_fitting_task_holds_its_sample_little_more_than_once():
    rng = np.random.default_rng(3)
    lists = [np.unique(rng.integers(0, 1 << 32, 600)) for _ in range(1500)]
    for i, x in enumerate(lists):
        x[0] = i % 3  # tells the grades apart
    size = 8 * sum(map(len, lists))
    batch = pa.record_batch([pa.array(range(1500)), pa.array([i % 3 for i in range(1500)], pa.int32()), pa.array(lists)],
                            names=["h", "grade", "features"])
    out, most = peak(lambda: list(O._fit_task(3)(iter([batch]))))
    assert {0, 1, 2} <= set(out[0].column(0).to_pylist()) and most < 2 * size
    kinds, n = np.unique(np.concatenate(lists), return_counts=True)
    assert O._kinds(lists, 2).tolist() == kinds[n >= 2].tolist()


def test_rating_remembers_a_bounded_number_of_tokens(spark, monkeypatch):
    model = O.Ordinal({f: 0.5 for f in O.features("aa bb cc")}, np.array([0.1, 0.2]))
    texts = [*(" ".join(f"w{i}x{j}" for j in range(1000)) for i in range(300)), "aa bb cc", None]

    def rate():
        return [x for a in O.score_udf(spark, model).func(iter([pa.array(texts)])) for x in a.to_pylist()]
    whole, _ = peak(rate)
    monkeypatch.setattr(O, "KNOWN", 5000)
    less, most = peak(rate)
    assert less == whole and less[-2]["tail_top"] > 0.7 and most < 8 << 20
