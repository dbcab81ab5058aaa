import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from taxorule.llm import rulelist as R


def plain(text):
    text = text or ""
    words, at = [], ""
    for c in text + " ":
        if c in " \t\n\v\f\r":
            if at:
                words.append(at)
            at = ""
        else:
            at += c
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            dup += line in seen
            seen.add(line)
    tri = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if tri[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="ab \n\t\u2003\x1cé#|", max_size=80)))
def test_stats_are_the_contract(text):
    assert R.text_stats(text) == plain(text)


def test_learned_list_separates_and_spares_good_rows():
    rng = np.random.default_rng(0)
    n = 3000
    rows = {k: rng.random(n) for k in R.FEATURES}
    bad = (rows["symbols_per_word"] > 0.8) | ((rows["repeat_share"] > 0.6) & (rows["n_words"] <= 0.3))
    rules = R.learn_rules(rows, bad)
    found = np.zeros(n, bool)
    for r in rules:
        found |= R.covers(r, rows, n)
    assert (found & bad).sum() >= 0.95 * bad.sum()
    assert (found & ~bad).sum() <= 0.02 * (~bad).sum()


def test_no_labels_of_one_kind_give_no_rules():
    rows = {k: np.arange(30.0) for k in R.FEATURES}
    assert R.learn_rules(rows, np.zeros(30, bool)) == [] == R.learn_rules(rows, np.ones(30, bool))


def test_query_stats_rules_and_edges(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    rows = []
    for i in range(400):
        junk = i % 4 == 0
        rows.append((i, " ".join(word() + ("###" if junk else "") for _ in range(60)), 1))
    rows += [(500, None, 0), (501, "", 0), (502, "x " * 80, 0), (502, "x " * 80, 0), (None, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rule int")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 9) for i in range(0, 300)] + [(None, 0, 0), (3, None, 0)],
                                   "doc_id long, quality int, kept int")
    got, rules = R.rate(docs, labels)
    out = got.collect()
    assert len(out) == len(rows) and rules
    by = {r.doc_id: r for r in out}
    for i, text, _ in rows:
        r = by[i]
        assert tuple(r[c] for c in R.STATS) == plain(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert all(by[i].kept == (i % 4 != 0) for i in range(400))
    kept = R.rate(docs, labels.limit(0))[0].filter("kept").count()
    assert kept == 400
    assert R.rate(docs.limit(0), labels)[0].count() == 0
