import random
import re

from taxorule.llm import licenses as L


def plain(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for label, phrase in (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")):
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def texts():
    rng = random.Random(3)
    vocab = ["Under", "the", "MIT", "license", "apache", "License,", "Version", "2.0", "2", "CC", "BY-NC", "by", "nc",
             "é", "-", "x y", "\n"]
    out = [" ".join(rng.choices(vocab, k=rng.choice([0, 2, 6, 60, 400]))) for _ in range(120)]
    return out + ["", None, "Released under the MIT License.", "cc-by-nc " * 300, "under the MIT", "ccbync",
                  "under the\tmit (LICENSE) under the mit license"]


def test_base_equals_brute_force(spark):
    rows = [(i, t, "l") for i, t in enumerate(texts())] + [(0, texts()[0], "l"), (None, "CC BY NC", "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = L.scan(docs).collect()
    assert len(got) == len(rows) and L.scan(docs.limit(0)).count() == 0
    by = {r.doc_id: r for r in got}
    for i, t, _ in rows:
        r = by[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)


def test_notices_with_small_changes(spark):
    notice = dict(L.NOTICES)["bsd"].split()
    changed = notice[:6] + ["any"] + notice[6:11] + notice[12:]
    rows = [(0, "intro words " + " ".join(notice) + " rest"), (1, " ".join(changed)), (2, " ".join(notice[:7])),
            (3, " ".join(reversed(notice))), (4, "This work is licensed under the GNU General Public License, version 3.")]
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].labels == got[1].labels == "bsd" and got[0].score == 1.0 > got[1].score > 0.9
    assert got[2].labels == got[3].labels == "" and got[4].labels == "gpl-3" and got[4].n_base == 0


def test_notices_that_differ_by_a_word(spark):
    by_nc, by, apache = (dict(L.NOTICES)[x] for x in ("cc-by-nc", "cc-by", "apache-2"))
    gpl = "Licensed under the GNU General Public License version "
    long = by.replace("creative commons", "creative commons as its authors all wish it to be")
    cases = [(by, "cc-by"), (by_nc, "cc-by-nc"), (gpl + "3", "gpl-3"), (gpl + "2", ""), (apache.replace("version 2 0", "version 1 1"), ""),
             (by.replace("attribution", "attribution sharealike"), ""), (by_nc.replace("noncommercial", "non-commercial"), "cc-by-nc"),
             (gpl.replace("General", "Lesser General") + "3", ""), (by + " " + by_nc, "cc-by,cc-by-nc"), (by_nc + " " + by, "cc-by,cc-by-nc"),
             (by.replace(" is ", " was ").replace("commons", "common"), "cc-by"), (long, "cc-by"),
             (gpl + "2 or any other that is fit. " + gpl + "3", "gpl-3"), ((by + " ") * 60 + by_nc, "cc-by,cc-by-nc")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in L.scan(df).collect()}
    assert [got[i] for i in range(len(cases))] == [x for _, x in cases]


def test_repeated_rows_vote_once(spark):
    df = spark.createDataFrame([(0, L.NOTICES[4][1])] * 3, "doc_id long, text string")
    assert [(r.labels, r.n_base, r.score) for r in L.scan(df).collect()] == [("bsd", 0, 1.0)] * 3
