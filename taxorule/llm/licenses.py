"""License scans by diagonal voting.

Every rolling word k-gram of every text is hashed and joined, in Spark, to the k-grams of the
templates. A hit at word i of the text and position j of a template votes for the diagonal
i - j; each k-gram of the template votes once per diagonal, diagonals less than the template apart
(words inserted or left out) are merged into one span, and spans with enough votes are verified
on the text itself: the words in order, the words that tell the licence from others, and of
overlapping notices the one that covers its template best.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, table

K = 3

# Exact phrases and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Opening sentences of public licences, found in part or with small changes.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance "
                 "with the license"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


# Per notice, the phrases of which it must hold one, and words that make it another licence's.
DECIDING = {
    "apache-2": ("version 2",), "gpl-3": ("version 3",), "mpl-2": ("v 2", "version 2"),
    "cc-by": ("attribution",), "cc-by-nc": ("noncommercial", "non commercial"),
}
_LESSER, _CC = ("lesser", "library", "affero"), ("sharealike", "alike", "noderivatives", "noderivs", "derivatives", "derivs")
FOREIGN = {"gpl": _LESSER, "gpl-3": _LESSER, "cc-by": ("noncommercial", "commercial", *_CC), "cc-by-nc": _CC}


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    exact: bool


TEMPLATES = tuple(Template(label, tuple(text.encode().split()), exact)
                  for group, exact in ((PHRASES, True), (NOTICES, False)) for label, text in group)

#: Byte map: A-Z to a-z, bytes that are not of a word to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)  # fixed values: odd


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def grams(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Signed 64-bit hash of each K-gram, in order; ``known`` caches word hashes."""
    if len(words) < K:
        return np.empty(0, np.int64)
    for w in set(words):
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    h = np.array([known[w] for w in words], np.uint64)
    out = np.zeros(len(h) - K + 1, np.uint64)
    for i in range(K):
        out += h[i:len(h) - K + 1 + i] * _MIX[i]
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def _gram_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part, known = batch.slice(at, 512), {}
            lists = [grams(words_of(t), known) for t in part.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))],
                names=["k", "grams"])


def align(words: list[bytes], lo: int, hi: int, template: tuple[bytes, ...]) -> tuple[int, int, int]:
    """Most template words that ``words[lo:hi]`` hold in order, and the first and last word of them."""
    best, found = [(0, -1)] * (len(template) + 1), (0, -1, -1)
    for i in range(lo, hi):
        w, last = words[i], best[0]
        for j, t in enumerate(template, 1):
            old = best[j]
            best[j] = max(old, best[j - 1], (last[0] + 1, last[1] if last[0] else i) if w == t else old)
            last = old
        if best[-1][0] > found[0]:
            found = (*best[-1], i)
    return found


def occurrences(words: list[bytes], lo: int, hi: int, template: tuple[bytes, ...],
                min_cover: float) -> Iterator[tuple[int, int, int]]:
    """Places that hold ``min_cover`` of the template within three times its length."""
    size = len(template)
    while lo < hi:
        end = min(hi, lo + 3 * size)
        n, first, last = align(words, lo, end, template)
        if n / size >= min_cover:
            yield from occurrences(words, lo, first, template, min_cover)
            yield n, first, last
            lo = last + 1
        elif end == hi:
            return
        else:
            lo += size


def decided(label: str, words: list[bytes]) -> bool:
    """Whether the words hold what tells the licence from others, and nothing of another's."""
    text = b" " + b" ".join(words) + b" "
    needed = DECIDING.get(label, ())
    return ((not needed or any(f" {p} ".encode() in text for p in needed))
            and not any(f" {w} ".encode() in text for w in FOREIGN.get(label, ())))


OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
       "labels string, score double")


def _verify(min_cover: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                words = words_of(text.as_py())
                places, base, extra, score, notices = [], set(), set(), 0.0, []
                for s in spans or ():
                    t = TEMPLATES[s["template"]]
                    if t.exact:
                        lo = s["lo"]
                        if tuple(words[lo:lo + len(t.words)]) == t.words:
                            places.append(lo)
                            base.add(t.label)
                            score = 1.0
                    else:
                        hi = min(len(words), s["hi"] + 2 * len(t.words))
                        notices += [(n / len(t.words), n, first, last, t.label) for n, first, last in occurrences(
                                        words, max(0, s["lo"] - len(t.words)), hi, t.words, min_cover)
                                    if decided(t.label, words[first:last + 1])]
                taken: list[tuple[int, int]] = []  # disjoint and sorted
                for cover, _, first, last, label in sorted(notices, key=lambda x: (-x[0], -x[1], x[2:])):
                    at = bisect(taken, (first, last))
                    if (at and taken[at - 1][1] >= first) or (at < len(taken) and taken[at][0] <= last):
                        continue
                    taken.insert(at, (first, last))
                    extra.add(label)
                    score = max(score, cover)
                rows.append((doc_id, len(words), len(places), min(places, default=None), max(places, default=None),
                             ",".join(sorted(base)), ",".join(sorted(base | extra)), score))
            if rows:
                types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_cover: float = 0.8) -> DataFrame:
    """License labels of every row of ``docs``.

    A phrase needs every vote of its diagonal, then equal words; a notice needs the k-grams that are
    left when each of the words it may lack under ``min_cover`` costs it K, on diagonals at most its
    own length apart, then ``min_cover`` of its words in order with its deciding words; it must not
    overlap a notice that covers its template better, or as well and is longer.
    Null and empty texts have no words and no labels. Repeated rows share one set of votes, in which
    a k-gram counts once, and each give a row. Other columns only tell rows apart. Empty tables give no rows. A text of
    any length is one list of hashes in one row; its hits, not its words, are regrouped.
    """
    spark = docs.sparkSession
    known: dict[bytes, int] = {}
    positions = [(int(g), i, j) for i, t in enumerate(TEMPLATES) for j, g in enumerate(grams(list(t.words), known))]
    places = spark.createDataFrame(positions, "gram long, template int, j int")  # a few hundred rows, fixed
    facts = spark.createDataFrame(
        [(i, t.exact, len(t.words), max(1, len(t.words) - K + 1 - (0 if t.exact else K * int((1 - min_cover) * len(t.words) + 1e-9))))
         for i, t in enumerate(TEMPLATES)], "template int, exact boolean, n_words int, bar int")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), row_key(docs).alias("k"))
    found = rows.select("k", "text").mapInArrow(_gram_lists, "k long, grams array<long>")
    hits = (found.select("k", F.posexplode("grams").alias("i", "gram")).join(F.broadcast(places), "gram"))
    votes = hits.groupBy("k", "template", (F.col("i") - F.col("j")).alias("diagonal")).agg(
        F.expr("bit_or(shiftleft(1L, j))").alias("votes"))  # no template has 64 k-grams
    spans = spark.sql("""
        SELECT k, collect_set(named_struct('template', template, 'lo', lo, 'hi', hi)) AS spans
        FROM (SELECT k, template, bar, run, min(diagonal) AS lo, max(diagonal) AS hi, bit_count(bit_or(votes)) AS votes
              FROM (SELECT *, sum(CASE WHEN diagonal - before <= n_words AND NOT exact THEN 0 ELSE 1 END) OVER (
                              PARTITION BY k, template ORDER BY diagonal) AS run
                    FROM (SELECT v.*, f.exact, f.n_words, f.bar,
                                 lag(diagonal) OVER (PARTITION BY v.k, v.template ORDER BY diagonal) AS before
                          FROM {votes} v JOIN {facts} f ON v.template = f.template))
              GROUP BY k, template, bar, run)
        WHERE votes >= bar
        GROUP BY k""", votes=votes, facts=F.broadcast(facts))
    return rows.join(spans, "k", "left").select("id", "text", "spans").mapInArrow(_verify(min_cover), OUT)


def q_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
