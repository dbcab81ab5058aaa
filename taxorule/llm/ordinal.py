"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut
its score: P(grade >= j) = sigmoid(score - threshold_j). The expected grade and the tail
probability of the top grade rate and select documents.

Grades of the label table: 0 poor quality, 1 good quality but toxic, 2 good and not toxic.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, slices, table

#: The model is fitted on at most this many labelled documents, those with the least id hash.
FIT_ROWS = 16_000
#: A document is selected if its tail probability of the top grade is at least this.
SELECT = 0.7
TOP = 2
#: Tokens whose features a rating task remembers.
KNOWN = 100_000
PREFIX = 5
_EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”„…"
_UPPER = bytes(range(65, 91))
_SYMBOL = b"#*$%&|<>"
_DIGIT = b"0123456789"


def _hash(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode("utf-8", "surrogatepass"))


def word_features(token: str) -> tuple[int, ...]:
    """Hashes of one lower-cased token: the word without edge punctuation, and its first letters."""
    word = token.strip(_EDGE)
    if not word:
        return (_hash("t", token[:8]),)
    return (_hash("w", word), _hash("p", word[:PREFIX])) if len(word) >= PREFIX else (_hash("w", word),)


def shape_features(text: str, tokens: list[str], kinds: int) -> list[int]:
    """Hashes of the deciles of a few shares of the whole text."""
    data = text.encode("utf-8", "surrogatepass")
    size = max(1, len(data))
    share = {name: (size - len(data.translate(None, of))) / size
             for name, of in (("upper", _UPPER), ("symbol", _SYMBOL), ("digit", _DIGIT), ("bang", b"!"))}
    share["kinds"] = kinds / max(1, len(tokens)) if len(tokens) >= 20 else 1.0
    same = sum(a == b for a, b in zip(tokens, tokens[1:]))
    share["same"] = same / max(1, len(tokens))
    fine = [_hash("s", f"{name}{min(20, int(20 * x))}") for name, x in share.items()]
    return [*fine, _hash("s", f"length{len(tokens).bit_length()}"),
            _hash("s", f"width{min(20, size // max(1, len(tokens)))}")]


def features(text: str | None) -> list[int]:
    """Distinct feature hashes of a text (null: the empty text)."""
    text = text or ""
    tokens = text.lower().split()
    kinds = set(tokens)
    out = set(shape_features(text, tokens, len(kinds)))
    for t in kinds:
        out.update(word_features(t))
    return sorted(out)


@dataclass
class Ordinal:
    """``weights`` by feature hash; ``cuts`` are the ordered thresholds of grades 1..TOP."""

    weights: dict[int, float]
    cuts: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1..TOP, a column each."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -500, 500)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, epochs: int = 12, rate: float = 0.4,
                l2: float = 1e-4, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts by AdaGrad on the cumulative-link likelihood.

    ``rows`` hold feature indices. The cuts are the first one and positive steps, so their order
    cannot break."""
    size = 1 + max((int(r.max()) for r in rows if len(r)), default=0)
    w, seen = np.zeros(size), np.full(size, 1.0)
    first, steps, moved = -2.0, np.zeros(TOP - 1), np.ones(TOP)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, g = rows[i], int(grades[i])
            cuts = np.concatenate([[first], first + np.cumsum(np.exp(steps))])
            s = w[at].sum()
            f = [1.0, *(1 / (1 + math.exp(min(500.0, max(-500.0, c - s)))) for c in cuts), 0.0]
            p = max(f[g] - f[g + 1], 1e-9)
            d_s = 1 - f[g] - f[g + 1]
            d_cut = np.zeros(TOP)
            if g > 0:
                d_cut[g - 1] -= f[g] * (1 - f[g]) / p
            if g < TOP:
                d_cut[g] += f[g + 1] * (1 - f[g + 1]) / p
            grad = d_s - l2 * w[at]
            seen[at] += grad * grad
            w[at] += rate * grad / np.sqrt(seen[at])
            d = np.concatenate([[d_cut.sum()], np.cumsum(d_cut[::-1])[::-1][1:] * np.exp(steps)])
            moved += d * d
            first += rate * d[0] / math.sqrt(moved[0])
            steps = np.clip(steps + rate * d[1:] / np.sqrt(moved[1:]), -4, 4)
    return w, np.concatenate([[first], first + np.cumsum(np.exp(steps))])


def association(rows: Iterable[np.ndarray], grades: np.ndarray, size: int) -> np.ndarray:
    """Likelihood-ratio statistic of each feature's presence against the grade."""
    n = np.bincount(grades, minlength=TOP + 1).astype(float)[:, None]
    with_it = np.zeros((TOP + 1, size))
    for r, g in zip(rows, grades):
        np.add.at(with_it[g], r, 1)
    share = with_it.sum(0)[None, :] / n.sum()
    total = np.zeros(size)
    for seen, expected in ((with_it, n * share), (n - with_it, n * (1 - share))):
        ok = seen > 0
        total += 2 * np.where(ok, seen * np.log(np.where(ok, seen, 1) / np.where(ok, expected, 1)), 0).sum(0)
    return total


def _kinds(lists: list[np.ndarray], least: int) -> np.ndarray:
    """The values, sorted, that at least ``least`` of the lists of distinct values hold."""
    flat = np.concatenate(lists)
    flat.sort()
    n = max(0, len(flat) - least + 1)
    return flat[:n][np.r_[True, flat[1:] != flat[:-1]][:n] & (flat[:n] == flat[least - 1:])]


def _pick(kinds: np.ndarray, lists: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Each list's positions in the sorted ``kinds``, values not in it left out."""
    for x in lists:
        i = np.searchsorted(kinds, x)
        ok = i < len(kinds)
        ok[ok] = kinds[i[ok]] == x[ok]
        yield i[ok]


def _list_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, grade, text): the text's features in its place."""
    for batch in slices(batches):
        lists = [np.array(features(t.as_py()), np.int64) for t in batch.column(2)]
        ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))],
            names=["h", "grade", "features"])


def _fit_task(min_docs: int):
    """All sample rows in, one row per kept feature out; the cuts come under negative keys.

    Only features that tell grades apart get a weight (statistic of at least 15 plus one for each
    250 rows); the many rare words of long texts would add up to noise."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, grades, lists = [], [], []
        for b in batches:
            order += b.column(0).to_pylist()
            grades += b.column(1).to_pylist()
            lists += [x.values.to_numpy().astype(np.uint32) for x in b.column(2)]
        if not lists:
            return
        by = np.argsort(np.array(order, np.int64), kind="stable")
        grades, lists = np.array(grades)[by], [lists[i] for i in by]
        kinds = _kinds(lists, min_docs)
        kinds = kinds[association(_pick(kinds, lists), grades, len(kinds)) >= 15 + len(lists) / 250]
        rows = list(_pick(kinds, lists))
        w, cuts = fit_ordinal(rows, grades)
        w = w[: len(kinds)] if len(w) >= len(kinds) else np.r_[w, np.zeros(len(kinds) - len(w))]
        keys = np.r_[kinds, -1 - np.arange(TOP)]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.r_[w, cuts])], names=["feature", "weight"])
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        fit_rows: int = FIT_ROWS, min_docs: int = 3) -> Ordinal | None:
    """Fit on the labelled documents with the least id hashes, ``fit_rows`` at most.

    An id with several labels takes the worst of them; null ids and null qualities are left out,
    a null toxicity is none. The sample (ids and grades, of bounded size) is broadcast to the
    documents; only its documents' features go to the fitting task. None without labels."""
    graded = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id"))
              .agg(F.min(F.when(F.col("quality") <= 0, 0).when(F.col("toxic") > 0, 1).otherwise(2)).alias("grade"))
              .select("_id", "grade", F.xxhash64("_id").alias("h")).orderBy("h", "_id").limit(fit_rows))

    sample = keep(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
                  .join(F.broadcast(graded), "_id").select("h", "grade", "text")
                  .mapInArrow(_list_features, "h long, grade int, features array<long>"), "graded")
    found = sample.repartition(1).mapInArrow(_fit_task(min_docs), "feature long, weight double").toPandas()
    if not len(found):
        return None
    cuts = found[found.feature < 0].sort_values("feature", ascending=False)["weight"].to_numpy()
    own = found[(found.feature >= 0) & (found.weight != 0)]
    return Ordinal(dict(zip(own.feature.tolist(), own.weight.tolist())), cuts)


def score_udf(spark, model: Ordinal):
    """Column function: text to struct(expected_grade, tail_1, tail_top)."""
    sent = spark.sparkContext.broadcast((model.weights, model.cuts))

    @F.arrow_udf("struct<expected_grade:double,tail_1:double,tail_top:double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Ordinal(*sent.value)
        weights, known = model.weights, {}
        for texts in batches:
            scores = np.zeros(len(texts))
            for i, text in enumerate(texts):
                text = text.as_py() or ""
                tokens = text.lower().split()
                kinds = set(tokens)
                # words share prefixes: a feature counts once a document
                own = set(shape_features(text, tokens, len(kinds)))
                for t in kinds:
                    f = known.get(t)
                    if f is None:
                        f = known[t] = tuple(x for x in word_features(t) if x in weights)
                    own.update(f)
                scores[i] = math.fsum(weights[x] for x in own if x in weights)
                if len(known) > KNOWN:
                    known.clear()
            tails = model.tails(scores)
            yield pa.StructArray.from_arrays([pa.array(tails.sum(1)), pa.array(tails[:, 0]), pa.array(tails[:, -1])],
                                             names=["expected_grade", "tail_1", "tail_top"])
    return of


def rating(spark, model: Ordinal | None, text: Column) -> Column:
    """The rating of a text column; without a model every text is of the top grade."""
    if model is None:
        return F.struct(F.lit(float(TOP)).alias("expected_grade"), F.lit(1.0).alias("tail_1"),
                        F.lit(1.0).alias("tail_top"))
    return score_udf(spark, model)(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, expected_grade, tail_1, tail_top, selected`` for every row.

    Null and empty texts are rated by their shape alone. Repeated rows are rated alike, each on
    its own row. Without usable labels everything is selected. Other columns are ignored. An
    empty table gives no rows."""
    model = fit(docs, labels, id_col, text_col, fit_rows)
    rated = docs.select(F.col(id_col).alias("doc_id"), rating(docs.sparkSession, model, F.col(text_col)).alias("r"))
    return rated.select("doc_id", "r.*").withColumn("selected", F.col("tail_top") >= SELECT)


def q_ordinal(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
