"""Quality rules: a decision list of threshold conjunctions, learned by sequential covering.

Text statistics are computed for every document. From labelled ones the learner grows rules
for bad documents (add the test with the best information gain until no good document is
covered), prunes each on rows it was not grown on, removes what the rule covers and goes on.
The list becomes one ordered Spark CASE expression, so scoring stays in the JVM.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, table

SYMBOLS = "#*$%&|<>"  # fixed value
#: Rules are fitted on at most this many labelled rows, chosen by a hash of their id.
FIT_ROWS = 20_000

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS_TYPE = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long>"

#: The features that tests are made of, as SQL over the statistics.
FEATURES = {
    "n_words": "cast(n_words AS double)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
}


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0
    spaces = sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    repeats = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            seen = Counter(windows)
            hit = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
            covered = np.zeros(n, bool)
            for shift in range(3):
                covered[shift:n - 2 + shift] |= hit
            repeats = int(covered.sum())
    return n, len(text) - spaces, symbols, len(lines) - len(set(lines)), repeats


def stats_udf():
    @F.pandas_udf(STATS_TYPE)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_stats(t) for t in texts], columns=list(STATS), dtype="int64")
    return of


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool  # feature > cut, else feature <= cut
    cut: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.cut!r}D"

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        x = rows[self.feature]
        return x > self.cut if self.above else x <= self.cut


Rule = tuple[Test, ...]


def covers(rule: Rule, rows: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for test in rule:
        out &= test.holds(rows)
    return out


def _best_test(rows: dict[str, np.ndarray], bad: np.ndarray, live: np.ndarray) -> tuple[float, Test | None]:
    """The test with the highest gain: bad rows kept times the fall in bits to name a bad row."""
    p0, n0 = int((bad & live).sum()), int((~bad & live).sum())
    base = math.log2(p0 / (p0 + n0))
    best, found = 0.0, None
    for name, values in rows.items():
        x, y = values[live], bad[live]
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        cut_at = np.flatnonzero(x[1:] > x[:-1])
        if not len(cut_at):
            continue
        p_low = np.cumsum(y)[cut_at].astype(float)
        n_low = cut_at + 1 - p_low
        for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), -1.0)
            i = int(np.argmax(gain))
            if gain[i] > best + 1e-9:
                best, found = float(gain[i]), Test(name, above, float(x[cut_at[i]] + x[cut_at[i] + 1]) / 2)
    return best, found


def learn_rules(rows: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_tests: int = 4,
                min_precision: float = 0.95, min_rows: int = 5) -> list[Rule]:
    """Ordered rules for bad rows. A rule is kept if, after pruning, at least ``min_precision`` of
    the rows it covers are bad, both among all remaining rows and among those held back for
    pruning, and at least ``min_rows`` bad ones are covered. No bad or no good rows: no rules."""
    n = len(bad)
    held = np.arange(n) % 3 == 2
    live, rules = np.ones(n, bool), []
    while len(rules) < max_rules and (bad & live).sum() >= min_rows and (~bad & live).any():
        rule: Rule = ()
        grow = live & ~held
        while len(rule) < max_tests and (bad & grow).any() and (~bad & grow).any():
            _, test = _best_test(rows, bad, grow)
            if test is None:
                break
            rule += (test,)
            grow &= test.holds(rows)

        def worth(r: Rule) -> float:
            c = covers(r, rows, n) & live & held
            p, q = int((c & bad).sum()), int((c & ~bad).sum())
            return (p - q) / (p + q) if p + q else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = covers(rule, rows, n) & live
        p, q = int((hit & bad).sum()), int((hit & ~bad).sum())
        if not rule or p < min_rows or p < min_precision * (p + q) or worth(rule) < 2 * min_precision - 1:
            break
        rules.append(rule)
        live &= ~hit
    return rules


def rule_expression(rules: list[Rule]) -> Column:
    """Index (from 1) of the first rule that covers the row, 0 if none does."""
    if not rules:
        return F.lit(0)
    return F.expr("CASE " + " ".join(
        f"WHEN {' AND '.join(t.sql() for t in rule)} THEN {i}" for i, rule in enumerate(rules, 1)) + " ELSE 0 END")


def fit_rules(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **options) -> list[Rule]:
    """Learn from ``stats`` joined to ``labels (doc_id, quality)`` on the id. At most
    ``fit_rows`` labelled rows reach the driver: those with the smallest id hash. An id with
    several labels is bad if any of them is 0; null ids and null qualities are left out."""
    bad = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("_quality"))
    sample = (stats.filter("NOT base_failed").join(bad, "doc_id")
              .select((F.col("_quality") == 0).alias("bad"), F.xxhash64("doc_id").alias("_h"), "doc_id",
                      *[F.expr(sql).alias(f"f_{name}") for name, sql in FEATURES.items()])
              .orderBy("_h", "doc_id", *[f"f_{name}" for name in FEATURES]).limit(fit_rows).toPandas())
    rows = {name: sample[f"f_{name}"].to_numpy(float) for name in FEATURES}
    return learn_rules(rows, sample["bad"].to_numpy(bool), **options)


def rate(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
         fit_rows: int = FIT_ROWS) -> tuple[DataFrame, list[Rule]]:
    """``doc_id``, the statistics, ``base_failed, rule, kept`` for every row, and the learned list.

    Null, empty and blank texts have zero statistics and fail the base. Repeated rows are rated
    alike, each on its own row; without labels only the base decides. Other columns are ignored.
    """
    stats = keep(docs.select(F.col(id_col).alias("doc_id"), stats_udf()(F.col(text_col)).alias("s")).select(
        "doc_id", "s.*", F.expr("s.n_words < 50 OR 100 * s.n_repeat_words > 50 * s.n_words").alias("base_failed")),
        "text-stats")
    rules = fit_rules(stats, labels, fit_rows)
    rule = rule_expression(rules)
    return stats.select("*", rule.alias("rule"), (~F.col("base_failed") & (rule == 0)).alias("kept")), rules


def q_rulelist(spark, sf_dir: str) -> DataFrame:
    return rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]
