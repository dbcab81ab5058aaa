"""Language-model scoring by prediction by partial matching over bytes.

Contexts are the last 0 to ``order`` bytes; a document starts and ends with a mark byte that no
UTF-8 text holds. In a context with T counted symbols of which t were seen once, a symbol
counted c times has probability c / (T + t + 1), and (t + 1) / (T + t + 1) escapes to the next
shorter context, where symbols already ruled out are excluded from all of these numbers; below
the empty context all symbols left are equally likely.

Pretrained scoring keeps every context of the training documents, as tables in Spark. The cost of
a symbol depends on the (order + 1)-gram that ends in it alone. Tasks count the distinct grams of
their texts, sorted and in one row a bucket of contexts; grams that training does not hold meet the
counts of shorter contexts in joins (see ``gram_costs``). The most frequent grams and words, of a
fixed number at most, go to the tasks with their costs; a text's other grams and words are joined.

``adaptive_log10`` is the one-document form that learns as it reads.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, shuffle_partitions, table

MARK = 0xFF
ORDER = 5
#: Bytes of text that a task counts or scores at a time; a longer text is taken alone.
BLOCK = 8 << 20
#: Texts in a block at most: empty ones take next to no bytes.
BLOCK_TEXTS = 1 << 18
#: Bytes of a block's text whose grams are listed at a time.
SLICE = 2 << 20
#: Distinct grams that a task gathers before it sends their counts on.
GATHER = 1 << 21
#: Grams, and words, that are sent to the tasks with their costs, at most: those used most. Others
#: are joined.
FREQUENT = 1 << 20


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


# ---------------------------------------------------------------- adaptive, one document

def adaptive_log10(data: bytes, order: int = ORDER) -> float:
    """log10 probability of ``data`` and its end, from an empty trie that counts as it reads."""
    trie: dict[bytes, dict[int, int]] = {}
    past, total = bytes([MARK]) * order, 0.0
    for symbol in data + bytes([MARK]):
        out: set[int] = set()
        for k in range(order, -2, -1):
            if k < 0:
                total -= math.log10(256 - len(out))
                break
            seen = {s: c for s, c in trie.get(past[len(past) - k:], {}).items() if s not in out}
            if not seen:
                continue
            escape = 1 + sum(c == 1 for c in seen.values())
            whole = sum(seen.values()) + escape
            if symbol in seen:
                total += math.log10(seen[symbol] / whole)
                break
            if len(out) + len(seen) < 256:
                total += math.log10(escape / whole)
            out |= seen.keys()
        for k in range(order + 1):
            own = trie.setdefault(past[len(past) - k:], {})
            own[symbol] = own.get(symbol, 0) + 1
        past = (past + bytes([symbol]))[1:]
    return total


# ---------------------------------------------------------------- every context, as tables

def _blocks(batches: Iterator[pa.RecordBatch], limit: int, most: int) -> Iterator[tuple[list, list, list[bytes]]]:
    """Ids, whether held out, and folded texts: about ``limit`` bytes and at most ``most`` texts at a time."""
    ids, held, texts, size = [], [], [], 0
    for batch in batches:
        for i, text, out in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            data = folded(text.as_py())
            if texts and (size + len(data) + ORDER > limit or len(texts) >= most):
                yield ids, held, texts
                ids, held, texts, size = [], [], [], 0
            ids.append(i)
            held.append(out)
            texts.append(data)
            size += len(data) + ORDER
    if texts:
        yield ids, held, texts


def _codes(texts: list[bytes], order: int) -> np.ndarray:
    """The gram of each byte and of the end of each text, in order, as a number."""
    lead = bytes([MARK]) * order
    flat = np.frombuffer(b"".join([lead + t for t in texts]) + bytes([MARK]), np.uint8)
    code = np.zeros(len(flat) - order, np.int64)
    for i in range(order + 1):
        code <<= 8
        code |= flat[i:len(flat) - order + i]
    # windows that end inside the lead of the next text, past its first mark, are of no text
    use = np.ones(len(code), bool)
    ends = np.cumsum([len(t) + order for t in texts])[:-1]
    for i in range(1, order):
        use[ends - order + i] = False
    return code[use]


def _slices(texts: list[bytes], limit: int = SLICE) -> Iterator[slice]:
    """Runs of texts of about ``limit`` bytes."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield slice(lo, i)
            lo, size = i, 0
        size += len(t)
    yield slice(lo, len(texts))


Counts = tuple[np.ndarray, np.ndarray, np.ndarray]


def _together(parts: list[Counts]) -> Counts:
    """Distinct grams in order, and the sums of their two counts."""
    if len(parts) == 1:
        return parts[0]
    grams, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n, held = (np.bincount(which, np.concatenate([p[i] for p in parts]), len(grams)).astype(np.int64) for i in (1, 2))
    return grams, n, held


def _gram_counts(order: int, buckets: int, limit: int, most: int):
    """Distinct grams of a task's texts, in order in one row a bucket of contexts, and how often
    training texts and the others hold them."""
    def rows(counts: Counts) -> Iterator[pa.RecordBatch]:
        bucket = ((counts[0] >> 8).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)
        by = np.argsort(bucket, kind="stable")
        bucket = bucket[by].astype(np.int32)
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[first, len(by)]
        for lo in range(0, len(first), 64):
            at = ends[lo:lo + 65]
            offsets = pa.array((at - at[0]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[at[:-1]]),
                 *(pa.ListArray.from_arrays(offsets, pa.array(x[by[at[0]:at[-1]]])) for x in counts)],
                names=["bucket", "gram", "n", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[Counts] = []
        for _, held, texts in _blocks(batches, limit, most):
            held, parts = np.array(held, bool), []
            for at in _slices(texts):
                which, grams = pd.factorize(_codes(texts[at], order))
                trained = np.repeat(~held[at], [len(t) + 1 for t in texts[at]])
                n = np.bincount(which[trained], minlength=len(grams))
                by = np.argsort(grams)
                parts.append((grams[by], n[by], (np.bincount(which, minlength=len(grams)) - n)[by]))
            gathered = [_together(gathered + parts)]
            if len(gathered[0][0]) > GATHER:
                yield from rows(gathered[0])
                gathered = []
        if gathered:
            yield from rows(gathered[0])
    return run


def gram_table(texts: DataFrame, order: int = ORDER, block: int = BLOCK, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """``gram, n, uses`` of every gram of the rows ``id, text, held``: its count in training texts and
    in all; of its context, ``mass`` (counted symbols), ``once`` (symbols counted once) and whether it is
    ``open`` (holds a symbol that training does not). A bucket's grams are in one task, and a context's in one
    bucket; a task sends at most 256 counts of a context at a time."""
    n = shuffle_partitions(texts.sparkSession)
    packed = texts.mapInArrow(_gram_counts(order, 4 * n, block, block_texts),
                              "bucket int, gram array<long>, n array<long>, held array<long>")
    counted = (packed.repartition(n, "bucket").selectExpr("bucket", "inline(arrays_zip(gram, n, held))")
               .withColumn("context", F.expr("gram >> 8")).groupBy("bucket", "context", "gram")
               .agg(F.sum("n").alias("n"), F.sum("held").alias("held")))
    return keep(counted.selectExpr(
        "gram", "n", "n + held AS uses", "sum(n) OVER (PARTITION BY bucket, context) AS mass",
        "count_if(n = 1) OVER (PARTITION BY bucket, context) AS once",
        "min(n) OVER (PARTITION BY bucket, context) = 0 AS open"), "grams")


def gram_costs(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, uses, cost`` (log10 probability of the gram's last symbol after the others) of
    every row of ``grams``, a ``gram_table``.

    Grams that training holds need their longest context alone. The
    others are joined with the counts of shorter contexts. The counts of each order sum those of
    the next longer one. What follows a context follows its shorter form too, so the symbols ruled
    out at a context are those of the next longer one: two sums over a context's symbols, joined
    with the counts of its shorter form, give its escape there. These joins meet at most 256 rows
    of a key. Tables that have 65,536 rows at most, whatever the input, are broadcast.
    """
    sums = {order: grams.filter("n > 0")}
    for k in range(order - 1, -1, -1):
        sums[k] = keep(sums[k + 1].groupBy(F.expr(f"gram & {(1 << (8 * (k + 1))) - 1}L").alias("gram"))
                       .agg(F.sum("n").alias("n")), f"grams-{k}")
    contexts: dict[int, DataFrame] = {}
    for k in range(order + 1):
        # of the longest contexts, only those before a symbol that training does not hold there
        here = (sums[k].filter("open") if k == order else sums[k]).selectExpr("gram >> 8 AS context", "n", f"gram & {(1 << (8 * k)) - 1}L AS shorter")
        if k:
            below = sums[k - 1].selectExpr("gram AS shorter", "n AS m")
            rows = here.join(below, "shorter").groupBy("context").agg(
                F.sum("n").alias("mass"), F.expr("count_if(n = 1)").alias("once"), F.count("*").alias("kinds"),
                F.sum("m").alias("m"), F.expr("count_if(m = 1)").alias("m_once"))
            rows = rows.withColumn("shorter", F.expr(f"context & {(1 << (8 * (k - 1))) - 1}L")).join(
                contexts[k - 1].selectExpr("context AS shorter", "mass AS s_mass", "once AS s_once", "kinds AS s_kinds"),
                "shorter").selectExpr(
                    "context", "mass", "once", "kinds", "s_mass - m AS live", "s_once - m_once + 1 AS escape", "s_kinds")
            rows = rows.selectExpr(
                "context", "mass", "once", "kinds", "log10(live + escape) AS s_whole",
                "CASE WHEN live > 0 AND s_kinds < 256 THEN log10(escape) - log10(live + escape) ELSE 0D END AS s_out")
        else:
            rows = here.groupBy("context").agg(
                F.sum("n").alias("mass"), F.expr("count_if(n = 1)").alias("once"), F.count("*").alias("kinds")).selectExpr(
                    "*", "0D AS s_whole", "0D AS s_out")
        contexts[k] = keep(rows.selectExpr(
            "*", "log10(mass + once + 1) AS whole",
            "CASE WHEN kinds < 256 THEN log10(once + 1) - log10(mass + once + 1) ELSE 0D END AS out"), f"contexts-{k}")

    def joined(rows: DataFrame, k: int) -> DataFrame:
        context = contexts[k].selectExpr("context", "whole AS x_whole", "out AS x_out", "s_whole AS x_s_whole", "s_out AS x_s_out", "kinds")
        return (rows.withColumn("context", F.expr(f"(gram >> 8) & {(1 << (8 * k)) - 1}L"))
                .join(F.broadcast(context) if k <= 2 else context, "context", "left"))

    # spent: escapes so far; s_whole, s_out: at the next shorter context, null until a known one
    rows = joined(grams.filter("n = 0").select("gram", "uses"), order).selectExpr(
        "gram", "uses", "cast(NULL AS double) AS cost", "coalesce(x_out, 0D) AS spent", "x_s_whole AS s_whole", "x_s_out AS s_out")
    for k in range(order - 1, -1, -1):
        own = sums[k].selectExpr("gram AS own", "n")
        rows = joined(rows.withColumn("own", F.expr(f"gram & {(1 << (8 * (k + 1))) - 1}L"))
                      .join(F.broadcast(own) if k <= 1 else own, "own", "left"), k).selectExpr(
            "gram", "uses", "coalesce(cost, spent + log10(n) - coalesce(s_whole, x_whole)) AS cost",
            "spent + coalesce(s_out, x_out, 0D) AS spent", "x_s_whole AS s_whole", "x_s_out AS s_out",
            *(["kinds"] if k == 0 else []))
    seen = grams.filter("n > 0").selectExpr("gram", "uses", "log10(n) - log10(mass + once + 1) AS cost")
    rest = rows.selectExpr("gram", "uses", "coalesce(cost, spent - log10(256 - coalesce(kinds, 0))) AS cost")
    return keep(seen.unionByName(rest).selectExpr("gram", "uses", "cast(cost AS float) AS cost"), "costs")


# ---------------------------------------------------------------- words and scores

def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; the distinct words' hashes; which of them each word is, text by text."""
    words = [t.split() for t in texts]
    flat = np.array(list(chain.from_iterable(words)) + [None], dtype=object)[:-1]
    which, kinds = pd.factorize(flat)
    return (np.array([len(w) for w in words], np.int64),
            np.array([xxhash.xxh64_intdigest(w) - (1 << 63) for w in kinds], np.int64), which)


def _token_counts(limit: int, most: int):
    """Distinct words of the training documents of a block, with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, texts in _blocks(batches, limit, most):
            _, kinds, which = _words([t for t, out in zip(texts, held) if not out])
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.bincount(which, minlength=len(kinds)))],
                                             names=["word", "c"])
    return run


def _level(count: str):
    """Sixteen steps to each doubling of a count."""
    return F.floor(F.log2(count) * 16)


def _bar(table: DataFrame, count: str, most: int) -> int:
    """The least level from which on up ``table`` has at most ``most`` rows."""
    levels = table.filter(F.col(count) > 0).groupBy(_level(count).alias("level")).count().collect()
    bar, rows = 1024, 0
    for level, n in sorted(levels, reverse=True):
        rows += n
        if rows > most:
            break
        bar = level
    return bar


def _sorted(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and their values, of a table with one row a key."""
    found = table.toArrow()
    keys = found.column(0).to_numpy()
    by = np.argsort(keys)
    return keys[by], found.column(1).to_numpy()[by]


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted key is there, and its value, else 0."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    there = keys[at] == wanted
    return there, np.where(there, values[at].astype(np.float64), 0.0)


def _listed(values: np.ndarray, text: np.ndarray, n: int) -> pa.ListArray:
    """The values of each of ``n`` texts; ``text`` does not fall."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)).astype(np.int32)), pa.array(values))


#: A text is known by its task and its place there.
SCORED = ("task int, row long, id long, n long, known long, base double, score double, "
          "grams array<long>, words array<long>")


def _scores(order: int, sent, zero: float, limit: int, most: int):
    """Per text: words, base and score over what was sent, and the grams and words that were not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, costs, frequent, gains = sent.value
        task, row = TaskContext.get().partitionId(), 0
        for ids, _, texts in _blocks(batches, limit, most):
            for at in _slices(texts):
                own, m = texts[at], at.stop - at.start
                which, kinds = pd.factorize(_codes(own, order))
                there, cost = _looked_up(grams, costs, kinds)
                first = np.cumsum([0, *(len(t) + 1 for t in own[:-1])])
                score = np.add.reduceat(cost[which], first)
                left = np.flatnonzero(~there[which])
                left_grams = _listed(kinds[which[left]], np.searchsorted(first, left, "right") - 1, m)
                n, kinds, which = _words(own)
                there, gain = _looked_up(frequent, gains, kinds)
                text = np.repeat(np.arange(m), n)
                left = np.flatnonzero(~there[which])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, task, np.int32)), pa.array(np.arange(row, row + m)), pa.array(ids[at], pa.int64()),
                     pa.array(n + 1), pa.array(np.bincount(text[there[which]], minlength=m)),
                     pa.array(np.bincount(text, gain[which], m) + zero * (n + 1)), pa.array(score),
                     left_grams, _listed(kinds[which[left]], text[left], m)],
                    names=["task", "row", "id", "n", "known", "base", "score", "grams", "words"])
                row += m
    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
              frequent: int = FREQUENT, block: int = BLOCK, block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """Word-unigram base score and PPM score of every row, both learned from the rows whose
    ``crc32(id) mod 7`` is not 2.

    The base is log10((c + 1) / (N + V + 1)) summed over a text's words and its end. At most
    ``frequent`` words, those training counts most, and as many grams, those all texts use most, go to
    the tasks with their costs. Every other gram or word of a text is a row that is joined with the whole
    table of the others, so a gram of the join is in about one of ``frequent`` rows at most.
    Words are joined by their 64-bit hash.
    Null and empty texts are their end alone. Null ids hash as the empty text. Repeated rows
    are scored alike and count as often as they occur. Without training rows N = V = 0 and
    every byte is equally likely. Other columns are ignored. Empty tables give no rows.

    Every context is kept.
    """
    spark = docs.sparkSession
    held = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(7)) == 2
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), held.alias("held"))
    vocabulary = keep(rows.mapInArrow(_token_counts(block, block_texts), "word long, c long")
                      .groupBy("word").agg(F.sum("c").alias("c")).selectExpr("word", "c", "log10(c + 1) AS gain"), "words")
    n_docs = rows.filter("NOT held").count()
    n_words, kinds = vocabulary.agg(F.sum("c"), F.count("*")).first()
    n_total = (n_words or 0) + n_docs
    v_total = kinds + (1 if n_docs else 0)
    costs = gram_costs(gram_table(rows, order, block, block_texts), order)
    word_bar, gram_bar = _bar(vocabulary, "c", frequent), _bar(costs, "uses", frequent)
    sent = spark.sparkContext.broadcast((*_sorted(costs.filter(_level("uses") >= gram_bar).select("gram", "cost")),
                                         *_sorted(vocabulary.filter(_level("c") >= word_bar).select("word", "gain"))))
    scored = keep(rows.mapInArrow(_scores(order, sent, -math.log10(n_total + 1.0 * (v_total + 1)), block, block_texts),
                                  SCORED), "scored")
    grams = scored.select("task", "row", F.explode("grams").alias("gram")).join(
        costs.filter(_level("uses") < gram_bar), "gram").selectExpr("task", "row", "0 AS more", "0D AS gain", "cost")
    words = scored.select("task", "row", F.explode("words").alias("word")).join(
        vocabulary.filter(_level("c") < word_bar), "word").selectExpr("task", "row", "1 AS more", "gain", "0D AS cost")
    found = grams.unionByName(words).groupBy("task", "row").agg(
        F.sum("more").alias("more"), F.sum("gain").alias("gain"), F.sum("cost").alias("cost"))
    end_known = 1 if n_docs else 0
    out = scored.drop("grams", "words").join(found, ["task", "row"], "left")
    return out.select(
        F.col("id").alias("doc_id"),
        (F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(7)) == 2).alias("held_out"),
        F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("more", F.lit(0)) + end_known).alias("n_known"),
        F.lit(n_total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0)) + math.log10(n_docs + 1)).alias("base_score"),
        (F.col("score") + F.coalesce("cost", F.lit(0.0))).alias("score"))


def q_ppm(spark, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
