"""Best-fit packing with linear grouping.

Documents become token pieces of at most the capacity. How pieces are put together depends on
their lengths alone, and there are at most ``capacity`` different lengths, so the plan is made
on the driver from a table of that many counts, whatever the corpus holds:

* large lengths, sorted, are split into groups of equal cardinality and rounded up to the
  largest of their group (linear grouping);
* the few sizes that remain are packed by the configuration linear program, solved by column
  generation with a knapsack as pricing step, and rounded down;
* the actual lengths are put in place of the rounded ones, in runs of equal bins;
* what is left, small lengths included, goes by best fit decreasing into the space left.

Spark then numbers the pieces of each length and joins the numbers to the plan's runs.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, shuffle_partitions, slices, table

CAPACITY = 2048
END_ID = 0
#: Vocabulary of byte_bpe_50k.json in rank form, and its special token (fixed values).
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}


def encoder(ranks_path: str, pattern: str):
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)


def pieces_of(ids: list[int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32): the first piece takes what whole pieces leave over."""
    flat = np.array(ids, "<u4")
    first = (len(flat) - 1) % capacity + 1
    edges = [0, *range(first, len(flat) + 1, capacity)]
    return [(i, a, b - a, zlib.crc32(flat[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:]))]


def _cut(ranks_path: str | None, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers as public
        enc = encoder(ranks_path or public.path(RANKS), public.PATTERN)
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode(text.as_py() or "", allowed_special="all", disallowed_special=())
                ids.append(END_ID)
                out += [(doc_id, *p) for p in pieces_of(ids, capacity)]
            if out:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


@dataclass
class Bins:
    """``count`` bins with equal contents: ``items`` are (length, rank of the first bin's piece);
    the next bins take the following ranks."""

    count: int
    space: int
    items: list[tuple[int, int]]

    def split(self, n: int) -> Bins:
        """Take the first n bins off."""
        head = Bins(n, self.space, list(self.items))
        self.count -= n
        self.items = [(length, rank + n) for length, rank in self.items]
        return head

    def put(self, length: int, rank: int, times: int) -> None:
        self.items += [(length, rank + i * self.count) for i in range(times)]
        self.space -= times * length


def _price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(int(sizes.min()), capacity + 1):
        fits = np.flatnonzero(sizes <= c)
        gains = best[c - sizes[fits]] + values[fits]
        i = int(np.argmax(gains))
        if gains[i] > best[c - 1] + 1e-12:
            best[c], pick[c] = gains[i], fits[i]
        else:
            best[c], pick[c] = best[c - 1], -1
    counts, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            counts[pick[c]] += 1
            c -= sizes[pick[c]]
    return best[capacity], counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 600) -> list[tuple[int, np.ndarray]]:
    """(times, counts per size): the configuration program over few sizes by column generation,
    rounded down. Demands that the rounding leaves are for the caller."""
    base = np.diag(capacity // sizes).astype(float)
    amount = demand / np.diag(base)
    for _ in range(rounds):
        dual = np.linalg.solve(base.T, np.ones(len(sizes)))
        worth, column = _price(np.maximum(dual, 0), sizes, capacity)
        if worth <= 1 + 1e-9:
            break
        way = np.linalg.solve(base, column)
        ratio = np.where(way > 1e-12, amount / np.where(way > 1e-12, way, 1), np.inf)
        leaves = int(np.argmin(ratio))
        step = ratio[leaves]
        amount = np.maximum(amount - step * way, 0)
        amount[leaves] = step
        base[:, leaves] = column
    return [(int(x + 1e-9), base[:, i].astype(int)) for i, x in enumerate(amount) if x >= 1 - 1e-9]


def plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = 64, small: int | None = None) -> list[Bins]:
    """Bins for ``counts[length]`` pieces of each length, lengths 1..capacity.

    Rounding up wastes the more space, the more rounded lengths share a bin; with lengths over
    7/16 of the capacity as the large ones it is one or two.
    """
    small = capacity * 7 // 16 if small is None else small
    left = counts.astype(np.int64).copy()
    used = np.zeros(capacity + 1, np.int64)
    bins: list[Bins] = []

    def take(length: int, n: int) -> int:
        at = int(used[length])
        used[length] += n
        left[length] -= n
        return at

    if left[capacity]:
        n = int(left[capacity])
        bins.append(Bins(n, 0, [(capacity, take(capacity, n))]))
    large = np.arange(capacity, small, -1)
    total = int(left[large].sum())
    if total:
        # linear grouping: ranks of the descending large pieces, in groups of equal cardinality
        ahead = np.cumsum(left[large])
        edges = np.unique([-(-total * g // groups) for g in range(groups + 1)])
        sizes = large[np.searchsorted(ahead, edges[:-1], "right")]
        demand = np.diff(edges)
        cursor = [int(e) for e in edges[:-1]]  # next unused rank of each group
        order = np.argsort(sizes)
        merged, back = np.unique(sizes[order], return_inverse=True)
        want = np.bincount(back, weights=demand[order]).astype(float)
        members = [[int(order[i]) for i in np.flatnonzero(back == k)] for k in range(len(merged))]
        stops = [int(e) for e in edges[1:]]
        start_of = np.r_[0, ahead]

        def draw(size_index: int, n: int) -> list[tuple[int, int]]:
            """n actual lengths for a rounded size, as runs (length, how many)."""
            runs = []
            for g in members[size_index]:
                while n and cursor[g] < stops[g]:
                    k = int(np.searchsorted(ahead, cursor[g], "right"))
                    m = min(n, stops[g] - cursor[g], int(start_of[k + 1]) - cursor[g])
                    runs.append((int(large[k]), m))
                    cursor[g] += m
                    n -= m
            return runs

        for times, config in configurations(merged, want, capacity):
            slots = [draw(k, times) for k in range(len(merged)) for _ in range(int(config[k]))]
            done = 0
            while done < times and all(slots):  # a group drawn empty ends the configuration early
                m = min([times - done, *(s[0][1] for s in slots)])
                made = Bins(m, capacity, [])
                for s in slots:
                    length, have = s[0]
                    made.put(length, take(length, m), 1)
                    s[0] = (length, have - m)
                    if have == m:
                        s.pop(0)
                bins.append(made)
                done += m
    # what is left: best fit decreasing over the space left
    free: list[list[Bins]] = [[] for _ in range(capacity + 1)]
    for b in bins:
        free[b.space].append(b)
    for length in range(capacity, 0, -1):
        n = int(left[length])
        space = length
        while n and space <= capacity:
            if not free[space]:
                space += 1
                continue
            b = free[space].pop()
            each = min(space // length, n)
            m = min(b.count, n // each)
            if m < b.count:
                head = b.split(m)
                free[space].append(b)
                bins.append(head)
                b = head
            b.put(length, take(length, m * each), each)
            free[b.space].append(b)
            n -= m * each
        while n:
            each = min(capacity // length, n)
            made = Bins(n // each, capacity, [])
            made.put(length, take(length, made.count * each), each)
            bins.append(made)
            free[made.space].append(made)
            n -= made.count * each
    return bins


def slots(bins: list[Bins]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset) of every run."""
    out, sequence = [], 0
    for b in bins:
        offset = 0
        for length, rank in b.items:
            out.append((length, rank, rank + b.count - 1, sequence, offset))
            offset += length
        sequence += b.count
    return out


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the token pieces of every document."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _cut(ranks_path, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None,
         capacity: int = CAPACITY, groups: int = 64) -> DataFrame:
    """One row per piece with ``sequence_id`` and ``offset``; sequences are gapless from 0.

    Null and empty texts are one end token. Repeated rows are packed as often as they occur.
    Pieces of one length are numbered per hash bucket and the buckets' counts are summed up, so
    a length that a third of all pieces have is numbered by many tasks. Only the counts per
    length (at most ``capacity`` rows) reach the driver, and the plan's runs, whose number
    depends on the number of lengths and not on the pieces, go back. Null ids are kept; other
    columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    salts = max(16, shuffle_partitions(spark))
    pieces = keep(cut_documents(docs, id_col, text_col, ranks_path, capacity).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int")), "pieces")
    buckets = keep(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in buckets.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    # as an Arrow table: rows of Python would be read by Python workers, of another kind than those at hand
    columns = zip(*(slots(plan(counts, capacity, groups)) or [(0, 0, 0, 0, 0)]))
    runs = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns],
                                          names=["length", "lo", "hi", "seq", "offset"]))
    return spark.sql("""
        SELECT p.doc_id, p.piece, p.start, p.length, p.ids_crc32, r.seq + p.rank - r.lo AS sequence_id, r.offset
        FROM (SELECT x.*, b.before + x.n_in_bucket - 1 AS rank
              FROM (SELECT *, row_number() OVER (PARTITION BY length, salt
                                                 ORDER BY doc_id, piece, ids_crc32, start) AS n_in_bucket
                    FROM {pieces}) x
              JOIN (SELECT length, salt, coalesce(sum(n) OVER (
                             PARTITION BY length ORDER BY salt
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
                    FROM {buckets}) b ON x.length = b.length AND x.salt = b.salt) p
        JOIN {runs} r ON p.length = r.length AND p.rank BETWEEN r.lo AND r.hi
        """, pieces=pieces, buckets=buckets, runs=F.broadcast(runs))


def q_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
