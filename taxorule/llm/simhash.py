"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified bit distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, row_key, shuffle_partitions, table
from .components import components

BITS = 64
#: A block bucket of up to this many distinct fingerprints is compared pair by pair inside a
#: task; the fingerprints of larger ones take the ball join, which is exact and linear.
PAIRWISE_BUCKET = 8192
_UNPACK = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def simhash(text: str | None, width: int, seed: int) -> int:
    """The unsigned fingerprint of one text; see ``with_fingerprint``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(data, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    found = np.array([digest(data[a:b], seed) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())], np.uint64)
    by_byte = found.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(found) < 128:
        ones = _UNPACK[by_byte].sum(axis=0)
    else:
        ones = np.stack([np.bincount(by_byte[:, i], minlength=256) @ _UNPACK for i in range(8)])
    return sum(1 << i for i, x in enumerate((2 * ones.reshape(-1) > len(found)).tolist()) if x)


def fingerprint_udf(width: int, seed: int):
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        values = np.fromiter((simhash(t.as_py(), width, seed) for t in texts), np.uint64, len(texts))
        return pa.array(values.view(np.int64))
    return of


def _blocks(max_bits: int, blocks: int) -> list[int]:
    """A signed mask for each choice of ``blocks - max_bits`` blocks: two fingerprints that
    differ in at most ``max_bits`` bits agree on all bits of at least one of the masks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _settle(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _bucket_links(max_bits: int):
    """Verified links within buckets, as a spanning star for each bucket's component.

    Input is sorted by bucket. A bucket is compared in blocks of rows against blocks of rows,
    and only its links within ``max_bits`` live at a time, folded into labels block by block.
    """
    limit = max_bits

    def star(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label = np.arange(len(fps))
        for lo in range(0, len(fps), 256):
            near = np.bitwise_count(fps[lo:lo + 256, None] ^ fps[None, lo:]) <= limit
            i, j = np.nonzero(near)
            i, j = i + lo, j + lo
            i, j = i[i < j], j[i < j]
            if len(i):
                label = _settle(len(fps), np.r_[i, np.arange(len(fps))], np.r_[j, label])
        child = np.flatnonzero(label != np.arange(len(fps)))
        return fps[child], fps[label[child]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        tail_c, tail_k, tail_f = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

        def close(c, k, f):
            out_a, out_b = [], []
            cut = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
            first, last = np.r_[0, cut], np.r_[cut, len(c)]
            pairs = last - first == 2
            x, y = f[first[pairs]], f[first[pairs] + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= limit
            out_a.append(x[near])
            out_b.append(y[near])
            for lo, hi in zip(first[last - first > 2].tolist(), last[last - first > 2].tolist()):
                a, b = star(f[lo:hi].view(np.uint64))
                out_a.append(a.view(np.int64))
                out_b.append(b.view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))],
                                              schema=schema)

        for batch in batches:
            c = np.r_[tail_c, batch.column(0).to_numpy()]
            k = np.r_[tail_k, batch.column(1).to_numpy()]
            f = np.r_[tail_f, batch.column(2).to_numpy()]
            if not len(c):
                continue
            open_from = int(np.flatnonzero((c != c[-1]) | (k != k[-1]))[-1]) + 1 if (
                (c != c[-1]) | (k != k[-1])).any() else 0
            if open_from:
                yield close(c[:open_from], k[:open_from], f[:open_from])
            tail_c, tail_k, tail_f = c[open_from:], k[open_from:], f[open_from:]
        if len(tail_c):
            yield close(tail_c, tail_k, tail_f)

    return run


def _ball(max_bits: int):
    """Each fingerprint's neighbourhoods: ``z, far, fp`` with z within floor(max_bits / 2) bits
    (far 0) or within ceil(max_bits / 2) bits (far 1) of fp."""
    near, far = max_bits // 2, max_bits - max_bits // 2
    flips = [np.array([sum(1 << b for b in c) for r in range(lo, hi + 1) for c in combinations(range(BITS), r)],
                      np.uint64) for lo, hi in ((0, near), (near + 1, far))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in np.array_split(batch.column(0).to_numpy().view(np.uint64), max(1, batch.num_rows // 64)):
                z = np.concatenate([(fp[:, None] ^ f[None, :]).ravel() for f in flips])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(z.view(np.int64)),
                     pa.array(np.repeat(np.array([0, 1], np.int8), [len(fp) * len(f) for f in flips])),
                     pa.array(np.concatenate([np.repeat(fp, len(f)) for f in flips]).view(np.int64))],
                    names=["z", "far", "fp"])

    return run


def _ball_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (z, far, fp): every row of a z that some near row opens links to that row.

    Both lie within max_bits of each other over z, and two fingerprints within max_bits always
    share a z that is near for one of them, so the links connect exactly the same components."""
    at = center = None
    for batch in batches:
        z, far, fp = (batch.column(i).to_numpy() for i in range(3))
        if not len(z):
            continue
        head = np.r_[at is None or z[0] != at, z[1:] != z[:-1]]
        group = np.cumsum(head) - 1
        first = np.flatnonzero(head)
        lead, opens = fp[first], far[first] == 0
        if not head[0]:
            group, lead, opens = group + 1, np.r_[fp[0] if center is None else center, lead], np.r_[center is not None, opens]
        ok = opens[group] & (fp != lead[group])
        at, center = z[-1], (lead[group[-1]] if opens[group[-1]] else None)
        links = np.unique(np.stack([fp[ok], lead[group][ok]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], names=["a", "b"])


def hamming_links(fps: DataFrame, max_bits: int = 3, blocks: int | None = None,
                  pairwise_bucket: int = PAIRWISE_BUCKET) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that connect exactly the fingerprints
    connected by pairs within ``max_bits`` bits. Never all pairs of a group: a bucket of n
    fingerprints gives fewer than n links."""
    spark = fps.sparkSession
    masks = _blocks(max_bits, blocks or 2 * max_bits or 1)
    listed = ", ".join(f"named_struct('c', {i}, 'm', {m}L)" if m != -(1 << 63) else
                       f"named_struct('c', {i}, 'm', -9223372036854775807L - 1L)" for i, m in enumerate(masks))
    keyed = spark.sql(f"SELECT fp, x.c AS c, fp & x.m AS k FROM (SELECT fp, explode(array({listed})) AS x FROM {{fps}})",
                      fps=fps)
    sizes = keep(keyed.groupBy("c", "k").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    small = keyed.join(sizes.filter(F.col("n") <= pairwise_bucket).select("c", "k"), ["c", "k"])
    n = shuffle_partitions(spark)
    links = (small.select("c", "k", "fp").repartition(n, "c", "k").sortWithinPartitions("c", "k", "fp")
             .mapInArrow(_bucket_links(max_bits), "a long, b long"))
    hot = keyed.join(sizes.filter(F.col("n") > pairwise_bucket).select("c", "k"), ["c", "k"]).select("fp").distinct()
    far = (hot.mapInArrow(_ball(max_bits), "z long, far byte, fp long").repartition(n, "z")
           .sortWithinPartitions("z", "far", "fp").mapInArrow(_ball_links, "a long, b long"))
    return links.unionAll(far)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    max_bits: int = 3, seed: int = 42) -> DataFrame:
    """``_id, _row, fp, root, component_id`` for every row of ``docs``.

    ``root`` names the component. ``fp`` is the signed form of the fingerprint over ``width``-word shingles of the lower-cased
    (A-Z) text; ``_row`` hashes the whole row. Exact copies collapse to one fingerprint before
    any link is sought. ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` bits; null ids take part in linking and count as larger than any id. Null and
    blank texts have fingerprint zero, linked like any other. Repeated rows each get a row.
    An empty table gives an empty result; columns besides id and text only enter ``_row``.
    """
    rows = keep(docs.select(F.col(id_col).alias("_id"), row_key(docs).alias("_row"),
                            fingerprint_udf(width, seed)(F.col(text_col)).alias("fp")), "fingerprints")
    fps = keep(rows.groupBy("fp").agg(F.min("_id").alias("low")), "distinct-fp")
    linked = components(hamming_links(fps.select("fp"), max_bits))
    roots = fps.join(linked, fps.fp == linked.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    # written, so that AQE can split a hot root in the join
    least = keep(roots.groupBy("root").agg(F.min("low").alias("component_id")), "roots")
    classes = keep(roots.join(least, "root").select("fp", "root", "component_id"), "classes")
    return rows.join(classes, "fp")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                         max_bits: int = 3, seed: int = 42) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest id, null ids last, ties broken by
    the hash of the whole row; of equal rows one stays."""
    found = near_duplicates(docs, id_col, text_col, width, max_bits, seed)
    chosen = found.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_row"))).alias("low"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(docs).alias("_row"))
    return (rows.join(chosen.select(F.col("low._row").alias("_row")), "_row", "left_semi")
            .dropDuplicates(["_row"]).select("row.*"))


def q_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
