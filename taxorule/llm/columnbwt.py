"""Suffix-array dedup: bytes under repeated strings, by column-wise construction.

A string of ``width`` bytes repeats if it starts at two places of the corpus. Every string is
filed under its anchor, the least-hashed ``KEY``-gram in it (leftmost of equals): equal strings
have equal anchors at equal offsets. Consecutive strings with one anchor form a segment of at
most ``2 * width - KEY`` bytes. Anchors that occur once are done with; equal segments collapse
to one with a count; the different segments of an anchor are the documents of a collection.

A collection is indexed column by column from the right, one symbol per document each round:
the order of the suffixes that start in a column is the order of the next column, stably
partitioned by the inserted symbol (which is that column's Burrows-Wheeler transform), and the
common prefix of two neighbours is one more than the least common prefix between the places
they came from. Segments of an anchor are aligned at it, so suffixes of different columns never
need comparing, and the transform and common prefixes are kept for the current column only.
Neighbours with a common prefix of ``width`` bytes mark a repeated string. The external files
of the construction are Spark's shuffle files: a task reads whole collections in sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, row_key, shuffle_partitions, slices, table

WIDTH = 200
#: Bytes of an anchor. Shorter ones make fewer segments, but many of them repeat in strings that do not.
KEY = 64
_POS = 19
#: Bytes that a task hashes at a time, which takes about 64 times as much memory.
CHUNK = 1 << 18
#: Segments that a task indexes at a time; anchors with more different segments than this are
#: compared string by string through the shuffle instead, by digest, which is exact as well.
COLLECTION = 16_384

_rng = np.random.default_rng(20)
_SYMBOL = _rng.integers(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # fixed value: odd, so it has an inverse modulo 2**64
_M64 = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _M64, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)  # fixed value: a 64-bit finalizer
    return x ^ (x >> np.uint64(29))


class Chunk:
    """Rolling hashes of some texts' bytes, joined."""

    _pow = _inv = None

    def __init__(self, parts: list[bytes]) -> None:
        if Chunk._pow is None:
            Chunk._pow = _powers(_BASE, (1 << _POS) + 1)
            Chunk._inv = _powers(pow(_BASE, -1, 1 << 64), (1 << _POS) + 1)
        self.flat = np.frombuffer(b"".join(parts), np.uint8)
        lens = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(lens)
        self.begins = self.ends - lens
        self.symbols = _SYMBOL[self.flat]
        self.prefix = np.zeros(len(self.flat) + 1, np.uint64)
        np.cumsum(self.symbols * Chunk._pow[: len(self.flat)], out=self.prefix[1:])

    def digest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.prefix[hi] - self.prefix[lo]) * Chunk._inv[lo]

    def segments(self, width: int) -> tuple[np.ndarray, ...]:
        """part, start in the chunk, number of strings, offset of the anchor, anchor, variant."""
        n = len(self.flat)
        none = np.empty(0, np.int64)
        if n < width:
            return (none,) * 6
        h, m = self.symbols, 1
        while m < KEY:
            h = h[:-m] + h[m:] * Chunk._pow[m]
            m *= 2
        h = _mixed(h)
        low = np.uint64((1 << _POS) - 1)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        span, m = width - KEY + 1, 1
        while 2 * m <= span:
            least = np.minimum(least[:-m], least[m:])
            m *= 2
        if m < span:
            least = np.minimum(least[: len(least) - (span - m)], least[span - m:])
        anchor = (least & low).astype(np.int64)
        valid = np.zeros(len(anchor), bool)
        for a, b in zip(self.begins.tolist(), self.ends.tolist()):
            if b - a >= width:
                valid[a:b - width + 1] = True
        first = valid.copy()
        first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        last = valid.copy()
        last[:-1] &= ~valid[1:] | first[1:]
        start, stop = np.flatnonzero(first), np.flatnonzero(last)
        count, at = stop - start + 1, anchor[start]
        name, offset = h[at], at - start
        variant = _mixed(self.digest(start, stop + width) + name * np.uint64(_BASE)
                         + (offset * 1024 + count).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        part = np.searchsorted(self.ends, start, "right")
        return part, start - self.begins[part], count, offset, name.view(np.int64), variant.view(np.int64)


def _packed(text: Column) -> Column:
    """Texts as they move between tasks."""
    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        pack = zstandard.ZstdCompressor()
        return pa.array([pack.compress(_bytes(t.as_py())) if t.is_valid else None for t in texts], pa.binary())
    return of(text)


def _unpacked(text: Column) -> Column:
    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([_bytes(t.as_py()).decode("utf-8", "surrogatepass") if t.is_valid else None for t in texts], pa.string())
    return of(text)


def _bytes(text: str | bytes | None) -> bytes:
    """The bytes of a text, or of a packed one."""
    if isinstance(text, bytes):
        return zstandard.ZstdDecompressor().decompress(text)
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def _pieces(rows: Iterator[tuple[int, bytes]], width: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (key, offset, bytes) of at most a chunk; a longer text is cut with an overlap
    that lets every string lie in exactly one piece."""
    held, size = [], 0
    for key, data in rows:
        step = CHUNK - width
        for at in range(0, max(1, len(data) - width + 1), step):
            part = data[at:at + step + width - 1]
            if size + len(part) > CHUNK:
                yield held
                held, size = [], 0
            held.append((key, at, part))
            size += len(part)
    if held:
        yield held


def _segment_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((k, _bytes(t.as_py())) for k, t in zip(batch.column(0).to_pylist(), batch.column(1)))
            for held in _pieces(((k, d) for k, d in rows if len(d) >= width), width):
                part, start, count, offset, anchor, variant = Chunk([p for _, _, p in held]).segments(width)
                keys = np.array([k for k, _, _ in held], np.int64)
                ats = np.array([a for _, a, _ in held], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[part]), pa.array((ats[part] + start).astype(np.int32)),
                     pa.array(count.astype(np.int32)), pa.array(offset.astype(np.int32)),
                     pa.array(anchor), pa.array(variant)],
                    names=["k", "start", "n", "rel", "anchor", "v"])
    return run


def repeated_columns(cells: np.ndarray, lo: np.ndarray, hi: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """hit[i, c]: the string of ``width`` symbols that document i has from column c on is also
    in another document of its group at that column. Document i fills columns lo[i]..hi[i]-1."""
    m, columns = cells.shape
    hit = np.zeros((m, columns), bool)
    by_end = np.argsort(hi, kind="stable")
    ends = hi[by_end]
    order, prefix = np.empty(0, np.int64), np.empty(0, np.int16)
    for c in range(columns - 1, -1, -1):
        enter = by_end[np.searchsorted(ends, c + 1, "left"):np.searchsorted(ends, c + 1, "right")]
        stay = lo[order] <= c
        if not stay.all():
            at = np.flatnonzero(stay)
            prefix = np.minimum.reduceat(prefix[: at[-1] + 1], np.r_[0, at[:-1] + 1]) if len(at) else prefix[:0]
            order = order[at]
        source = np.concatenate([enter, order])
        if not len(source):
            continue
        depth = np.concatenate([np.zeros(len(enter), np.int16), prefix, np.zeros(1, np.int16)])
        symbol, family = cells[source, c], group[source]
        by = np.argsort(symbol, kind="stable")
        by = by[np.argsort(family[by], kind="stable")]
        symbol, family = symbol[by], family[by]
        pair = np.flatnonzero((symbol[1:] == symbol[:-1]) & (family[1:] == family[:-1]))
        prefix = np.zeros(len(by), np.int16)
        if len(pair):
            between = np.minimum.reduceat(depth, np.stack([by[pair] + 1, by[pair + 1] + 1], 1).ravel())[::2]
            prefix[pair + 1] = np.minimum(between + 1, width)
        order = source[by]
        full = prefix == width
        full[:-1] |= full[1:]
        hit[order[full], c] = True
    return hit


def _runs(marks: np.ndarray) -> list[int]:
    """[first, how many, first, how many, ...] of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.r_[0, marks.astype(np.int8), 0]))
    out = edge.copy()
    out[1::2] -= edge[::2]
    return out.tolist()


def _index(width: int, collection: int):
    """Rows (anchor, v, rel, n, data) sorted by (anchor, v): one row per segment with a repeated
    string, and the runs of its repeated strings."""
    middle = width - KEY
    columns = 2 * width - KEY
    schema = pa.schema([("anchor", pa.int64()), ("v", pa.int64()), ("hits", pa.list_(pa.int32()))])

    def close(rows: list[tuple]) -> pa.RecordBatch:
        lo = np.array([middle - r[2] for r in rows])
        hi = lo + np.array([len(r[4]) for r in rows])
        cells = np.zeros((len(rows), columns), np.uint8)
        for i, r in enumerate(rows):
            cells[i, lo[i]:hi[i]] = np.frombuffer(r[4], np.uint8)
        _, group = np.unique(np.array([r[0] for r in rows]), return_inverse=True)
        hit = repeated_columns(cells, lo, hi, group.astype(np.uint16), width)
        some = np.flatnonzero(hit.any(1)).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][0] for i in some], pa.int64()), pa.array([rows[i][1] for i in some], pa.int64()),
             pa.array([_runs(hit[i, lo[i]:lo[i] + rows[i][3]]) for i in some], pa.list_(pa.int32()))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, family, seen = [], [], None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (row[0], row[1]) == seen:
                    continue  # the same segment, from a repeated row
                if family and family[0][0] != row[0]:
                    if len(family) > 1:
                        if len(held) + len(family) > collection:
                            if held:
                                yield close(held)
                            held = []
                        held += family
                    family = []
                seen = row[:2]
                family.append(row)
        if len(family) > 1:
            held += family
        if held:
            yield close(held)

    return run


def _cut(width: int, digests: bool):
    """Rows (packed text, segments): the bytes of each segment, or the digest of each of its strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, segs in zip(batch.column(0), batch.column(1).to_pylist()):
                data = _bytes(text.as_py())
                for s in segs:
                    own = data[s["start"]:s["start"] + s["n"] - 1 + width]
                    if digests:
                        lo = np.arange(s["n"])
                        own = _mixed(Chunk([own]).digest(lo, lo + width)).view(np.int64).tolist()
                    out.append((s["anchor"], s["v"], s["rel"], s["n"], own))
            for at in range(0, len(out), 20_000):
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(),
                         pa.list_(pa.int64()) if digests else pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at:at + 20_000]), types)],
                                                 names=["anchor", "v", "rel", "n", "data"])
    return run


def repeated_spans(rows: DataFrame, width: int = WIDTH, collection: int = COLLECTION) -> DataFrame:
    """``k, spans`` for the rows ``k, text`` that hold a repeated string: the byte ranges
    (lo, hi) of maximal runs of such strings; ranges may overlap."""
    spark = rows.sparkSession
    n = shuffle_partitions(spark)
    found = rows.mapInArrow(_segment_rows(width), "k long, start int, n int, rel int, anchor long, v long")
    # written, so that the join below deals both sides out anew and AQE can split a hot anchor
    often = keep(found.groupBy("anchor").agg(F.count("*").alias("all"), (F.min("v") != F.max("v")).alias("mixed"))
                 .filter("all > 1").select("anchor", "mixed"), "anchors")
    live = keep(found.join(often, "anchor"), "segments")
    variants = keep(live.groupBy("anchor", "v", "rel", "n", "mixed").agg(
        F.count("*").alias("copies"), F.min(F.struct("k", "start")).alias("at")), "variants")
    kinds = variants.filter("mixed").groupBy("anchor").agg(F.count("*").alias("kinds"))
    hot = keep(kinds.filter(F.col("kinds") > collection).select("anchor"), "hot-anchors")

    def cut(some: DataFrame, digests: bool) -> DataFrame:
        wanted = some.groupBy(F.col("at.k").alias("k")).agg(F.collect_list(F.struct(
            "anchor", "v", "rel", "n", F.col("at.start").alias("start"))).alias("segs"))
        return rows.select("k", _packed(F.col("text")).alias("text")).join(wanted, "k").select("text", "segs").mapInArrow(
            _cut(width, digests), "anchor long, v long, rel int, n int, data "
            + ("array<long>" if digests else "binary"))

    mixed = variants.filter("mixed")
    parts = (cut(mixed.join(hot, "anchor", "left_anti"), False).repartition(n, "anchor")
             .sortWithinPartitions("anchor", "v"))
    hits = parts.mapInArrow(_index(width, collection), "anchor long, v long, hits array<int>")
    if hot.head(1):
        strings = keep(cut(mixed.join(hot, "anchor", "left_semi"), True)
                       .select("anchor", "v", F.posexplode("data").alias("o", "d")), "hot-strings")
        twice = (strings.groupBy("anchor", "d").agg((F.min("v") != F.max("v")).alias("twice"))
                 .filter("twice").drop("twice"))
        hits = hits.unionAll(strings.join(twice, ["anchor", "d"]).distinct().groupBy("anchor", "v").agg(
            F.flatten(F.collect_list(F.array(F.col("o"), F.lit(1)))).alias("hits")))
    whole = variants.filter("copies > 1").select("anchor", "v", F.array(F.lit(0), F.col("n")).alias("hits"))
    marked = live.join(hits.unionAll(whole), ["anchor", "v"]).select("k", "start", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("hits") - 2, F.lit(2)),
        lambda i: F.struct(F.get("hits", i).alias("o"), F.get("hits", i + 1).alias("m")))).alias("x"))
    return (marked.groupBy("k").agg(F.collect_set(F.struct(
        (F.col("start") + F.col("x.o")).cast("long").alias("lo"),
        (F.col("start") + F.col("x.o") + F.col("x.m") - 1 + width).cast("long").alias("hi"))).alias("spans")))


def kept_bytes(data: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left of ``data``, the bytes removed, the number of maximal removed runs."""
    if not spans:
        return data, 0, 0
    out, at, runs = [], 0, 0
    edge = -1
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if lo > edge:
            out.append(data[at:lo])
            runs += 1
        edge = max(edge, hi)
        at = edge
    out.append(data[at:])
    left = b"".join(out)
    return left, len(data) - len(left), runs


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            data = _bytes(text.as_py())
            left, gone, runs = kept_bytes(data, spans)
            rows.append((doc_id, len(data), gone, runs, hashlib.sha256(left).hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()])],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _packed_with_spans(docs: DataFrame, text_col: str, width: int, collection: int) -> DataFrame:
    """``with_spans`` with the text packed, as it comes from the shuffle."""
    text, k = F.col(f"`{text_col}`"), row_key(docs).alias("k")
    spans = repeated_spans(docs.select(k, text.alias("text")), width, collection)
    row = F.struct(*[_packed(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), k).join(spans, "k", "left").select("row", "spans")


def with_spans(docs: DataFrame, text_col: str = "text", width: int = WIDTH,
               collection: int = COLLECTION) -> DataFrame:
    """``row`` (all columns of docs) and ``spans`` (null if nothing repeats) for every row.

    Strings are judged on the input; matches do not cross texts. Null and empty texts, and texts
    shorter than ``width`` bytes, have no strings. A repeated row repeats all its strings.
    Original columns travel in ``row``, so no name can clash. Empty tables stay empty."""
    found = _packed_with_spans(docs, text_col, width, collection)
    return found.withColumn("row", F.col("row").withField(f"`{text_col}`", _unpacked(F.col("row").getField(text_col))))


def remove_repeats(docs: DataFrame, text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text. A character that loses some of
    its bytes goes whole; a text without repeats, null included, stays as it is."""
    @F.arrow_udf("string")
    def left(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([kept_bytes(_bytes(t.as_py()), s.as_py())[0].decode("utf-8", "ignore" if s.is_valid else "surrogatepass")
                         if t.is_valid else None for t, s in zip(texts, spans)], pa.string())

    found = _packed_with_spans(docs, text_col, width, COLLECTION)
    return found.select(F.col("row").withField(f"`{text_col}`", left(F.col("row")[text_col], F.col("spans")))
                        .alias("row")).select("row.*")


def q_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    found = _packed_with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", WIDTH, COLLECTION)
    return found.select("row.doc_id", "row.text", "spans").mapInArrow(_digest, OUT)
