"""Substring dedup on a compacted de Bruijn graph: words under windows that an earlier document has.

A k-mer of ``WINDOW`` words is an edge of the graph, between its first and its last k-1 words. An
edge that is followed by one and the same edge wherever it occurs, and that one occurs as often,
is on a path without branches; paths compact to one row with the source coordinate of their first
occurrence (smallest document id). Spark joins bring the paths back to all places where their first
edge stands, where the words of the whole span are verified before any of them goes.

Only k-mers that may repeat become edges. Consecutive k-mers with the same minimizer (the least-hashed
``KEY`` words in them) travel as one segment: a segment whose minimizer no other text has is done
with; equal segments collapse to one; if all segments of a minimizer are equal they are a path
already. What remains are the borders of shared passages, and those become single edges.

Document texts move compressed: as words joined by a space.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, table

WINDOW = 50
KEY = 16
#: Words that a task hashes at a time; a longer text is cut, with an overlap.
CHUNK = 1 << 18
_POS = 20
#: Bits of a word's place in its text within a coordinate (text number << PLACE | place).
PLACE = 27
#: Path compaction sorts so many bits' worth of coordinates together; paths end there.
_BLOCK = 12
_CACHE = 1 << 20

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # fixed values: odd multipliers


class _Hashes(dict):
    """64-bit hashes of words, kept for the words that come again."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word, 12)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)  # fixed value: a 64-bit finalizer
    return x ^ (x >> np.uint64(29))


def rolled(h: np.ndarray, span: int, base: int) -> np.ndarray:
    """Hash of every ``span`` consecutive entries, by doubling."""
    n = len(h) - span + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, now, m = np.zeros(n, np.uint64), 0, h, 1
    while m <= span:
        if span & m:
            out += now[done:done + n] * np.uint64(pow(base, done, 1 << 64))
            done += m
        if 2 * m <= span:
            now = now[:-m] + now[m:] * np.uint64(pow(base, m, 1 << 64))
        m *= 2
    return _mixed(out)


def _segments(parts: list[np.ndarray], window: int, key: int) -> tuple[np.ndarray, ...]:
    """part, start in the part, number of k-mers, minimizer, hashes of the first and the last k-mer."""
    h = np.concatenate(parts)
    first_hash, last_hash = rolled(h, window, _BASES[0]), rolled(h, window, _BASES[1])
    if not len(first_hash):
        return (np.empty(0, np.int64),) * 6
    low = np.uint64((1 << _POS) - 1)
    name = rolled(h, key, _BASES[1])
    least = (name & ~low) | np.arange(len(name), dtype=np.uint64)
    span, m = window - key + 1, 1
    while 2 * m <= span:
        least = np.minimum(least[:-m], least[m:])
        m *= 2
    if m < span:
        least = np.minimum(least[:len(least) - (span - m)], least[span - m:])
    anchor = (least & low).astype(np.int64)
    ends = np.cumsum([len(p) for p in parts])
    begins = ends - [len(p) for p in parts]
    edge = np.zeros(len(anchor) + 1, np.int32)
    inside = ends - begins >= window
    np.add.at(edge, begins[inside], 1)
    np.add.at(edge, ends[inside] - window + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | first[1:]
    start, stop = np.flatnonzero(first), np.flatnonzero(last)
    part = np.searchsorted(ends, start, "right")
    return (part, start - begins[part], stop - start + 1, name[anchor[start]].view(np.int64),
            first_hash[start].view(np.int64), last_hash[stop].view(np.int64))


_SEGMENT = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()), ("v", pa.int64()),
                      ("w", pa.int64())])
_TEXT = "t long, s long, n_words long"
_SEGMENTS = "segs array<struct<start:int,n:int,anchor:long,v:long,w:long>>"


def _identity(joined: bytes) -> tuple[int, int]:
    digest = hashlib.blake2b(joined, digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _words(text: pa.Scalar) -> list[bytes]:
    return (text.as_py() or "").encode("utf-8", "surrogatepass").split()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) to id, identity of the word sequence, its length, its words compressed."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        rows = []
        for text in batch.column(1):
            words = _words(text)
            joined = b" ".join(words)
            rows.append((*_identity(joined), len(words), pack.compress(joined)))
        if rows:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), types))],
                                             names=["id", "t", "s", "n_words", "z"])


def _scan(window: int, key: int):
    """Rows (id, text) to id, 128-bit identity of the word sequence, its length, SHA-256 and segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, types = _Hashes(), [pa.int64(), pa.int64(), pa.int64(), pa.string()]

        def close(ids: pa.Array, rows: list[tuple], parts: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            found, at = [tuple(np.empty(0, np.int64) for _ in range(6))], 0
            while at < len(parts):
                some, size = [], 0
                while at < len(parts) and (not some or size + len(parts[at][2]) <= CHUNK):
                    some.append(parts[at])
                    size += len(parts[at][2])
                    at += 1
                part, start, *rest = _segments([h for _, _, h in some], window, key)
                row, shift = (np.array(c, np.int64)[part] for c in zip(*((r, begin) for r, begin, _ in some)))
                found.append((row, start + shift, *rest))
            row, *fields = (np.concatenate(c) for c in zip(*found))
            begins = np.cumsum([0, *np.bincount(row, minlength=len(rows))])
            segs = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(c).cast(f.type) for c, f in zip(fields, _SEGMENT)], fields=list(_SEGMENT)))
            return pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, t) for c, t in zip(zip(*rows), types)), segs],
                names=["id", "t", "s", "n_words", "sha", "segs"])

        for batch in batches:
            ids, rows, parts, size, begun = batch.column(0), [], [], 0, 0
            for text in batch.column(1):
                words = _words(text)
                if len(words) >= 1 << PLACE:
                    raise ValueError(f"a text of {len(words)} words; at most {(1 << PLACE) - 1} are supported")
                joined = b" ".join(words)
                rows.append((*_identity(joined), len(words), hashlib.sha256(joined).hexdigest()))
                if len(words) >= window:
                    h = hashes.of(words)
                    for at in range(0, len(h) - window + 1, CHUNK):
                        parts.append((len(rows) - 1, at, h[at:at + CHUNK + window - 1]))
                        size += len(parts[-1][2])
                if size >= CHUNK:
                    yield close(ids.slice(begun, len(rows)), rows, parts)
                    begun, rows, parts, size = begun + len(rows), [], [], 0
            if rows:
                yield close(ids.slice(begun, len(rows)), rows, parts)
    return run


def _unpack(data: bytes) -> list[bytes]:
    joined = zstandard.ZstdDecompressor().decompress(data)
    return joined.split(b" ") if joined else []


def _lists(column: pa.Array, *names: str) -> tuple[np.ndarray, ...]:
    """Where each row's list of structs begins, and the fields of all of them (null: 0)."""
    flat = column.flatten()
    begins = np.cumsum([0, *column.value_lengths().fill_null(0).to_pylist()])
    return begins, *(flat.field(n).fill_null(0).to_numpy(zero_copy_only=False) for n in names)


def _edges(window: int):
    """Rows (u, z, wanted (start, n)) to the edges of the wanted segments: e, f (128 bits), the
    coordinate of the place, the offset in the segment, and the next edge there (0: the last)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()

        def close(held: list[tuple]) -> pa.RecordBatch:
            e, f, at, o, after = (np.concatenate(c) for c in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array(e.view(np.int64)), pa.array(f.view(np.int64)), pa.array(at),
                                               pa.array(o.astype(np.int32)), pa.array(after.view(np.int64))],
                                              names=["e", "f", "at", "o", "after"])
        for batch in batches:
            held, size = [], 0
            begins, starts, counts = _lists(batch.column(2), "start", "n")
            for k, (u, z) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                start, n = (c[begins[k]:begins[k + 1]].astype(np.int64) for c in (starts, counts))
                h = hashes.of(_unpack(z.as_py()))
                e, f = rolled(h, window, _BASES[0]), rolled(h, window, _BASES[1])
                o = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(start, n) + o
                after = np.append(e, np.uint64(0))[at + 1]
                after[np.cumsum(n) - 1] = 0
                held.append((e[at], f[at], (u << PLACE) + at, o, after))
                size += len(at)
                if size >= CHUNK:
                    yield close(held)
                    held, size = [], 0
            if held:
                yield close(held)
    return run


def _cut(window: int, digest: bool):
    """Rows (t, s, z, spans (start, n, check, v, w)) to the words removed and what is left.

    A span goes only if its k-mers, hashed from the text here, are those of the path at its source."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            rows = []
            begins, starts, counts, checks, firsts, lasts = _lists(batch.column(3), "start", "n", "check", "v", "w")
            path = batch.column(3).flatten().field("check").is_valid().to_numpy(zero_copy_only=False)
            for k, (t, s, z) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))):
                own = slice(begins[k], begins[k + 1])
                words = _unpack(z.as_py())
                h = hashes.of(words)
                e, f = (rolled(h, window, b).view(np.int64) for b in _BASES)
                lo, hi = starts[own].astype(np.int64), (starts[own] + counts[own]).astype(np.int64)
                sums = np.append(np.int64(0), np.bitwise_xor.accumulate(f))
                right = np.where(path[own], sums[hi] ^ sums[lo] == checks[own],
                                 (e[lo] == firsts[own]) & (f[hi - 1] == lasts[own]))
                gone = np.zeros(len(words) + 1, np.int32)
                np.add.at(gone, lo[right], 1)
                np.add.at(gone, hi[right] - 1 + window, -1)
                kept = np.cumsum(gone[:-1]) == 0
                left = b" ".join([w for w, stays in zip(words, kept.tolist()) if stays])
                rows.append((t, s, len(words) - int(kept.sum()), hashlib.sha256(left).hexdigest() if digest
                             else left.decode("utf-8", "surrogatepass")))
            if rows:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=["t", "s", "n_removed", "kept"])
    return run


def _numbered(found: DataFrame) -> DataFrame:
    """``t, s, m, u, g``: the distinct texts, numbered in the order of their smallest id (null last);
    g is the first number of the texts with the same smallest id."""
    spark = found.sparkSession
    texts = found.groupBy("t", "s").agg(F.min("id").alias("m")).orderBy(F.col("m").asc_nulls_last(), "t", "s")
    texts = keep(texts.withColumn("raw", F.monotonically_increasing_id()), "texts")
    part = F.shiftrightunsigned("raw", 33)
    counts = sorted(texts.groupBy(part.alias("p")).count().collect())  # a row per sorted partition
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    if total >= 1 << (63 - PLACE):
        raise ValueError("more distinct texts than a coordinate can number")
    starts = spark.createDataFrame(starts, "p long, first long")
    numbered = keep(texts.withColumn("p", part).join(starts, "p").select(
        "t", "s", "m", (F.col("first") + F.col("raw").bitwiseAND((1 << 33) - 1)).alias("u")), "numbered-texts")
    groups = keep(numbered.groupBy(F.col("m").alias("id")).agg(F.min("u").alias("g")), "text-groups")
    return keep(numbered.join(groups, F.col("m").eqNullSafe(F.col("id"))).drop("id"), "texts")


def _of_text(found: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``found`` that stand for a text, one with its smallest id, with the text's columns."""
    texts = texts.withColumnsRenamed({"t": "t_", "s": "s_"})
    return found.join(texts, (F.col("t") == F.col("t_")) & (F.col("s") == F.col("s_"))
                      & F.col("id").eqNullSafe(F.col("m"))).drop("t_", "s_")


def _paths(edges: DataFrame) -> DataFrame:
    """``e, f, source, length, check`` of the paths without branches; e and f are a path's first edge.

    An edge goes on a path if it is the only one that ever follows the edge before it and occurs
    as often: then each occurrence of the path's first edge is one of the whole path. In the
    text of a path's source its edges stand one after the other, so sorted coordinates show them."""
    stats = edges.groupBy("e", "f").agg(F.min("at").alias("source"), F.count("*").alias("n"),
                                        F.min("after").alias("low"), F.max("after").alias("high"))
    block = f"PARTITION BY source >> {_BLOCK} ORDER BY source"
    return edges.sparkSession.sql(f"""
        SELECT max(CASE WHEN source = head THEN e END) AS e, max(CASE WHEN source = head THEN f END) AS f,
               head AS source, cast(count(*) AS int) AS length, bit_xor(f) AS check
        FROM (SELECT e, f, source, last_value(opens, true) OVER (
                       {block} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head
              FROM (SELECT e, f, source,
                           CASE WHEN coalesce(lag(source) OVER block = source - 1 AND lag(low) OVER block = e
                                              AND lag(high) OVER block = e AND lag(n) OVER block = n, false)
                                THEN NULL ELSE source END AS opens
                    FROM {{stats}} WINDOW block AS ({block})))
        GROUP BY head""", stats=stats)


def _repeats(found: DataFrame, packed: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``t, s, m, spans``: for the texts that have any, the k-mer runs that a smaller id also has."""
    segs = keep(_of_text(found.select("id", "t", "s", "segs"), texts).select("u", "g", F.inline("segs")), "segments")
    often = keep(segs.groupBy("anchor").agg(F.min("u").alias("a"), F.max("u").alias("b")).filter("a < b")
                 .select("anchor"), "minimizers")
    live = keep(segs.join(often, "anchor", "left_semi"), "segments")
    place = F.shiftleft("u", PLACE) + F.col("start")
    kinds = keep(live.groupBy("anchor", "v", "w", "n").agg(F.min(place).alias("source")), "kinds")
    several = keep(kinds.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor"), "branching")
    single = kinds.join(several, "anchor", "left_anti")
    mixed = keep(kinds.join(several, "anchor", "left_semi"), "kinds")

    wanted = mixed.groupBy(F.shiftright("source", PLACE).alias("u")).agg(F.collect_list(F.struct(
        F.col("source").bitwiseAND((1 << PLACE) - 1).cast("int").alias("start"), "n")).alias("wanted"))
    wanted = keep(texts.join(wanted, "u"), "wanted")
    edges = keep(_of_text(packed, wanted)
                 .select("u", "z", "wanted").mapInArrow(_edges(window), "e long, f long, at long, o int, after long"),
                 "edges")
    paths = keep(_paths(edges), "paths")
    # The paths of a segment, then of all places where the segment stands.
    runs = keep(edges.select("e", "f", "at", "o").join(paths, ["e", "f"]).select(
        (F.col("at") - F.col("o")).alias("home"), "o", "length", F.col("source").alias("from"), "check"), "runs")
    spans = keep(mixed.join(runs, mixed["source"] == runs["home"])
                 .select("anchor", "v", "w", "n", "o", "length", "from", "check")
                 .unionAll(single.select("anchor", "v", "w", "n", F.lit(0).alias("o"), F.col("n").alias("length"),
                                         F.col("source").alias("from"), F.lit(None).cast("long").alias("check"))),
                 "spans")
    return (live.join(spans, ["anchor", "v", "w", "n"])
            .filter(F.shiftright("from", PLACE) < F.col("g"))
            .groupBy("u").agg(F.collect_set(F.struct(
                (F.col("start") + F.col("o")).alias("start"), F.col("length").alias("n"), "check",
                *[F.when(F.col("check").isNull(), F.col(c)).alias(c) for c in "vw"])).alias("spans"))
            .join(texts, "u").select("t", "s", "m", "spans"))


def _joined(packed: pd.Series) -> pd.Series:
    return pd.Series([b" ".join(_unpack(z)).decode("utf-8", "surrogatepass") for z in packed], dtype=object)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, key: int = KEY,
          digest: bool = False) -> DataFrame:
    """``id_col, n_words, n_removed, kept`` for every row: the words that stay, joined by a space, or
    with ``digest`` their SHA-256.

    A word goes if it is in a window of ``window`` words that also starts in a document with a
    smaller id, judged on the input. Null texts have no words; texts with fewer words than
    a window lose none. A null id counts as larger than every id. Rows with equal ids do not
    remove each other's words, so repeated rows fare alike. Other columns are not read, whatever
    their names; an empty table gives no rows."""
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    row = f"id {docs.schema[id_col].dataType.simpleString()}, {_TEXT}"
    found = keep(base.mapInArrow(_scan(window, key), f"{row}, sha string, {_SEGMENTS}"), "scanned")
    packed = base.mapInArrow(_packed, f"{row}, z binary")
    movable = packed.filter(F.col("n_words") >= window).select("id", "t", "s", "z")
    texts = _numbered(found.filter(F.col("n_words") >= window))
    spans = keep(_repeats(found, movable, texts, window), "repeats")
    cut = keep(_of_text(movable, spans).select("t", "s", "z", "spans")
               .mapInArrow(_cut(window, digest), "t long, s long, n_removed long, kept string")
               .dropDuplicates(["t", "s"]), "cut")
    known = keep(texts.join(cut, ["t", "s"], "left").select("t", "s", "m", "n_removed", "kept"), "texts")
    nothing = hashlib.sha256(b"").hexdigest() if digest else ""
    if digest:
        rows, whole = found.select("id", "t", "s", "n_words", "sha"), F.col("sha")
    else:
        rows, whole = packed, F.pandas_udf(_joined, "string")("z")
    copy = F.col("m").isNotNull() & ~F.col("id").eqNullSafe(F.col("m"))
    return rows.join(known, ["t", "s"], "left").select(
        F.col("id").alias(id_col), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("kept", whole)).alias("kept"))


def q_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return (dedup(table(spark, sf_dir, "documents"), digest=True)
            .withColumnRenamed("kept", "kept_sha256"))
