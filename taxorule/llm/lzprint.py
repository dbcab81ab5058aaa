"""Lempel-Ziv phrase fingerprints: compression-like similarity by minimum hashes.

A text's UTF-8 bytes are parsed into LZ78 phrases: the shortest prefix of what is left that is
not yet in the dictionary becomes a phrase. Texts that share long passages share phrases. The
phrase set is summarised by one-permutation minimum hashing: each phrase's hash picks a slot,
a slot keeps its least value, and the likeness of two texts is the share of slots that agree
among those that either of them fills.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, table

SLOTS = 128
_NONE = np.uint64(2**64 - 1)
_EMPTY = 0xFFFF
_STEP = 0x9E3779B97F4A7C15  # fixed value: odd multiplier
_MASK = (1 << 61) - 1


class Parse:
    """LZ78 dictionary of one text, which can be continued from a mark and rolled back to it."""

    __slots__ = ("trie", "sums", "at", "mark")

    def __init__(self) -> None:
        self.trie: dict[int, int] = {}
        self.sums = [7]  # of each node: hash of its phrase
        self.at = 0

    def feed(self, data: bytes) -> list[int]:
        """Parse on; returns the dictionary keys of the new phrases."""
        trie, sums, at = self.trie, self.sums, self.at
        find, made = trie.get, []
        for byte in data:
            key = at + byte
            nxt = find(key)
            if nxt is None:
                trie[key] = len(sums) << 8
                sums.append((sums[at >> 8] * _STEP + byte + 1) & _MASK)
                made.append(key)
                at = 0
            else:
                at = nxt
        self.at = at
        return made

    def back(self, made: list[int], at: int) -> None:
        """Undo the last ``feed``."""
        for key in made:
            del self.trie[key]
        del self.sums[len(self.sums) - len(made):]
        self.at = at


def least(sums: list[int]) -> np.ndarray:
    """The least hash in each slot."""
    out = np.full(SLOTS, _NONE, np.uint64)
    if sums:
        h = np.array(sums, np.uint64)
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)  # fixed values: a 64-bit finalizer
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        np.minimum.at(out, (h % np.uint64(SLOTS)).astype(np.int64), h >> np.uint64(7))
    return out


def digest(slots: np.ndarray) -> np.ndarray:
    """16 bits of each slot's least hash; 0xFFFF for a slot that no phrase picked."""
    return np.where(slots == _NONE, _EMPTY, slots % np.uint64(_EMPTY)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    filled = (a != _EMPTY) | (b != _EMPTY)
    return float(((a == b) & filled).sum() / filled.sum()) if filled.any() else 1.0


def as_text(d: np.ndarray) -> str:
    return d.astype(">u2").tobytes().hex()


class Document:
    """One text's parse up to its last quarter, its fingerprint, and the way to an edited one."""

    def __init__(self, text: str | None) -> None:
        text = text or ""
        self.n = len(text)
        self.quarter = self.n // 4
        self.head = text[: self.n - self.quarter].encode("utf-8", "surrogatepass")
        self.start = text
        self.parse = Parse()
        self.parse.feed(self.head)
        self.head_least = least(self.parse.sums[1:])
        self.fingerprint = digest(np.minimum(self.head_least, self._tail(text[self.n - self.quarter:])))

    def _tail(self, tail: str) -> np.ndarray:
        at, known = self.parse.at, len(self.parse.sums)
        made = self.parse.feed(tail.encode("utf-8", "surrogatepass"))
        found = least(self.parse.sums[known:])
        self.parse.back(made, at)
        return found

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        """sha256 and fingerprint with the last quarter replaced by the start of ``following``."""
        tail = following[: self.quarter]
        sha = hashlib.sha256(self.head + tail.encode("utf-8", "surrogatepass")).hexdigest()
        return sha, digest(np.minimum(self.head_least, self._tail(tail)))


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, copy, id): each own row is finished when its successor arrives."""
    open_part = open_id = doc = None
    for batch in batches:
        rows = []
        parts, copies, ids, texts = (batch.column(i) for i in range(4))
        for part, copy, doc_id, text in zip(parts.to_pylist(), copies.to_pylist(), ids.to_pylist(), texts):
            if part != open_part:
                open_part, doc = part, None
            if copy and doc is None:
                continue
            nxt = Document(text.as_py())
            if doc is not None:
                sha, edited = doc.edited(nxt.start)
                rows.append((open_id, doc.n, sha, as_text(doc.fingerprint), as_text(edited),
                             likeness(doc.fingerprint, edited), likeness(doc.fingerprint, nxt.fingerprint)))
            open_id, doc = (None, None) if copy else (doc_id, nxt)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                            pa.string(), pa.float64(), pa.float64()))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next"])


def _quarters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to four ids that split a range's ids evenly, its least id among them."""
    ids = np.sort(np.concatenate([np.empty(0, np.int64), *(b.column(0).to_numpy() for b in batches)]))
    if len(ids):
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(ids[::-(-len(ids) // 4)]))], names=["id"])


def phrase_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and both likenesses.

    Documents follow each other by (id, text), null ids first; the first follows the last. The
    ids alone are range partitioned to find boundaries (four ids per partition reach the
    driver); then texts move once, and only the first document of a part goes to two parts.
    Null and empty texts are empty: no phrase, all slots empty, likeness 1 among themselves.
    Equal ids are ordered by text; repeated rows follow each other. A single document follows
    itself. Other columns are ignored. Empty tables give no rows.
    """
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(key.alias("id")).repartitionByRange(n, "id").mapInArrow(_quarters, "id long")
    bounds = np.array(sorted(r[0] for r in ids.collect()) or [0], np.int64)

    @F.pandas_udf("struct<part:int,before:int>")
    def place(x: pd.Series) -> pd.DataFrame:
        part = np.maximum(np.searchsorted(bounds, x.to_numpy(), "right") - 1, 0)
        first = bounds[part] == x.to_numpy()
        return pd.DataFrame({"part": part.astype(np.int32),
                             "before": np.where(first, (part - 1) % len(bounds), -1).astype(np.int32)})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), place(key).alias("p"))
    own = F.struct(F.col("p.part").alias("part"), F.lit(False).alias("copy"))
    lent = F.struct(F.col("p.before").alias("part"), F.lit(True).alias("copy"))
    rows = rows.select(F.explode(F.when(F.col("p.before") >= 0, F.array(own, lent)).otherwise(F.array(own))).alias("x"),
                       "id", "text").select("x.part", "x.copy", "id", "text")
    return (rows.repartition(n, "part").sortWithinPartitions("part", "copy", "id", "text").mapInArrow(_walk, OUT))


def q_lzprint(spark, sf_dir: str) -> DataFrame:
    return phrase_fingerprints(table(spark, sf_dir, "documents"))
